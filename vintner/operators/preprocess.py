"""Train-only statistics for numeric, categorical and boolean inputs, applied to any frame."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintner.operators.order_stats import extents, long_values, medians_of
from vintner.sources.storage import cut

UNKNOWN = "unknown"
RARE = "infrequent_sklearn"  # fixed value: label of the bucket of rare categories


@dataclass
class Inputs:
    """Which columns feed a model, and how they are treated."""

    categorical: list[str]
    numeric: list[str]
    boolean: list[str] = field(default_factory=list)
    impute: str = "median"  # or "mean" or "constant" (0)
    max_categories: int | None = None


@dataclass
class Fitted:
    inputs: Inputs
    fill: dict[str, float]
    mean: dict[str, float]
    spread: dict[str, float]
    codes: DataFrame | None  # (name, label, position): place of every training category among its column's features
    sizes: dict[str, int]  # features per categorical column
    rare: set[str]  # columns whose last feature is the bucket of rare categories
    seen: dict[str, list[bool]]
    placed: bool = False  # whether rows already carry the places of their categories, see ``with_places``

    @property
    def numeric(self) -> list[str]:
        """Columns with a statistic; one without any training value is dropped."""
        return [c for c in self.inputs.numeric if c in self.fill]

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.sizes.values()) + len(self.inputs.boolean)

    def names_of(self, features: list[int]) -> dict[int, str]:
        """Names of features by their place in the vector; only those asked for reach the driver."""
        out, first = {}, len(self.numeric)
        out.update({i: f"num__{self.numeric[i]}" for i in features if i < first})
        for c in self.inputs.categorical:
            asked = [i - first for i in features if first <= i < first + self.sizes[c]]
            if asked and c in self.rare and self.sizes[c] - 1 in asked:
                asked.remove(self.sizes[c] - 1)
                out[first + self.sizes[c] - 1] = f"cat__{c}_{RARE}"
            if asked:
                found = self.codes.filter((F.col("name") == c) & F.col("position").isin(asked)).collect()
                out.update({first + r["position"]: f"cat__{c}_{r['label']}" for r in found})
            first += self.sizes[c]
        out.update({i: f"bool__{self.inputs.boolean[i - first]}" for i in features if i >= first})
        return out

    @property
    def feature_names(self) -> list[str]:
        """All names; as many as the vector is wide."""
        names = self.names_of(list(range(self.width)))
        return [names[i] for i in range(self.width)]

    def scaled(self, name: str) -> Column:
        value = F.coalesce(F.col(name).cast("double"), F.lit(self.fill[name]))
        return (value - F.lit(self.mean[name])) / F.lit(self.spread[name])

    def with_positions(self, df: DataFrame, outputs: dict[str, str]) -> DataFrame:
        """Place of each row's category among the features of its column; NULL counts as ``unknown``.

        A value not seen in training has the place after the last one, which encodes to zeros.
        """
        for output, name in outputs.items():
            own = self.codes.filter(F.col("name") == name).select(F.col("label").alias("_category"), F.col("position").alias(output))
            df = df.withColumn("_category", category(F.col(name))).join(own, "_category", "left").drop("_category")
            df = df.withColumn(output, F.coalesce(F.col(output), F.lit(self.sizes[name])).cast("double"))
        return df

    def with_labels(self, df: DataFrame, outputs: dict[str, str]) -> DataFrame:
        """Categories with NULL as ``unknown`` and rare training values in one bucket.

        A value not seen in training is not rare: it stays as it is.
        """
        places = {f"_place_{output}": name for output, name in outputs.items()}
        df = self.with_positions(df, places)
        for place, name in places.items():
            bucket = F.lit(name in self.rare) & (F.col(place) == self.sizes[name] - 1)
            df = df.withColumn(place.removeprefix("_place_"), F.when(bucket, RARE).otherwise(category(F.col(name)))).drop(place)
        return df

    def ordinal(self, name: str) -> Column:
        """Position among the values seen in training; missing and unseen are -1."""
        result = F.lit(-1.0)
        for position, value in enumerate(self.seen[name]):
            result = F.when(F.col(name) == F.lit(value), F.lit(float(position))).otherwise(result)
        return result

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Add the feature vector: scaled numbers, one-hot categories, ordinal booleans."""
        names = self.inputs
        numbers = {f"_n{i}": self.scaled(c) for i, c in enumerate(self.numeric)}
        flags = {f"_b{i}": self.ordinal(c) for i, c in enumerate(names.boolean)}
        places = {f"_i{i}": c for i, c in enumerate(names.categorical)}
        encoded = [f"_e{i}" for i in range(len(places))]
        out = df.withColumns({**numbers, **flags})
        if places:
            # One row tells the encoder the widths; the last place, of unseen values, is dropped: all zeros.
            widths = df.sparkSession.createDataFrame([[float(self.sizes[c]) for c in places.values()]], list(places))
            encoder = OneHotEncoder(inputCols=list(places), outputCols=encoded, dropLast=True).fit(widths)
            known = out.withColumns({i: F.col(place_column(c)) for i, c in places.items()}) if self.placed else self.with_positions(out, places)
            out = encoder.transform(known).drop(*places)
        out = VectorAssembler(inputCols=[*numbers, *encoded, *flags], outputCol=output).transform(out)
        return out.drop(*numbers, *encoded, *flags)


def place_column(name: str) -> str:
    return f"_place_of_{name}"


@dataclass
class Categories:
    """Places of all categories of some rows, learnt once for models over parts of them.

    A category that a part does not train on is a feature that is zero there, so no tree ever asks for it.
    """

    codes: DataFrame | None
    sizes: dict[str, int]

    @classmethod
    def of(cls, rows: DataFrame, columns: list[str]) -> Categories:
        codes, sizes, _ = encoded_categories(rows, Inputs(categorical=columns, numeric=[]))
        return cls(codes, sizes)

    def with_places(self, rows: DataFrame) -> DataFrame:
        """The rows with a place column per categorical column, as ``fit`` and ``transform`` then expect them."""
        none = Fitted(Inputs([], []), {}, {}, {}, self.codes, self.sizes, set(), {})
        return none.with_positions(rows, {place_column(c): c for c in self.sizes})


def category(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(UNKNOWN))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and category."""
    return (
        df.select(*[category(F.col(c)).alias(c) for c in columns])
        .unpivot([], columns, "name", "label")
        .groupBy("name", "label")
        .agg(F.count("*").alias("n"))
    )


def frequent_categories(counts: DataFrame, max_categories: int) -> DataFrame:
    """Categories that keep their own name; the bucket of the others counts as one of the limit.

    Equal counts are resolved in favour of the later name. A column within the limit keeps all.
    """
    order = Window.partitionBy("name").orderBy(F.desc("n"), F.desc("label"))
    # the filter on the row number prunes each task to its own top rows before they are shuffled
    top = (
        counts.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") < max_categories)
        .select("name", "label", F.lit(True).alias("_top"))
    )
    sizes = counts.groupBy("name").agg(F.count("*").alias("_size"))
    kept = (F.col("_size") < max_categories) | F.coalesce("_top", F.lit(False))
    # one row per encoded column
    sized = counts.join(F.broadcast(sizes), "name")
    return sized.join(top, ["name", "label"], "left").withColumn("kept", kept).select(*counts.columns, "kept")


def numeric_statistics(df: DataFrame, columns: list[str], impute: str):
    """Fill value, mean and population spread of each column after filling.

    Moments of the filled column follow from those of its values and the number of gaps.
    """
    if impute not in ("median", "mean", "constant"):
        raise ValueError(f"unknown imputation {impute!r}")
    if not columns:
        return {}, {}, {}
    rows = long_values(df, columns)
    in_thread = inheritable_thread_target(df.sparkSession)
    with ThreadPoolExecutor(2) as pool:
        counted = pool.submit(in_thread(extents), rows)
        middles = pool.submit(in_thread(lambda: medians_of(rows).collect())) if impute == "median" else None  # one row per column
        known = counted.result()
        fill = {r["name"]: r["median"] for r in middles.result()} if middles else {}
    with_values = {c: e for c, e in known.items() if e.n}
    if impute == "mean":
        fill = {c: e.mean for c, e in with_values.items()}
    elif impute == "constant":
        fill = {c: 0.0 for c in columns}
    mean, spread = {}, {}
    for c in fill:
        e = known[c]
        gaps, centre = e.rows - e.n, e.mean if e.n else 0.0
        mean[c] = (e.n * centre + gaps * fill[c]) / e.rows
        squares = e.n * ((e.variance or 0.0) + (centre - mean[c]) ** 2) + gaps * (fill[c] - mean[c]) ** 2
        spread[c] = math.sqrt(squares / e.rows) or 1.0
    return fill, mean, spread


def encoded_categories(train: DataFrame, inputs: Inputs) -> tuple[DataFrame | None, dict[str, int], set[str]]:
    """Codes of all training categories as a frame, features per column, and the columns with a rare bucket.

    The categories of a column are numbered in the order of their labels, without bringing them into one
    task: the sorted frame is numbered by partition.
    """
    if not inputs.categorical:
        return None, {}, set()
    counts = category_counts(train, inputs.categorical)
    if inputs.max_categories is None:
        flagged = counts.withColumn("kept", F.lit(True))
    else:
        flagged = frequent_categories(counts, inputs.max_categories)
    flagged = cut(flagged.select("name", "label", "kept"))
    # One row per encoded column.
    totals = flagged.groupBy("name").agg(F.count_if("kept").alias("n"), F.count_if(~F.col("kept")).alias("others")).collect()
    kept = {r["name"]: r["n"] for r in totals}
    rare = {r["name"] for r in totals if r["others"]}
    sizes = {c: kept.get(c, 0) + (c in rare) for c in inputs.categorical}
    numbered = numbered_rows(flagged.filter("kept").select("name", "label"), "name", "label")
    first = numbered.groupBy("name").agg(F.min("_number").alias("_first"))
    codes = numbered.join(F.broadcast(first), "name").select(
        "name", "label", (F.col("_number") - F.col("_first")).cast("int").alias("position")
    )
    if rare:
        last = F.create_map(*[F.lit(x) for c in rare for x in (c, sizes[c] - 1)])
        codes = codes.unionByName(flagged.filter(~F.col("kept")).select("name", "label", last[F.col("name")].alias("position")))
    return cut(codes), sizes, rare


def numbered_rows(df: DataFrame, *order: str) -> DataFrame:
    """Rows with ``_number`` counting from 0 in this order: sorted over all tasks, counted per partition."""
    placed = cut(df.orderBy(*order)).withColumn("_id", F.monotonically_increasing_id())
    partition = F.shiftright("_id", 33)
    sizes = placed.groupBy(partition.alias("p")).count().orderBy("p").collect()  # one row per partition
    starts, total = [], 0
    for row in sizes:
        starts.append((row["p"], total))
        total += row["count"]
    start = df.sparkSession.createDataFrame(starts, "_p bigint, _start bigint")
    in_partition = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    both = placed.withColumn("_p", partition).join(F.broadcast(start), "_p")
    return both.withColumn("_number", F.col("_start") + in_partition).drop("_p", "_start", "_id")


def fit(train: DataFrame, inputs: Inputs, categories: Categories | None = None) -> Fitted:
    """Learn all statistics from the training rows; what reaches the driver is as small as the model.

    With ``categories`` the rows carry their places, and only numbers are learnt; a limit on
    categories goes by their counts among the training rows, so it excludes this.
    """
    if categories is not None and inputs.max_categories is not None:
        raise ValueError("a limit on categories needs those of the training rows")
    in_thread = inheritable_thread_target(train.sparkSession)
    with ThreadPoolExecutor(2) as pool:
        numbers = pool.submit(in_thread(numeric_statistics), train, inputs.numeric, inputs.impute)
        if categories is None:
            codes, sizes, rare = pool.submit(in_thread(encoded_categories), train, inputs).result()
        else:
            codes, sizes, rare = categories.codes, categories.sizes, set()
        fill, mean, spread = numbers.result()
    seen: dict[str, list[bool]] = {}
    if inputs.boolean:
        row = train.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in inputs.boolean]).first()
        seen = {c: list(row[c]) for c in inputs.boolean}
    return Fitted(inputs, fill, mean, spread, codes, sizes, rare, seen, categories is not None)


def series_vectors(df: DataFrame, fitted: Fitted, timestamp: str | None, target: str, keep: list[str] = ()) -> DataFrame:
    """``ds``, ``features`` and ``y``: all preprocessed features as one sparse vector, however many categories there are.

    ``keep`` names further columns. Columns that the frame lacks are left out. ``Fitted.names_of`` has the names of places in the vector.
    """
    vectors = fitted.transform(df)
    ds = [F.col(timestamp).cast("timestamp_ntz").alias("ds")] if timestamp in df.columns else []
    y = [F.col(target).cast("double").alias("y")] if target in df.columns else []
    return vectors.select(*keep, *ds, "features", *y)


def time_series_frame(
    df: DataFrame, fitted: Fitted, timestamp: str | None, target: str
) -> DataFrame:
    """``ds``, one column per preprocessed feature and ``y``; for many categories take ``series_vectors``."""
    array = vector_to_array("features")
    columns = [array[i].alias(name) for i, name in enumerate(fitted.feature_names)]
    vectors = series_vectors(df, fitted, timestamp, target)
    return vectors.select(*[c for c in ("ds",) if c in vectors.columns], *columns, *[c for c in ("y",) if c in vectors.columns])
