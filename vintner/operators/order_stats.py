"""Exact order statistics without gathering a column in one task.

``median`` as an aggregate merges every distinct value of a column into one buffer. Here mergeable quantile
sketches of all names are made in one scan; a second scan counts the values in a bracket around each wanted
rank, cut into stretches, and only those of the stretch that holds the rank are sorted. Sketches only
choose what is counted, so results are exact. Everything stays a frame, whatever the number of names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintner.sources.storage import written

#: Size of a sketch: about 0.03% of the rows is its usual error in rank; a bracket reaches ten times as far.
SKETCH = 8192
MARGIN = 0.003
#: Steps of the sketches' quantiles, so many that a task sorts about as many rows as this.
SORTED_AT_ONCE = 1_000_000
LEAST_STEPS, MOST_STEPS = 128, 10_000
#: Ranks of all names that are broadcast, at most.
FEW_RANKS = 10_000
_LOWEST, _HIGHEST = float("-inf"), float("inf")


@dataclass(frozen=True)
class Extent:
    """What one aggregate tells about a column: all rows, rows with a value, and their moments."""

    rows: int
    n: int
    mean: float | None
    variance: float | None


def extents(rows: DataFrame) -> dict[str, Extent]:
    """Extent per name of a (name, value) frame with few names, such as the columns of a model."""
    value = F.col("value")
    found = rows.groupBy("name").agg(F.count("*"), F.count(value), F.avg(value), F.var_pop(value))
    return {name: Extent(*rest) for name, *rest in found.collect()}


def order_statistics(
    rows: DataFrame, ranks: Callable[[Column], list[Column]], at_once: int = SORTED_AT_ONCE
) -> DataFrame:
    """(name, i, value): per name the values at the 0-based ranks ``ranks`` gives for its number of values.

    ``rows`` has (name, value). NULL and NaN are not values; infinities are, and NULL is a name like
    others. A name without values is absent. Two scans: one sketches all names, one counts the values near the
    ranks. A rank that a sketch misses by more than ten times its usual error is looked for once more without it.
    """
    values = rows.select("name", F.col("value").cast("double").alias("value")).filter("value IS NOT NULL AND NOT isnan(value)")
    sketched = values.groupBy("name").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch"))
    wanted = F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("n"))])).alias("i", "rank")
    state = written(sketched.select(F.col("name").alias("_name"), "n", "sketch", wanted).filter("rank BETWEEN 0 AND n - 1"), "sketches")
    n_ranks, largest = state.agg(F.count("*"), F.max("n")).first()
    if not n_ranks:
        return values.select("name", F.lit(0).alias("i"), "value").limit(0)
    brackets = _with_brackets(state, largest, at_once)
    found = _at_ranks(_counted(values, brackets, n_ranks))
    missed = found.filter("value IS NULL").select("_name", "i")
    exact = found.filter("value IS NOT NULL")
    if missed.isEmpty():
        return exact.select(F.col("_name").alias("name"), "i", "value")
    same = F.col("a._name").eqNullSafe(F.col("b._name")) & (F.col("a.i") == F.col("b.i"))
    again = brackets.alias("a").join(missed.alias("b"), same, "left_semi").withColumn("edges", _everywhere(F.col("edges")))
    both = exact.unionByName(_at_ranks(_counted(values, again, n_ranks)))
    return both.select(F.col("_name").alias("name"), "i", "value")


def _with_brackets(state: DataFrame, largest: int, at_once: int) -> DataFrame:
    """(name, i, rank, edges): sorted values, the first and last of which lie on both sides of the rank by the sketch.

    Two neighbours have about ``at_once`` rows of the largest name between them.
    """
    steps = min(MOST_STEPS, max(LEAST_STEPS, math.ceil(largest / at_once)))
    grid = F.kll_sketch_get_quantile_double("sketch", F.lit([k / steps for k in range(steps + 1)]))
    share, reach = (F.col("rank") + 0.5) / F.col("n"), F.lit(MARGIN) + F.lit(2) / F.col("n")
    low, high = F.floor((share - reach) * steps).cast("int"), F.ceil((share + reach) * steps).cast("int")
    placed = state.select("_name", "i", "rank", grid.alias("grid"), low.alias("low"), high.alias("high"))
    first = F.greatest(F.col("low"), F.lit(0))
    inner = F.slice("grid", first + 1, F.least(F.col("high"), F.lit(steps)) - first + 1)
    # Beyond the first and the last value nothing is left to miss.
    below = F.when(F.col("low") < 0, F.array(F.lit(_LOWEST))).otherwise(F.array())
    above = F.when(F.col("high") > steps, F.array(F.lit(_HIGHEST))).otherwise(F.array())
    return placed.select("_name", "i", "rank", F.concat(below, inner, above).alias("edges"))


def _everywhere(edges: Column) -> Column:
    return F.array_sort(F.concat(F.array(F.lit(_LOWEST), F.lit(_HIGHEST)), edges))


def _counted(values: DataFrame, brackets: DataFrame, n_ranks: int) -> DataFrame:
    """(name, i, rank, stretch, value, n), stored: rows per value between the edges, one number below and one above them.

    Every row meets the ranks of its name. They are broadcast while they are few; else Spark deals both by name and
    splits a large one.
    """
    slim = brackets if n_ranks > FEW_RANKS else F.broadcast(brackets)
    met = values.join(slim, F.col("name").eqNullSafe(F.col("_name")))
    first, last = F.element_at("edges", 1), F.element_at("edges", -1)
    value = F.col("value")
    stretch = F.when(value < first, 0).when(value > last, F.size("edges") + 1)
    stretch = stretch.otherwise(F.greatest(F.lit(1), F.size(F.filter("edges", lambda e: e < value))))
    kept = F.when(value.between(first, last), value)
    placed = met.select("_name", "i", "rank", stretch.alias("stretch"), kept.alias("value"))
    return written(placed.groupBy("_name", "i", "rank", "stretch", "value").agg(F.count("*").alias("n")), "near-ranks")


def _at_ranks(counted: DataFrame) -> DataFrame:
    """(name, i, value) at the ranks; NULL where a rank lies outside the edges."""
    key = ["_name", "i"]
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("stretch"))  # one row per stretch
    stretches = counted.groupBy(*key, "rank", "stretch").agg(F.sum("n").alias("n"))
    stretches = stretches.withColumn("before", upto - F.col("n"))
    hit = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    inside = stretches.filter(hit).select(F.col("_name").alias("_n"), F.col("i").alias("_i"), F.col("stretch").alias("_s"), "before")
    same = F.col("_name").eqNullSafe(F.col("_n")) & (F.col("i") == F.col("_i")) & (F.col("stretch") == F.col("_s"))
    near = counted.join(inside, same).drop("_n", "_i", "_s")
    # Only the values of one stretch meet in a window, once each.
    end = F.col("before") + F.sum("n").over(Window.partitionBy(*key).orderBy("value"))
    ranked = near.withColumn("end", end)
    return ranked.filter((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))).select(*key, "value")


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value) rows of numeric columns."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "name", "value")


def medians_of(rows: DataFrame, at_once: int = SORTED_AT_ONCE) -> DataFrame:
    """(name, median); with an even count the mean of the two middle values."""
    middle = order_statistics(rows, lambda n: [F.floor((n - 1) / 2), F.floor(n / 2)], at_once)
    low, high = (F.max(F.when(F.col("i") == k, F.col("value"))) for k in (0, 1))
    return middle.groupBy("name").agg(F.when(low == high, low).otherwise((low + high) / 2).alias("median"))


def holdout(df: DataFrame, order: Column, share: float = 0.1, flag: str = "_test") -> DataFrame:
    """Flag the ceil(share x rows) rows with the smallest ``order`` values, and rows that tie with the last one.

    ``order`` is a repeatable number per row, such as a seeded hash of its keys; rows without one come
    last and are not flagged. The split needs no shuffle of the rows and does not depend on how they
    are partitioned.
    """
    number = order.cast("double")
    numbered = df.select(F.lit("order").alias("name"), number.alias("value"))
    found = order_statistics(numbered, lambda n: [F.ceil(F.lit(share) * n) - 1]).first()
    if found is None:
        return df.withColumn(flag, F.lit(False))
    return df.withColumn(flag, F.coalesce(number <= F.lit(found["value"]), F.lit(False)))


def key_hash(keys: list[str], seed: int):
    """52 bits of a seeded hash: exact as a double."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), 12)
