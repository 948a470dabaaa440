"""Quality rules: base counts of a text, and robust multivariate outliers per language and source.

All of it is DataFrame expressions. Each group (language, source) gets a minimum-covariance-determinant
estimate of place and spread of its documents' transformed counts: from three robust starts (scaled values,
their signs, their directions), concentration steps re-estimate from the half of the documents that is
closest, until no determinant falls any more, and the start with the smallest determinant wins. Documents
whose Mahalanobis distance is beyond the cut are not kept.

A group is only ever summed up (partial sums and quantile sketches), so one that holds most documents is no
harder than a small one. Half of the documents of a group often agree exactly in a count (no symbols,
no repeats), where the spread would be zero; to every variance is added that of a difference that does
not matter for quality (``FLOORS``), which also gives groups of one or two documents a result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner.llm.shared import stored

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
#: Largest share of repeated words in percent.
MOST_REPEATED = 20
#: Transformed counts and the standard deviation below which a difference does not matter, so that in a group whose
#: documents agree exactly the cut (its root is 4.53) falls where the least faults of a short text still pass.
#: symbols: one in ten words. lines and repeats: one repeated line moves both, so each has half of the cut for two
#: repeated lines and for a fifth of the words, which the base rules allow. word_size: the mean of 50 words whose
#: lengths spread by half of it. size: a length is no fault.
FLOORS = {"size": 0.5, "word_size": 0.07, "symbols": 0.07, "lines": 0.35, "repeats": 0.14}
#: Mean of the variances of half a normal sample, the half closest to its centre, is this much too small.
HALF_SPREAD = 1.915
#: Squared distance that one document in a thousand of a normal group exceeds: chi-square with five degrees of freedom.
CUT = 20.515
#: Groups up to which a table of one row per group and start is broadcast; beyond, it is joined by shuffle.
FEW_GROUPS = 50_000
#: A determinant whose logarithm falls by less than this share of it has settled.
SETTLED = 1e-6
_NAMES = list(FLOORS)
_P = len(_NAMES)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) of the text.

    A null text has no words. Windows are compared by 64-bit hashes of their words. The names of the
    counts must not be taken.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.filter(F.split(body, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    held = docs.withColumn("body_", body).withColumn("words_", F.transform(words, lambda w: F.xxhash64(w)))
    held = held.withColumn("lines_", lines)
    held = held.withColumn("n_words", F.size("words_").cast("long"))
    hashes = F.col("words_")
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")),
            lambda i: F.xxhash64(*(F.get(hashes, i + k - 1) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    held = held.withColumn("windows_", windows).withColumn("different_", F.size(F.array_distinct("windows_")))
    # Only texts with a window found twice are sorted: by hash, so that equal windows are neighbours.
    again = F.col("different_") < F.size("windows_")
    placed = F.array_sort(F.transform("windows_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    held = held.withColumn("placed_", F.when(again, placed))
    hash_at = lambda i: F.get(F.col("placed_"), i)["h"]
    twins = F.filter(
        "placed_",
        lambda x, i: x["h"].eqNullSafe(hash_at(i - 1)) | x["h"].eqNullSafe(hash_at(i + 1)),
    )
    held = held.withColumn("at_", F.when(again, F.array_sort(F.transform(twins, lambda x: x["i"]))))
    covered = F.aggregate(
        "at_",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct(
            (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).cast("long").alias("n"), i.alias("last")
        ),
        lambda s: s["n"],
    )
    return held.select(
        *docs.columns,
        "n_words",
        F.length(F.translate("body_", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("body_") - F.length(F.translate("body_", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        F.when(again, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def transformed(counted: DataFrame) -> DataFrame:
    """All columns and the transformed counts, which are about normal among ordinary texts and finite for all."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return counted.withColumns(
        {
            "size": F.log1p("n_words"),
            "word_size": F.log1p(F.col("word_chars") / n),
            "symbols": F.sqrt(F.col("n_symbols") / n),
            "lines": F.log1p("n_dup_lines"),
            "repeats": F.sqrt(F.col("n_repeat_words") / n),
        }
    )


def _moments(values: list[Column]) -> list[Column]:
    """Sums, and sums of products on and below the diagonal, as aggregates."""
    out = [F.count("*").cast("double").alias("n")]
    out += [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    out += [F.sum(values[i] * values[j]).alias(f"q{i}{j}") for i in range(_P) for j in range(i + 1)]
    return out


def _estimates(summed: DataFrame, keys: list[str], spread: float) -> DataFrame:
    """Means m*, Cholesky factor l** of the spread with its floors, and the log determinant, of each row of sums."""
    out = summed.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(_P)})
    cov = {
        (i, j): F.greatest(F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"), F.lit(0.0)) * spread
        + FLOORS[_NAMES[i]] ** 2
        if i == j
        else (F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * spread
        for i in range(_P)
        for j in range(i + 1)
    }
    out = out.withColumns({f"c{i}{j}": c for (i, j), c in cov.items()})
    for i in range(_P):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            # Rounding aside, what is left of a variance is at least its floor.
            least = F.lit((FLOORS[_NAMES[i]] ** 2) * 0.5)
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, least)) if i == j else rest / F.col(f"l{j}{j}"))
    log_det = reduce(lambda a, b: a + b, (2 * F.log(F.col(f"l{i}{i}")) for i in range(_P)))
    kept = [f"m{i}" for i in range(_P)] + [f"l{i}{j}" for i in range(_P) for j in range(i + 1)]
    return out.select(*keys, *kept, log_det.alias("log_det"))


def _distance(rows: DataFrame, out: str = "d2") -> DataFrame:
    """The squared Mahalanobis distance, by solving with the Cholesky factor."""
    for i in range(_P):
        left = F.col(_NAMES[i]) - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"z{i}", left / F.col(f"l{i}{i}"))
    return rows.withColumn(out, reduce(lambda a, b: a + b, (F.col(f"z{i}") * F.col(f"z{i}") for i in range(_P))))


def _starts(rows: DataFrame, group: str, small) -> DataFrame:
    """Three first estimates of every group, with their moments taken around median and scale of each count."""
    half = stored(rows.groupBy(group).agg(*(F.percentile_approx(c, 0.5, 10_000).alias(f"med{i}") for i, c in enumerate(_NAMES))), "medians")
    centred = rows.join(small(half), group)
    away = [F.percentile_approx(F.abs(F.col(c) - F.col(f"med{i}")), 0.5, 10_000).alias(f"mad{i}") for i, c in enumerate(_NAMES)]
    scale = stored(centred.groupBy(group, *(f"med{i}" for i in range(_P))).agg(*away), "scales")
    scaled = rows.join(small(scale), group).withColumns(
        {f"u{i}": (F.col(c) - F.col(f"med{i}")) / (F.col(f"mad{i}") * 1.4826 + FLOORS[c]) for i, c in enumerate(_NAMES)}
    )
    length = F.greatest(F.sqrt(reduce(lambda a, b: a + b, (F.col(f"u{i}") * F.col(f"u{i}") for i in range(_P)))), F.lit(1e-9))
    kinds = [lambda u: F.tanh(u), lambda u: F.signum(u), lambda u: u / F.col("length")]
    scaled = scaled.withColumn("length", length)
    starts = None
    for start, kind in enumerate(kinds):
        values = [kind(F.col(f"u{i}")) for i in range(_P)]
        products = [F.avg(values[i] * values[j]).alias(f"r{i}{j}") for i in range(_P) for j in range(i + 1)]
        keys = [group, *(f"{x}{i}" for i in range(_P) for x in ("med", "mad"))]
        found = scaled.groupBy(*keys).agg(*products).withColumn("start", F.lit(start))
        # Robust correlations with the robust scales, around the medians, in the form of moments of one row.
        sums = {"n": F.lit(1.0)} | {f"s{i}": F.col(f"med{i}") for i in range(_P)}
        for i in range(_P):
            for j in range(i + 1):
                norm = F.sqrt(F.greatest(F.col(f"r{i}{i}") * F.col(f"r{j}{j}"), F.lit(1e-12)))
                scales = F.col(f"mad{i}") * F.col(f"mad{j}") * 1.4826**2
                sums[f"q{i}{j}"] = F.col(f"r{i}{j}") / norm * scales + F.col(f"med{i}") * F.col(f"med{j}")
        found = found.withColumns(sums)
        starts = found if starts is None else starts.unionByName(found)
    return _estimates(starts, [group, "start"], 1.0)


def estimates(rows: DataFrame, group: str) -> DataFrame:
    """The minimum-covariance-determinant estimate of every group: one row with its means and Cholesky factor."""
    sizes = stored(rows.groupBy(group).agg(F.count("*").alias("size_of_group")), "group-sizes")
    few = sizes.count() <= FEW_GROUPS
    small = lambda table: F.broadcast(table) if few else table
    share = F.least(F.lit(1.0), (F.floor((F.col("size_of_group") + _P + 1) / 2)) / F.col("size_of_group"))
    sizes = sizes.withColumn("share", share).select(group, "share")
    never = F.lit(float("inf"))  # a start says nothing about determinants of later estimates
    moving = stored(_starts(rows, group, small).withColumn("log_det", never).join(small(sizes), group), "starts")
    settled: list[DataFrame] = []
    # Every determinant that goes on falls by a share of itself, so the rounds end. A group's own rounds do not
    # depend on other groups.
    while not moving.isEmpty():
        near = _distance(rows.join(small(moving), group))
        # Every group asks for the same share but for rounding, so a fine grid of quantiles holds it: rounded down, a
        # quantile of up to 1000 rows is the last of the share.
        grid = [0.5 + k / 1000 for k in range(501)]
        border = near.groupBy(group, "start").agg(
            F.max("share").alias("share"), F.percentile_approx("d2", grid, 10_000).alias("grid")
        )
        at = F.greatest(F.lit(0), F.floor((F.col("share") - 0.5) * 1000 + 1e-9)).cast("int")
        border = stored(border.select(group, "start", F.get("grid", at).alias("border")), "borders")
        close = moving.withColumnRenamed("log_det", "was").join(small(border), [group, "start"])
        close = _distance(rows.join(small(close), group)).filter("d2 <= border")
        keys = [group, "start", "share", "was"]
        summed = close.groupBy(*keys).agg(*_moments([F.col(c) for c in _NAMES]))
        now = stored(_estimates(summed, keys, HALF_SPREAD), "concentrated")
        falls = F.col("was") - F.col("log_det") > SETTLED * F.greatest(F.lit(1.0), F.abs("log_det"))
        settled.append(now.filter(~falls).drop("was"))
        moving = now.filter(falls).drop("was")
    if not settled:
        settled = [moving]
    present = reduce(DataFrame.unionByName, settled)
    best = present.groupBy(group).agg(F.min(F.struct("log_det", "start")).alias("best"))
    best = best.select(group, F.col("best.start").alias("start"))
    fitted = stored(present.join(small(best), [group, "start"]).drop("start", "share", "log_det"), "estimates")
    return small(fitted)


def judged(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the squared distance of every row.

    ``base_failed``: fewer than 10 words, or over a fifth of them repeated. ``kept`` is false then, and for
    rows beyond the cut; null languages and sources are groups like others. The estimates take all
    rows that do not fail the base rules; a row that fails has no distance, nor a group of its kind.
    """
    slim = docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(F.col("lang").isNull(), F.col("lang"), F.col("source").isNull(), F.col("source")).alias("group_"),
        F.col("text").cast("string").alias("text"),
    )
    counted = base_counts(slim).drop("text")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    held = stored(transformed(counted).withColumn("base_failed", failed), "counts")
    rows = held.filter("NOT base_failed").select("group_", *_NAMES)
    far = _distance(held.join(estimates(rows, "group_"), "group_", "left"))
    return far.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("d2") <= CUT)).alias("kept"),
        F.when(~F.col("base_failed"), F.col("d2")).alias("distance2"),
    )
