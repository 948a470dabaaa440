"""Left equi-join that stays balanced when one key holds a large share of the right side.

A right side that is joined again and again can be stored bucketed by its key, hot keys dealt already: then only
the left side is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


BUCKETS = 1 << 16


def hot_keys(df: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """Keys that hold at least 1/``share`` of the keyed rows. At most ``share`` keys can.

    Rows are counted per hash bucket first, which shuffles a fixed number of rows; single keys are
    counted only inside buckets that are large enough to hide a hot one.
    """
    keyed = df.select(key).filter(F.col(key).isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    rows = F.count("*").alias("_rows")
    # a key of a single row is not worth a salt, whatever its share
    is_large = (F.col("_rows") > 1) & (F.col("_rows") * share >= F.col("_total"))
    # this window sees one row per bucket
    total = F.sum("_rows").over(Window.partitionBy(F.lit(0)))
    sizes = keyed.groupBy(bucket.alias("_bucket")).agg(rows).withColumn("_total", total)
    large = sizes.filter(is_large).select("_bucket", "_total")  # at most ``share`` rows
    inside = keyed.withColumn("_bucket", bucket).join(F.broadcast(large), "_bucket")
    return inside.groupBy(key).agg(rows, F.max("_total").alias("_total")).filter(is_large).select(key)


@dataclass(frozen=True)
class StoredSide:
    """A right side in a table bucketed by (key, _salt), its hot keys in another."""

    rows: DataFrame
    hot: DataFrame
    key: str
    salts: int


def _dealt(right: DataFrame, hot: DataFrame, key: str, slice_by: list[str] | None, salts: int) -> DataFrame:
    """Rows with a key, those of hot keys dealt over the slices."""
    slice_of = F.pmod(F.xxhash64(*[F.col(c) for c in slice_by or right.columns]), F.lit(salts)).cast("int")
    return (
        right.filter(F.col(key).isNotNull())
        .join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
        .withColumn("_salt", F.when(F.coalesce("_hot", F.lit(False)), slice_of).otherwise(0))
        .drop("_hot")
    )


def store_side(
    right: DataFrame,
    key: str,
    table: str,
    buckets: int | None = None,
    slice_by: list[str] | None = None,
    salts: int = 64,
    share: int = 1000,
    unique: bool = False,
) -> StoredSide:
    """Write ``right`` as a managed table of as many buckets as there are shuffle partitions, unless given.

    Rows without a key match nothing and are left out. Tables of the same name are replaced.
    """
    spark = right.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = right.select(key).filter(F.lit(False)) if unique else hot_keys(right, key, share)
    hot.write.mode("overwrite").saveAsTable(f"{table}_hot")
    rows = _dealt(right, spark.table(f"{table}_hot"), key, slice_by, salts).repartition(buckets, key, "_salt")
    rows.write.bucketBy(buckets, key, "_salt").sortBy(key, "_salt").mode("overwrite").saveAsTable(table)
    return open_side(spark, key, table, salts)


def open_side(spark: SparkSession, key: str, table: str, salts: int = 64) -> StoredSide:
    """A side stored before, with the number of slices it was stored with."""
    return StoredSide(spark.table(table), spark.table(f"{table}_hot"), key, salts)


def spread_left_join(
    left: DataFrame,
    right: DataFrame | StoredSide,
    key: str,
    keys_of: DataFrame | None = None,
    distinct: list | None = None,
    slice_by: list[str] | None = None,
    salts: int = 64,
    share: int = 1000,
    unique: bool = False,
) -> DataFrame:
    """``left.join(right, key, 'left')`` with salted hot and NULL keys. ``key`` exists on both sides.

    A left outer join can split a hot left partition at run time but not a hot right one. So right
    rows of a hot key are dealt over ``salts`` slices and the left rows of that key visit all slices.
    Such a key exists on the right for sure, so a left copy that met an empty slice is dropped.
    Left rows without a key match nothing; they are spread by a hash instead of meeting in one task.

    A stored right side comes with its slices and hot keys; ``salts``, ``share``, ``unique`` and ``slice_by``
    are those it was stored with, and its rows are not shuffled.

    The hot-key frame is broadcast: it has at most ``share`` rows. ``keys_of`` may name a cheaper
    frame with the same keys as ``right`` to find them in.

    ``unique`` says that the right side has one row per key at most, such as a table by its primary key:
    then no key can be hot there, a hot left key is split at run time, and only NULL keys are spread.

    ``distinct`` selects these columns and drops duplicates without another shuffle. That is exact when
    rows that become equal share a slice: ``slice_by`` names the right columns that decide it (default
    all), and these must survive the selection, as must what tells left rows without a key apart.
    """
    stored = isinstance(right, StoredSide)
    salts = right.salts if stored else salts
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    if unique and not stored:
        salted = left.withColumn("_salt", F.when(F.col(key).isNull(), spread).otherwise(0))
        known = right.filter(F.col(key).isNotNull()).withColumn("_salt", F.lit(0))
        result = salted.join(known, [key, "_salt"], "left")
        return result.select(*distinct, "_salt").distinct().drop("_salt") if distinct is not None else result.drop("_salt")
    hot = right.hot if stored else hot_keys(right if keys_of is None else keys_of, key, share)
    dealt = right.rows if stored else _dealt(right, hot, key, slice_by, salts)
    salted_right = dealt.withColumn("_matched", F.lit(True))
    hot = hot.withColumn("_hot", F.lit(True))
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    visits = (
        F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
        .when(F.col(key).isNull(), F.array(spread))
        .otherwise(F.array(F.lit(0)))
    )
    salted_left = (
        left.join(F.broadcast(hot), key, "left")
        .withColumn("_hot", is_hot)
        .withColumn("_salt", F.explode(visits))
    )
    result = salted_left.join(salted_right, [key, "_salt"], "left").filter(
        ~F.col("_hot") | F.coalesce(F.col("_matched"), F.lit(False))
    )
    if distinct is not None:
        return result.select(*distinct, "_salt").distinct().drop("_salt")
    return result.drop("_hot", "_matched", "_salt")
