import random
import uuid

from pyspark.sql import functions as F

from vintner.operators.joins import hot_keys, open_side, spread_left_join, store_side

rng = random.Random(7)
RIGHT = [("hot" if i % 3 == 0 else f"k{i % 40}", i, "same" if i % 2 else None) for i in range(600)] + [(None, -1, "x")] * 5
LEFT = [(rng.choice(["hot", "k1", "k7", "absent", None]), i) for i in range(60)]


def frames(spark):
    return (
        spark.createDataFrame(LEFT, "k string, l int"),
        spark.createDataFrame(RIGHT, "k string, r int, note string"),
    )


def expected():
    out = []
    for k, left in LEFT:
        matches = [(r, note) for rk, r, note in RIGHT if k is not None and rk == k]
        out += [(k, left, *m) for m in (matches or [(None, None)])]
    return sorted(out, key=str)


def test_hot_keys_are_those_above_the_share(spark):
    _, right = frames(spark)
    assert [r[0] for r in hot_keys(right, "k", share=4).collect()] == ["hot"]
    assert hot_keys(right, "k", share=2).count() == 0
    assert hot_keys(spark.range(5), "id").count() == 0


def test_join_equals_a_plain_left_join(spark):
    left, right = frames(spark)
    for salts, share in ((5, 10), (64, 10), (5, 1)):
        joined = spread_left_join(left, right, "k", salts=salts, share=share)
        assert joined.columns == ["k", "l", "r", "note"]
        assert sorted(map(tuple, joined.collect()), key=str) == expected()


def test_distinct_keeps_one_row_per_selected_tuple(spark):
    left, right = frames(spark)
    joined = spread_left_join(
        left, right, "k", salts=5, share=10, distinct=[F.col("k"), F.col("l"), F.col("note")], slice_by=["note"]
    )
    assert sorted(map(tuple, joined.collect()), key=str) == sorted({(k, x, n) for k, x, _, n in expected()}, key=str)


def test_hot_rows_land_in_many_tasks(spark):
    left = spark.createDataFrame([("hot", 1)], "k string, l int")
    right = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_left_join(left, right, "k", salts=16)
        placed = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r[1] for r in placed) == 2000
    assert len(placed) > 1


def test_join_with_a_stored_side_equals_a_plain_left_join(spark):
    left, right = frames(spark)
    for salts, share, buckets in ((5, 10, 3), (64, 10, None), (5, 1, 8)):
        name = f"side_{uuid.uuid4().hex}"
        store_side(right, "k", name, buckets, salts=salts, share=share)
        joined = spread_left_join(left, open_side(spark, "k", name, salts), "k")
        assert joined.columns == ["k", "l", "r", "note"]
        assert sorted(map(tuple, joined.collect()), key=str) == expected()


def test_hot_rows_are_stored_in_many_buckets(spark):
    right = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("r"))
    stored = store_side(right, "k", f"side_{uuid.uuid4().hex}", 4, salts=16)
    assert len({f.rsplit("_", 1)[1] for f in stored.rows.inputFiles()}) > 1
    assert [r["k"] for r in stored.hot.collect()] == ["hot"]
