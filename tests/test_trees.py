from pyspark.sql import functions as F

from vintner.config import TreeParams
from vintner.operators import trees
from vintner.operators.preprocess import Categories, Inputs

PARAMS = TreeParams(trees=4, depth=3, bins=32)


def frame(spark):
    x = F.pmod(F.xxhash64("id"), F.lit(1000)) / 10
    brand = F.concat(F.lit("b"), (F.col("id") % 5).cast("string"))
    return spark.range(600).select("id", brand.alias("brand"), x.alias("x"), (x * 2 + F.col("id") % 5).alias("y"))


def predictions(spark, layout):
    rows = frame(spark).repartition(layout)
    fitted, models = trees.fit(rows, ["y"], Inputs(["brand"], ["x"]), PARAMS)
    return {r["id"]: r["y_yhat"] for r in trees.predict(rows, fitted, models).select("id", "y_yhat").collect()}


def test_predictions_do_not_depend_on_the_layout(spark):
    first = predictions(spark, 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for layout in (3, 8, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(layout))
            assert predictions(spark, layout) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_full_tree_over_one_category_gives_the_means(spark):
    rows = frame(spark)
    params = TreeParams(trees=1, depth=6, row_share=1.0, column_share=1.0)
    fitted, models = trees.fit(rows, ["y"], Inputs(["brand"], []), params)
    both = trees.predict(rows, fitted, models).join(rows.groupBy("brand").agg(F.avg("y").alias("m")), "brand")
    assert both.filter(F.abs(F.col("y_yhat") - F.col("m")) > 1e-9).isEmpty()
    assert {name.split("_")[0] for name, _ in models[0].importances()} == {"cat"}


def test_partitions_follow_the_rows():
    assert [trees.partitions_for(n, 100) for n in (0, 1, 100, 101, 200, 201, 400, 801, 10**6)] == [1, 1, 1, 2, 2, 4, 4, 16, 16384]


def test_predictions_from_many_partitions_do_not_depend_on_the_layout(spark):
    params = TreeParams(trees=3, depth=3, bins=32, rows_per_partition=100)
    rows = frame(spark)
    found = []
    for layout in (1, 9):
        fitted, models = trees.fit(rows.repartition(layout), ["y"], Inputs(["brand"], ["x"]), params)
        found.append({r["id"]: r["y_yhat"] for r in trees.predict(rows, fitted, models).select("id", "y_yhat").collect()})
    assert found[0] == found[1]


def test_categories_learnt_once_give_the_same_trees(spark):
    """Places of categories that the training rows lack are zero there; a whole tree over the rest is the same."""
    rows = frame(spark).withColumn("brand", F.when(F.col("id") < 590, F.col("brand")).when(F.col("id") < 595, F.lit("new")))
    train = rows.filter("id < 590")
    params = TreeParams(trees=3, depth=4, row_share=1.0, column_share=1.0, bins=64)
    inputs = Inputs(["brand"], ["x"])
    fitted, models = trees.fit(train, ["y"], inputs, params)
    plain = {r["id"]: r["y_yhat"] for r in trees.predict(rows, fitted, models).collect()}
    known = Categories.of(rows, ["brand"])
    placed = known.with_places(rows)
    fitted, models = trees.fit(placed.filter("id < 590"), ["y"], inputs, params, known, 590)
    shared = trees.predict(placed, fitted, models)
    assert {r["id"]: round(r["y_yhat"], 9) for r in shared.collect()} == {k: round(v, 9) for k, v in plain.items()}
    assert known.sizes == {"brand": 7} and {n for n, _ in models[0].importances()} <= {"num__x", *(f"cat__brand_b{i}" for i in range(5))}
