import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vintner.operators import preprocess as p


def fit_values(spark, rows, schema, inputs):
    df = spark.createDataFrame(rows, schema)
    return df, p.fit(df, inputs)


def vectors(fitted, df):
    rows = fitted.transform(df).select(vector_to_array("features").alias("v")).collect()
    return [list(r["v"]) for r in rows]


@pytest.mark.parametrize(("impute", "fill"), [("median", 2.0), ("mean", 4.0), ("constant", 0.0)])
def test_imputation_and_scaling(spark, impute, fill):
    df, fitted = fit_values(spark, [(1.0,), (2.0,), (9.0,), (None,)], "x double", p.Inputs([], ["x"], impute=impute))
    filled = [1.0, 2.0, 9.0, fill]
    mean = sum(filled) / 4
    spread = math.sqrt(sum((v - mean) ** 2 for v in filled) / 4)
    assert fitted.fill["x"] == fill
    for got, value in zip(vectors(fitted, df), filled):
        assert got[0] == pytest.approx((value - mean) / spread)


def test_columns_without_values(spark):
    rows, schema = [(None, 5.0), (None, 5.0)], "x double, y double"
    df, fitted = fit_values(spark, rows, schema, p.Inputs([], ["x", "y"]))
    assert fitted.numeric == ["y"] and fitted.feature_names == ["num__y"]
    assert vectors(fitted, df) == [[0.0], [0.0]]  # constant column: spread 0 divides by 1
    _, zeros = fit_values(spark, rows, schema, p.Inputs([], ["x"], impute="constant"))
    assert zeros.numeric == ["x"] and zeros.fill == {"x": 0.0}


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown imputation"):
        fit_values(spark, [(1.0,)], "x double", p.Inputs([], ["x"], impute="mode"))


def test_one_hot_missing_and_unseen(spark):
    inputs = p.Inputs(["a", "b"], [])
    df, fitted = fit_values(spark, [("u", "x"), (None, "y"), ("v", "z")], "a string, b string", inputs)
    assert fitted.feature_names == ["cat__a_u", "cat__a_unknown", "cat__a_v", "cat__b_x", "cat__b_y", "cat__b_z"]
    assert vectors(fitted, df) == [[1, 0, 0, 1, 0, 0], [0, 1, 0, 0, 1, 0], [0, 0, 1, 0, 0, 1]]
    new = spark.createDataFrame([("new", "x")], "a string, b string")
    assert vectors(fitted, new) == [[0, 0, 0, 1, 0, 0]]


def test_rare_categories_share_a_bucket(spark):
    values = ["a"] * 5 + ["b"] * 3 + ["c"] * 3 + ["d"]
    df, fitted = fit_values(spark, [(v,) for v in values], "x string", p.Inputs(["x"], [], max_categories=3))
    # two keep their name; of the equally frequent b and c the later one does
    assert fitted.feature_names == ["cat__x_a", "cat__x_c", f"cat__x_{p.RARE}"]
    frame = spark.createDataFrame([("a",), ("b",), ("d",), ("new",), (None,)], "x string")
    labels = {r["x"]: r["l"] for r in fitted.with_labels(frame, {"l": "x"}).collect()}
    assert labels == {"a": "a", "b": p.RARE, "d": p.RARE, "new": "new", None: p.UNKNOWN}
    rows = fitted.transform(frame).select("x", vector_to_array("features").alias("v")).collect()
    assert {r["x"]: list(r["v"]) for r in rows} == {
        "a": [1, 0, 0], "b": [0, 0, 1], "d": [0, 0, 1], "new": [0, 0, 0], None: [0, 0, 0]
    }


@pytest.mark.parametrize(("limit", "rare"), [(4, False), (3, True)])
def test_limit_counts_the_bucket(spark, limit, rare):
    _, fitted = fit_values(spark, [("a",), ("b",), ("c",)], "x string", p.Inputs(["x"], [], max_categories=limit))
    assert (f"cat__x_{p.RARE}" in fitted.feature_names) == rare
    assert fitted.sizes == {"x": 3}


def test_very_many_categories(spark):
    df = spark.range(200_000).selectExpr("concat('c', lpad(id, 6, '0')) AS x", "id AS n")
    fitted = p.fit(df, p.Inputs(["x"], []))
    assert fitted.sizes == {"x": 200_000} and fitted.names_of([5, 199_999]) == {5: "cat__x_c000005", 199_999: "cat__x_c199999"}
    placed = fitted.with_positions(df, {"place": "x"})
    assert placed.filter("place <> n").isEmpty()
    vector = fitted.transform(df.filter("n = 123456")).first()["features"]
    assert vector.size == 200_000 and list(vector.indices) == [123456]


def test_booleans(spark):
    df, fitted = fit_values(spark, [(True,), (False,), (None,)], "f boolean", p.Inputs([], [], ["f"]))
    assert sorted(vectors(fitted, df)) == [[-1.0], [0.0], [1.0]]
    _, only_true = fit_values(spark, [(True,)], "f boolean", p.Inputs([], [], ["f"]))
    assert sorted(vectors(only_true, df)) == [[-1.0], [-1.0], [0.0]]


def test_statistics_come_from_the_training_rows_only(spark):
    df = spark.createDataFrame([(1.0, True), (3.0, True), (100.0, False)], "x double, train boolean")
    fitted = p.fit(df.filter("train"), p.Inputs([], ["x"]))
    scaled = [r[0] for r in df.orderBy("x").select(fitted.scaled("x")).collect()]
    assert scaled == [-1.0, 1.0, 98.0]


def test_time_series_frame(spark):
    import datetime as dt

    df, fitted = fit_values(
        spark, [(dt.date(2024, 1, 1), 1.0, "a", 5), (dt.date(2024, 1, 2), 3.0, "b", None)],
        "d date, x double, c string, y int", p.Inputs(["c"], ["x"], impute="constant"),
    )
    frame = p.time_series_frame(df, fitted, "d", "y")
    assert frame.columns == ["ds", "num__x", "cat__c_a", "cat__c_b", "y"]
    assert tuple(frame.orderBy("ds").first()) == (dt.datetime(2024, 1, 1), -1.0, 1.0, 0.0, 5.0)
    assert "y" not in p.time_series_frame(df.drop("y"), fitted, "d", "y").columns


def test_two_hundred_thousand_categories_are_one_sparse_vector(spark):
    rows = spark.range(200_000).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"), F.current_date().alias("day")
    )
    fitted = p.fit(rows, p.Inputs(["c"], ["x"], impute="constant"))
    vectors = p.series_vectors(rows, fitted, "day", "y", ["c"])
    assert vectors.columns == ["c", "ds", "features", "y"] and fitted.width == 200_001
    some = vectors.filter("c IN ('c7', 'c199999')").collect()
    assert all(r["features"].size == 200_001 and r["features"].numNonzeros() == 2 for r in some)
    places = {r["c"]: int(r["features"].indices[1]) for r in some}
    assert fitted.names_of(list(places.values())) == {place: f"cat__c_{c}" for c, place in places.items()}
