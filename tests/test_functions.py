import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from vintner.functions import dates, safe, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("n", "d", "expected"),
    [(1.0, 2.0, 0.5), (1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (None, 2.0, None), (1.0, None, None), (None, 0.0, None)],
)
def test_div0(spark, n, d, expected):
    assert one(spark, safe.div0(F.lit(n).cast("double"), F.lit(d).cast("double"))) == expected


@pytest.mark.parametrize(
    ("n", "d", "expected"), [(1.0, 4.0, 0.25), (1.0, 0.0, None), (0.0, 0.0, None), (None, 1.0, None), (1.0, None, None)]
)
def test_ratio(spark, n, d, expected):
    assert one(spark, safe.ratio(F.lit(n).cast("double"), F.lit(d).cast("double"))) == expected


def test_nan_becomes_null_and_masks_are_certain(spark):
    df = spark.createDataFrame([(1, math.nan), (2, 500.0), (3, None)], "id int, x double")
    out = safe.nan_to_null(df).withColumn("m", safe.certain(F.col("x") >= 400)).orderBy("id")
    assert [tuple(r) for r in out.collect()] == [(1, None, False), (2, 500.0, True), (3, None, False)]


@pytest.mark.parametrize(
    ("reference", "expected"),
    [
        ("005928639", 5928639),
        ("TXN_5928639", 5928639),
        ("TXNA17", 17),  # _ is a wildcard
        ("TXN", None),
        ("abc", None),
        ("", None),
        (None, None),
        ("12.6", 13),
    ],
)
def test_transaction_id(spark, reference, expected):
    assert one(spark, text.transaction_id(F.lit(reference).cast("string"))) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("mc", "mastercard"), ("MC", "mastercard"), ("M C", "mastercard"), ("mcx", "mcx"), ("American Express", "americanexpress"), (None, None)],
)
def test_card_network(spark, raw, expected):
    assert one(spark, text.card_network(F.lit(raw).cast("string"))) == expected


def test_merchant_label_and_quotes(spark):
    assert one(spark, text.merchant_label(F.lit("Shop, Inc  x"), F.lit("9"))) == "SHOP LLC X - 9"
    assert one(spark, text.unquoted_id(F.lit("''12'3"))) == "12'3"


def test_joined_text_digits_and_ids(spark):
    assert one(spark, text.joined(F.lit("a"), F.lit(1))) == "a-1"
    assert text.digits_in("ltv_12mo") == 12
    assert text.digits_in("canceled_day_1") == 1
    import hashlib

    assert one(spark, text.record_id("m", "s", F.lit(True))) == hashlib.sha256(b"m|s|true").hexdigest()


@pytest.mark.parametrize(
    ("as_of", "months", "expected"),
    [
        ((2024, 8, 31), 6, (2024, 2, 29)),
        ((2024, 3, 15), 6, (2023, 9, 15)),
        ((2024, 6, 30), 6, (2023, 12, 30)),
        ((2025, 1, 31), 1, (2024, 12, 31)),
        ((2023, 8, 31), 6, (2023, 2, 28)),
    ],
)
def test_months_back(as_of, months, expected):
    assert dates.months_back(dt.date(*as_of), months) == dt.date(*expected)


def test_local_date_bound(spark):
    day = dt.date(2024, 1, 10)
    rows = [
        (dt.datetime(2024, 1, 10, 7, 59), False),  # 23:59 of the day before in Los Angeles
        (dt.datetime(2024, 1, 10, 8, 0), True),
        (dt.datetime(2024, 1, 1), False),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, expected boolean")
    got = df.withColumn("got", dates.since_local_date(F.col("ts"), day)).collect()
    assert all(r["got"] == r["expected"] for r in got)


def test_matured_is_strict(spark):
    as_of = dt.date(2024, 1, 31)
    days = [(dt.date(2024, 1, 1),), (dt.date(2023, 12, 31),)]
    df = spark.createDataFrame(days, "d date").select(dates.matured(F.col("d"), 30, as_of).alias("m"))
    assert [r[0] for r in df.collect()] == [False, True]


def test_zone_and_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2), 1)], "ts timestamp, d date, n int")
    assert dict(dates.without_zone(df).dtypes) == {"ts": "timestamp_ntz", "d": "date", "n": "int"}
    assert tuple(dates.day_text(df).first()) == ("2024-01-02", "2024-01-02", 1)
    assert df.select(dates.iso_text(F.col("ts"))).first()[0] == "2024-01-02T03:04:05Z"
    assert safe.upper_names(df).columns == ["TS", "D", "N"]
