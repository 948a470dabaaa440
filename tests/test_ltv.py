import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks import sample_sources as src
from vintner.config import LTV_LEVELS
from vintner.operators import ltv

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "customer_id bigint, acquisition_date timestamp_ntz, "
    + ", ".join(f"{n} string" for n in LTV_LEVELS)
    + ", canceled_day_1 int, month_age int, recurring_period_days int, initial_sub_amount decimal(18,2),"
    " cross_amount decimal(18,2), upsell_amount decimal(18,2), resub_amount decimal(18,2),"
    " downsell_amount decimal(18,2), refund_amount decimal(18,2)"
)
DAY = dt.datetime(2024, 1, 1, 13)


def bill(customer, age=0, period=30, initial=None, refund=None, canceled=0, dims=("b", "s", "c", "p", "m"), day=DAY):
    from decimal import Decimal

    money = [None if x is None else Decimal(x) for x in (initial, None, None, None, None, refund)]
    return (customer, day, *dims, canceled, age, period, *money)


def cohorts(spark, rows, **kw):
    return ltv.ltv_cohorts(spark.createDataFrame(rows, SCHEMA), **kw)


def test_sizes_cancellations_and_values(spark):
    rows = [
        bill(1, 0, initial=10),
        bill(1, 2, initial=5, refund=1),  # age 2 counts from three months on
        bill(1, 2, period=60, initial=7),  # 2 months of 60 days: age 4
        bill(2, 0, initial=20, canceled=1),
        bill(2, 0, initial=1),
        bill(None, 0, initial=100, canceled=1),  # adds to the sums, not to the size
    ]
    (r,) = cohorts(spark, rows, depths=[5]).collect()
    assert r["acquisition_date"] == dt.date(2024, 1, 1) and r["level"] == "mobile"
    assert (r["cohort_size"], r["canceled_day_1"]) == (2, 0.5)
    assert (r["ltv_1mo"], r["ltv_3mo"], r["ltv_6mo"]) == (131 / 2, 135 / 2, 142 / 2)


def test_a_customer_in_two_tuples_counts_once_per_prefix(spark):
    rows = [
        bill(1, initial=1, dims=("b", "s", "c", "p", "yes"), canceled=1),
        bill(1, initial=2, dims=("b", "s", "c", "p", "no")),
        bill(2, initial=4, dims=("b", "s", "other", "p", None)),
    ]
    out = defaultdict(list)
    for r in cohorts(spark, rows).collect():
        out[r["level"]].append((r["cohort_size"], r["canceled_day_1"], r["ltv_1mo"]))
    assert sorted(out["acquisition_sku_bucket"]) == [(2, 0.5, 3.5)]
    assert sorted(out["payment_type"]) == [(1, 0.0, 4.0), (1, 1.0, 3.0)]
    assert sorted(out["mobile"]) == [(1, 0.0, 2.0), (1, 0.0, 4.0), (1, 1.0, 1.0)]


def test_prefixes_are_built_without_another_customer_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ltv.ltv_cohorts(spark.createDataFrame([bill(1)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # tuples and customers, placement by customer, cohorts
    assert len(exchanges) == 3
    assert sum("customer_id" in line for line in exchanges) == 2


def test_group_gate_counts_all_days_and_keeps_null_groups(spark):
    frame = spark.createDataFrame(
        [("a", 30), ("a", 21), ("b", 50), (None, 51)], "g string, cohort_size bigint"
    )
    kept = ltv.large_groups(frame, ["g"], 50)
    assert sorted((str(r["g"]), r["cohort_size"]) for r in kept.collect()) == [("None", 51), ("a", 21), ("a", 30)]


@pytest.mark.parametrize(
    ("target", "days"), [("canceled_day_1", 75), ("ltv_1mo", 75), ("ltv_3mo", 135), ("ltv_6mo", 225), ("ltv_12mo", 405)]
)
def test_blackout_days(target, days):
    assert ltv.blackout_days(target) == days


def test_blackout_is_taken_from_the_last_day_of_each_group(spark):
    rows = [("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 3, 15)), ("a", dt.date(2024, 3, 16)), ("b", dt.date(2023, 1, 1))]
    df = spark.createDataFrame([*rows, ("a", dt.date(2024, 5, 30))], "g string, ds date")
    kept = ltv.before_blackout(df, ["g"], "ltv_1mo").collect()
    assert sorted(map(tuple, kept)) == [("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 3, 15)), ("a", dt.date(2024, 3, 16))]


def test_calendar_and_series_joins(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 3), 3.0)], "g string, ds date, y double")
    calendar = ltv.future_calendar(df, ["g"], days=2)
    assert [r["ds"].day for r in calendar.orderBy("ds").collect()] == [1, 2, 3, 4, 5]
    forecast = calendar.filter("ds >= date'2024-01-03'").withColumn("yhat", F.lit(9.0))
    assert ltv.with_earlier_predictions(calendar, forecast, ["g"]).count() == 3
    both = {r["ds"].day: (r["yhat"], r["y"]) for r in ltv.with_actuals(forecast, df, ["g"]).collect()}
    assert both == {1: (None, 1.0), 3: (9.0, 3.0), 4: (9.0, None), 5: (9.0, None)}
    history = {r["ds"].day: r["yhat"] for r in ltv.onto_history(df, forecast, ["g"]).collect()}
    assert history == {1: None, 3: 9.0}


def test_sample_cohorts_add_up_to_all_customers(spark):
    billings = src.customer_billings(spark, SF)
    out = ltv.ltv_cohorts(billings)
    customers = billings.select("customer_id").distinct().count()
    # dimensions are constant per customer here, so every prefix counts each customer once
    sums = {r["level"]: r["n"] for r in out.groupBy("level").agg(F.sum("cohort_size").alias("n")).collect()}
    assert sums == {level: customers for level in LTV_LEVELS[1:]}
