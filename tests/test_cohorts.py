import datetime as dt

from pyspark.sql import functions as F

from checks import sample_sources as src
from vintner import config as c
from vintner.config import LEVELS, Level
from vintner.operators import cohorts
from vintner.plans.cohort_dataset import cohort_dataset

SF = "/root/testdata/sf0.001"
AS_OF, START = dt.date(2024, 3, 1), dt.date(2023, 1, 1)
GROSS = """gross_add__created__day date, brand string, sku_type string, channel string, traffic_source string,
campaign string, gross_add__type string, plan__is_promo boolean, plan__promo_price int, plan__promo_days int,
plan__recurring_price int, plan__recurring_days int, gross_adds bigint, gross_adds_canceled_day_one bigint,
gross_adds_canceled_day_three bigint, gross_adds_canceled_day_seven bigint"""


def row(day, promo=True, campaign="c", brand="b", adds=10, canceled=(1, 2, 3), price=4, recurring=8):
    return (day, brand, "s", "ch", "t", campaign, "new", promo, price, 7, recurring, 30, adds, *canceled)


def spine(spark, rows, level="CAMPAIGN", excluded=None):
    df = spark.createDataFrame(rows, GROSS)
    return cohorts.cohort_spine(df, Level(level), AS_OF, START, excluded)


def test_counts_rates_and_averages(spark):
    rows = [
        row(dt.date(2024, 1, 5), adds=10, price=4),
        row(dt.date(2024, 1, 30), adds=30, price=8),  # 31 days old: over 30, not over 60
        row(dt.date(2022, 12, 31)),  # before the start
    ]
    r = spine(spark, rows).first()
    assert r["cohort_month"] == dt.date(2024, 1, 1)
    assert r["gross_adds"] == 40
    assert (r["gross_adds_created_over_30_days_ago"], r["gross_adds_created_over_60_days_ago"]) == (40, 0)
    assert r["gross_adds_canceled_day_one"] == 2 and r["gross_adds_canceled_day_one_rate"] == 2 / 40
    assert r["avg_promo_price"] == (10 * 4 + 30 * 8) / 40
    assert r["promo_to_recurring_price_ratio"] == 7.0 / 8


def test_immature_cohort_has_zero_rate_and_regular_rows_no_promo_terms(spark):
    r = spine(spark, [row(dt.date(2024, 2, 29), promo=False)]).first()
    assert r["gross_adds_created_over_1_days_ago"] == 0
    assert r["gross_adds_canceled_day_one_rate"] == 0.0
    assert r["avg_promo_days"] is None and r["promo_to_recurring_days_ratio"] is None
    assert r["avg_recurring_days"] == 30.0


def test_missing_campaign_and_excluded_or_unknown_brand(spark):
    rows = [
        row(dt.date(2024, 1, 5), campaign=None),
        row(dt.date(2024, 1, 5), brand="gone"),
        row(dt.date(2024, 1, 5), brand=None),
    ]
    out = spine(spark, rows, excluded="gone").collect()
    assert [(r["brand"], r["campaign"]) for r in out] == [("b", "NONE")]  # unknown brand fails the comparison


def test_all_levels_equal_each_level(spark):
    gross = src.gross_add_metrics(spark, SF)
    together = cohorts.cohort_spine_all_levels(gross, src.AS_OF, src.START, src.EXCLUDED_BRAND).cache()
    for level in LEVELS:
        alone = cohorts.cohort_spine(gross, level, src.AS_OF, src.START, src.EXCLUDED_BRAND)
        mine = together.filter(F.col("level") == level.name).select(*alone.columns)
        assert sorted(map(str, mine.collect())) == sorted(map(str, alone.collect()))
        lower = [n for n in c.LEVEL_COLUMNS if n not in level.columns]
        if lower:
            assert together.filter(F.col("level") == level.name).filter(F.col(lower[0]).isNotNull()).isEmpty()


def test_null_keys_keep_the_spine_row_without_features(spark):
    gross = spark.createDataFrame([row(dt.date(2024, 1, 5), promo=None), row(dt.date(2024, 1, 5))], GROSS)
    keys = """gross_add__created__month date, gross_add__brand string, gross_add__sku_type string,
    gross_add__channel string, gross_add__traffic_source string, gross_add__campaign string,
    gross_add__type string, gross_add__plan__is_promo boolean"""
    key = (dt.date(2024, 1, 1), "b", "s", "ch", "t", "c", "new")
    counts = "survived_promo_activations_excl_retries eligible_promo_activations survived_first_rebills_excl_retries eligible_first_rebills".split()
    retention = spark.createDataFrame(
        [(*key, None, 1, 2, 3, 4), (*key, True, 1, 2, None, 0)], keys + "".join(f", {n} bigint" for n in counts)
    )
    billing = spark.createDataFrame(
        [(*key, True, *[None] * 8)],
        keys + "".join(f", net_billings_{n}_days_since_gross_add decimal(18,2)" for n in c.BILLING_DAYS),
    )
    cross = spark.createDataFrame(
        [(*key, True, 5, None, 1, None, 3)],
        keys + ", plan__recurring_price int, cross_sell_adds bigint" + "".join(f", {c.cross_sell_column(n)} bigint" for n in c.EARLY_DAYS),
    )
    from vintner.plans.cohort_dataset import CohortSources

    sources = CohortSources(gross, retention, billing, cross)
    out = {r["plan__is_promo"]: r for r in cohort_dataset(sources, Level("BRAND"), AS_OF, START).collect()}
    assert out[None]["eligible_promo_activations"] is None
    assert out[True]["promo_activation_rate_excl_retries"] == 0.5
    assert out[True]["first_rebill_rate_excl_retries"] == 0.0 and out[True]["survived_first_rebills_excl_retries"] == 0
    assert out[True]["net_billings_30_days"] is None  # billing sums stay NULL
    assert out[True]["total_cross_sell_adds"] is None and out[True]["avg_cross_sell_price"] == 0.0
    assert out[True]["cross_sell_adds_three_days_since_gross_add"] == 0

    clean = cohorts.clean_dataset(cohort_dataset(sources, Level("BRAND"), AS_OF, START))
    assert "net_billings_30_days" not in clean.columns
    assert dict(clean.dtypes)["cohort_month"] == "timestamp_ntz"
    promo = clean.filter("plan__is_promo").first()
    assert promo["cross_sell_adds_day_one_rate"] == 0.1 and promo["avg_net_billings_30_days"] is None


def test_dataset_joins_reuse_the_shuffles_of_the_aggregates(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = cohort_dataset(src.cohort_sources(spark, SF), Level("CAMPAIGN"), src.AS_OF, src.START)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # three joins on eight keys, but only the four aggregates shuffle by them
    assert sum("Exchange hashpartitioning(cohort_month" in line for line in plan.splitlines()) == 4
