"""Every operator as a query over the sample tables, and its SQL where SQL can say it.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` maps the same name to SQL.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle as o
from checks import sample_sources as src
from vintner import config as c
from vintner.config import CascadeSettings, Level, TreeParams
from vintner.functions import dates, safe, text
from vintner.operators import cohort_masks as masks
from vintner.operators import cohorts, dashboard, features, forecasting, ltv, metrics, order_stats, preprocess, risk, seasonal, trees
from vintner.plans import cascade as cascade_plan
from vintner.plans import cohort_dataset as dataset_plan
from vintner.plans import load_store, ltv_forecast, risk_report
from vintner.sources import cache, sinks, storage

O_KEYS = f"{o.MONTH} AS cohort_month, plan__is_promo, gross_add__type, brand"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

BRAND, SKU_TYPE, CHANNEL, TRAFFIC_SOURCE, CAMPAIGN = (Level(n.upper()) for n in c.LEVEL_COLUMNS)
# few, shallow trees: the same code path at a size a laptop finishes
SMALL_TREES = TreeParams(trees=3, depth=3, bins=32)
SETTINGS = CascadeSettings(min_cohort_size=src.MIN_COHORT_SIZE, evaluate=False, trees=SMALL_TREES)
BILLING_365 = next(s for s in c.STEPS if s.name == "AVG_NET_BILLINGS_365_DAYS")
DAY_3 = c.STEPS[0]
FIRST_REBILL = c.STEPS[3]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def plain(df: DataFrame, digits: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """Decimals as doubles, dates as text, and doubles rounded where their value depends on the order
    of a floating-point sum. A quotient of exact sums is the same in every engine and stays as it is."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    out = dates.day_text(df.withColumns({d: F.col(d).cast("double") for d in decimals}))
    if digits is None:
        return out
    doubles = [f.name for f in out.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return out.withColumns({c_: F.round(c_, digits) for c_ in columns or doubles})


def clean(spark, sf, level: Level = BRAND) -> DataFrame:
    return dataset_plan.load_clean_dataset(
        src.cohort_sources(spark, sf), src.AS_OF, src.START, level, src.EXCLUDED_BRAND
    )


# --- cohort dataset ------------------------------------------------------------------------------


def _spine(level):
    def run(spark, sf):
        gross = src.gross_add_metrics(spark, sf)
        return plain(cohorts.cohort_spine(gross, level, src.AS_OF, src.START, src.EXCLUDED_BRAND))

    return run


query("cohort_spine", o.cohort(o.spine(BRAND)))(_spine(BRAND))
query("cohort_spine_campaign", o.cohort(o.spine(CAMPAIGN)))(_spine(CAMPAIGN))


@query("levels_all", o.cohort(o.levels_all()))
def levels_all(spark, sf):
    gross = src.gross_add_metrics(spark, sf)
    return plain(cohorts.cohort_spine_all_levels(gross, src.AS_OF, src.START, src.EXCLUDED_BRAND))


@query(
    "spine_preview",
    f"""SELECT {o.MONTH} AS cohort_month, plan__is_promo, gross_add__type, brand, gross_adds FROM ({o.spine(BRAND)}) s
ORDER BY gross_adds DESC, s.cohort_month, plan__is_promo, gross_add__type, brand LIMIT 25""",
)
def spine_preview(spark, sf):
    spine = cohorts.cohort_spine(src.gross_add_metrics(spark, sf), BRAND, src.AS_OF, src.START, src.EXCLUDED_BRAND)
    top = spine.select(*BRAND.keys, "gross_adds").orderBy(F.desc("gross_adds"), *BRAND.keys).limit(25)
    return plain(top)


@query("retention_view", o.cohort(o.retention(SKU_TYPE)))
def retention_view(spark, sf):
    return plain(cohorts.retention_view(src.retention_metrics(spark, sf), SKU_TYPE))


@query("billing_view", o.cohort(o.billing(SKU_TYPE)))
def billing_view(spark, sf):
    return plain(cohorts.billing_view(src.billing_metrics(spark, sf), SKU_TYPE))


@query("cross_sell_view", o.cohort(o.cross_sell(SKU_TYPE)))
def cross_sell_view(spark, sf):
    return plain(cohorts.cross_sell_view(src.cross_sell_metrics(spark, sf), SKU_TYPE))


@query("cohort_dataset", o.cohort(o.dataset(CHANNEL)))
def cohort_dataset(spark, sf):
    sources = src.cohort_sources(spark, sf)
    return plain(dataset_plan.cohort_dataset(sources, CHANNEL, src.AS_OF, src.START, src.EXCLUDED_BRAND))


@query("cohort_dataset_clean", o.cohort(o.clean(BRAND)))
def cohort_dataset_clean(spark, sf):
    return plain(clean(spark, sf))


@query("cohort_dataset_campaign", o.cohort(o.clean(CAMPAIGN)))
def cohort_dataset_campaign(spark, sf):
    return plain(clean(spark, sf, CAMPAIGN))


@query(
    "timestamps_without_zone",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def timestamps_without_zone(spark, sf):
    zoned = src.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    local = dates.without_zone(zoned)
    return local.select("event_id", dates.iso_text(F.col("ts")).alias("iso"), F.date_format("ts", "yyyy-MM-dd").alias("day"))


# --- scalar cleaning -----------------------------------------------------------------------------


@query(
    "txn_id_parse",
    f"""SELECT {o.REFERENCE} AS ref, CAST(l_orderkey AS BIGINT) AS txn_id, count(*) AS n
FROM lineitem GROUP BY 1, 2
UNION ALL SELECT l_returnflag || l_linestatus AS ref, CAST(NULL AS BIGINT) AS txn_id, count(*) AS n
FROM lineitem GROUP BY 1, 2""",
)
def txn_id_parse(spark, sf):
    lines = src.table(spark, sf, "lineitem")
    good = lines.select(src.reference_text().alias("ref"))
    bad = lines.select(F.concat("l_returnflag", "l_linestatus").alias("ref"))
    refs = good.union(bad).groupBy("ref").agg(F.count("*").alias("n"))
    return refs.select("ref", text.transaction_id(F.col("ref")).alias("txn_id"), "n")


@query(
    "card_network_clean",
    f"""SELECT raw, {o.CLEAN_NETWORK.replace("card_network", "raw")} AS network, count(*) AS n
FROM (SELECT {o.NETWORK} AS raw FROM lineitem) GROUP BY raw""",
)
def card_network_clean(spark, sf):
    raw = src.risk_sources(spark, sf).adyen_payments.groupBy(F.col("Payment Method").alias("raw"))
    return raw.agg(F.count("*").alias("n")).withColumn("network", text.card_network(F.col("raw")))


@query(
    "merchant_name_clean",
    """SELECT 'SHOP LLC ' || (l_suppkey % 4) || ' - ' || (l_suppkey % 3) AS merchant, 'bt' || l_orderkey AS ref,
count(*) AS n FROM lineitem WHERE l_suppkey % 9 = 0 GROUP BY ALL""",
)
def merchant_name_clean(spark, sf):
    report = src.risk_sources(spark, sf, with_worldpay=True).worldpay_chargebacks
    return report.groupBy(
        text.merchant_label(F.col("Merchant Name"), F.col("MID")).alias("merchant"),
        text.unquoted_id(F.col("Vantiv Payment ID")).alias("ref"),
    ).agg(F.count("*").alias("n"))


@query(
    "events_json_tz_filter",
    f"""SELECT event_id, json_extract_string(props, '$.k') AS k FROM events
WHERE {o.LA.format("ts")} >= TIMESTAMP '2024-01-10' AND json_extract_string(props, '$.k') <> '7'
AND event_type IN ('click', 'purchase') AND event_type NOT ILIKE '%CLI%'""",
)
def events_json_tz_filter(spark, sf):
    k = F.get_json_object("props", "$.k")
    return (
        src.table(spark, sf, "events")
        .filter(dates.since_local_date(F.col("ts"), dt.date(2024, 1, 10)) & (k != "7"))
        .filter(F.col("event_type").isin("click", "purchase") & ~F.col("event_type").ilike("%CLI%"))
        .select("event_id", k.alias("k"))
    )


@query(
    "step_ids",
    """SELECT brand, step, promo, sha256(brand || '|' || step || '|plan__is_promo=' || promo) AS id, n
FROM (SELECT r_name AS brand, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS promo, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL), (SELECT unnest(["""
    + ", ".join(f"'{s.name}'" for s in c.STEPS)
    + "]) AS step)",
)
def step_ids(spark, sf):
    gross = src.gross_add_metrics(spark, sf)
    groups = gross.groupBy("brand", "plan__is_promo").agg(F.count("*").alias("n"))
    steps = groups.withColumn("step", F.explode(F.array(*[F.lit(s.name) for s in c.STEPS])))
    return steps.select(
        "brand",
        "step",
        F.col("plan__is_promo").cast("string").alias("promo"),
        cascade_plan.step_id(F.col("brand"), F.col("step"), F.col("plan__is_promo")).alias("id"),
        "n",
    )


# --- payment risk --------------------------------------------------------------------------------

EXCLUSIONS = dict(excluded_adyen="M7", excluded_braintree="m4", excluded_worldpay="llc 3")


def events(spark, sf, with_worldpay=False) -> DataFrame:
    return risk_report.processor_events(
        src.risk_sources(spark, sf, with_worldpay), risk.ReportWindow(src.RISK_START), **EXCLUSIONS
    )


@query("processor_events", o.events())
def processor_events(spark, sf):
    return events(spark, sf)


@query("processor_events_stored", o.events(with_worldpay=True))
def processor_events_stored(spark, sf):
    """The history stored bucketed by both ids and opened again, as each later report would."""
    sources, name = src.risk_sources(spark, sf, with_worldpay=True), f"vintner_{uuid.uuid4().hex}"
    risk.store_transactions(sources.transactions, name)
    sources = dataclasses.replace(sources, transactions=risk.open_transactions(spark, name))
    return risk_report.processor_events(sources, risk.ReportWindow(src.RISK_START), **EXCLUSIONS)


@query("processor_events_union", o.events(with_worldpay=True))
def processor_events_union(spark, sf):
    return events(spark, sf, with_worldpay=True)


@query(
    "reference_coverage",
    f"""SELECT processor, type, count(DISTINCT ref_txn_id) AS "references",
count(DISTINCT CASE WHEN txn_id IS NULL THEN ref_txn_id END) AS without_id FROM ({o.events(True)}) GROUP BY processor, type""",
)
def reference_coverage(spark, sf):
    return risk.reference_coverage(events(spark, sf, with_worldpay=True))


@query("risk_ratio", o.risk_one("card_network"))
def risk_ratio(spark, sf):
    return plain(risk.risk_ratios(events(spark, sf), ["card_network"]))


@query("risk_all_levels", o.risk_all(src.MIN_BAD_COUNT))
def risk_all_levels(spark, sf):
    return plain(risk.risk_all_levels(events(spark, sf), min_bad_count=src.MIN_BAD_COUNT))


@query("risk_report", o.risk_all(20).replace("1996-01-01", "2001-02-02"))
def risk_report_job(spark, sf):
    """The job from its date on: window of six months, cached events, stored report."""
    folder = storage.scratch_path(spark, "risk-report")
    sink = sinks.make_sink("parquet", folder)
    sources = src.risk_sources(spark, sf)
    for _ in range(2):  # the second run reads the events that the first one stored
        risk_report.risk_report(sources, dt.date(2001, 8, 2), 20, f"{folder}/cache", sink, **EXCLUSIONS)
    stored = sinks.read(spark, sink.path("threshold_all_levels"))
    return plain(stored.toDF(*(name.lower() for name in stored.columns)))


@query("risk_pairs", o.risk_combinations(range(2, 3), 100))
def risk_pairs(spark, sf):
    return plain(risk.risk_combinations(events(spark, sf), min_bad_count=100))


@query("risk_all_combinations", o.risk_combinations(range(2, 10), 100))
def risk_all_combinations(spark, sf):
    return plain(risk.risk_combinations(events(spark, sf), risk.level_combinations(), min_bad_count=100))


# --- lifetime value ------------------------------------------------------------------------------


@query("ltv_cohorts", o.ltv_plain(o.ltv([5])))
def ltv_cohorts(spark, sf):
    return plain(ltv.ltv_cohorts(src.customer_billings(spark, sf), depths=[5]))


@query("ltv_hierarchy", o.ltv_plain(o.ltv([2, 3, 4, 5])))
def ltv_hierarchy(spark, sf):
    return plain(ltv.ltv_cohorts(src.customer_billings(spark, sf)))


@query("ltv_report", o.ltv_plain(f"SELECT * FROM ({o.ltv([3])}) ORDER BY acquisition_date, cohort_size DESC"))
def ltv_report(spark, sf):
    return plain(ltv.ltv_report(src.customer_billings(spark, sf), 3))


LTV_TWO = o.ltv([2])


@query(
    "ltv_group_gate",
    f"""WITH x AS ({LTV_TWO}) SELECT * REPLACE ({o.LTV_DAY} AS acquisition_date)
FROM (SELECT x.* FROM x SEMI JOIN (SELECT brand, acquisition_sku_bucket FROM x GROUP BY ALL HAVING sum(cohort_size) > 50)
USING (brand, acquisition_sku_bucket))""",
)
def ltv_group_gate(spark, sf):
    groups = ltv.ltv_cohorts(src.customer_billings(spark, sf), depths=[2])
    return plain(ltv.large_groups(groups, ["brand", "acquisition_sku_bucket"]))


@query(
    "blackout_filter",
    f"""WITH x AS ({LTV_TWO}) SELECT brand, acquisition_sku_bucket, {o.LTV_DAY} AS acquisition_date, ltv_3mo
FROM (SELECT *, max(acquisition_date) OVER (PARTITION BY brand, acquisition_sku_bucket) AS last FROM x)
WHERE acquisition_date <= last - INTERVAL 135 DAY""",
)
def blackout_filter(spark, sf):
    keys = ["brand", "acquisition_sku_bucket"]
    series = ltv.ltv_cohorts(src.customer_billings(spark, sf), depths=[2])
    kept = ltv.before_blackout(series, keys, "ltv_3mo", date="acquisition_date")
    return plain(kept.select(*keys, "acquisition_date", "ltv_3mo"))


# --- preprocessing -------------------------------------------------------------------------------

NUMERIC = ["avg_recurring_price", "avg_cross_sell_price", "avg_promo_days", "avg_net_billings_90_days"]
TRAINING = "cohort_month < TIMESTAMP '2000-01-01'"


def _training(df):
    return df.filter("cohort_month < timestamp_ntz'2000-01-01'")


@query(
    "impute_median",
    f"""WITH d AS ({o.clean(BRAND)}) """
    + " UNION ALL ".join(
        f"SELECT '{n}' AS name, {o.rnd(f'median({n})')} AS fill, count(*) FILTER ({n} IS NULL) AS missing FROM d WHERE {TRAINING}"
        for n in NUMERIC
    ),
)
def impute_median(spark, sf):
    train = storage.cut(_training(clean(spark, sf)).select(*NUMERIC))
    fill, _, _ = preprocess.numeric_statistics(train, NUMERIC, "median")
    fills = spark.createDataFrame(list(fill.items()), "name string, fill double")
    missing = train.select(*[F.col(n).isNull().cast("bigint").alias(n) for n in NUMERIC]).unpivot([], NUMERIC, "name", "m")
    return plain(fills.join(missing.groupBy("name").agg(F.sum("m").alias("missing")), "name"), 9)


@query(
    "scale_standard",
    f"""WITH d AS ({o.clean(BRAND)}), t AS (SELECT * FROM d WHERE {TRAINING}), m AS (SELECT """
    + ", ".join(f"median({n}) AS f{i}" for i, n in enumerate(NUMERIC))
    + " FROM t), s AS (SELECT "
    + ", ".join(f"avg(coalesce({n}, f{i})) AS a{i}, stddev_pop(coalesce({n}, f{i})) AS s{i}" for i, n in enumerate(NUMERIC))
    + f" FROM t, m) SELECT {o.MONTH} AS cohort_month, plan__is_promo, gross_add__type, brand, "
    + ", ".join(f"{o.rnd(f'(coalesce({n}, f{i}) - a{i}) / s{i}')} AS {n}" for i, n in enumerate(NUMERIC))
    + " FROM d, m, s",
)
def scale_standard(spark, sf):
    data = storage.cut(clean(spark, sf).select(*BRAND.keys, *NUMERIC))
    fitted = preprocess.fit(_training(data), preprocess.Inputs([], NUMERIC))
    return plain(data.select(*BRAND.keys, *[fitted.scaled(n).alias(n) for n in NUMERIC]), 9)


@query(
    "onehot_topn",
    f"""WITH d AS (SELECT o_orderdate, coalesce(CASE WHEN o_custkey % 11 <> 0 THEN n_name END, 'unknown') AS label FROM ({o.ORDERS})),
k AS (SELECT label, row_number() OVER (ORDER BY count(*) DESC, label DESC) AS rank FROM d
WHERE o_orderdate < TIMESTAMP '1998-01-01' AND label <> 'FRANCE' GROUP BY label)
SELECT CASE WHEN rank >= 10 THEN 'infrequent_sklearn' ELSE d.label END AS label, count(*) AS n, rank IS NULL AS unseen
FROM d LEFT JOIN k USING (label) GROUP BY ALL""",
)
def onehot_topn(spark, sf):
    orders = src.table(spark, sf, "orders").join(src.customers(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    name = F.when(F.col("o_custkey") % 11 != 0, F.col("n_name"))
    rows = orders.select("o_orderdate", name.alias("traffic_source"))
    train = rows.filter(
        (F.col("o_orderdate") < "1998-01-01") & (F.coalesce("traffic_source", F.lit("")) != "FRANCE")
    )
    fitted = preprocess.fit(train, preprocess.Inputs(["traffic_source"], [], max_categories=10))
    placed = fitted.with_positions(rows, {"place": "traffic_source"})
    labelled = fitted.with_labels(placed, {"label": "traffic_source"})
    unseen = F.col("place") == fitted.sizes["traffic_source"]
    return labelled.groupBy("label", unseen.alias("unseen")).agg(F.count("*").alias("n"))


@query(
    "boolean_ordinal",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 = 0 THEN -1 WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS flag,
CAST(CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE -1 END AS DOUBLE) AS seen_once FROM orders""",
)
def boolean_ordinal(spark, sf):
    key = F.col("o_orderkey")
    rows = src.table(spark, sf, "orders").select(
        "o_orderkey", F.when(key % 5 != 0, key % 2 == 0).alias("flag"), (key % 2 == 0).alias("seen_once")
    )
    both = preprocess.fit(rows, preprocess.Inputs([], [], ["flag"]))
    once = preprocess.fit(rows.filter("seen_once"), preprocess.Inputs([], [], ["seen_once"]))
    return rows.select("o_orderkey", both.ordinal("flag").alias("flag"), once.ordinal("seen_once").alias("seen_once"))


@query(
    "split_counts",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY (o_orderkey * 2654435761) % 4294967296) AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, i <= ceil(0.1 * n) AS is_test FROM r""",
)
def split_counts(spark, sf):
    rows = src.table(spark, sf, "orders").select("o_orderkey")
    order = (F.col("o_orderkey") * F.lit(2654435761)) % F.lit(4294967296)
    return order_stats.holdout(rows, order, 0.1, "is_test")


@query(
    "time_series_frame",
    f"""WITH d AS ({o.clean(BRAND)}), s AS (SELECT avg(coalesce(avg_promo_days, 0)) AS a, stddev_pop(coalesce(avg_promo_days, 0)) AS s FROM d)
SELECT strftime(cohort_month, '%Y-%m-%d') AS ds, {o.rnd("(coalesce(avg_promo_days, 0) - a) / s")} AS num__avg_promo_days,
CAST(CASE WHEN gross_add__type = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS "cat__gross_add__type_F",
CAST(CASE WHEN gross_add__type = 'O' THEN 1 ELSE 0 END AS DOUBLE) AS "cat__gross_add__type_O",
CAST(CASE WHEN gross_add__type = 'P' THEN 1 ELSE 0 END AS DOUBLE) AS "cat__gross_add__type_P",
avg_net_billings_90_days AS y FROM d, s""",
)
def time_series_frame(spark, sf):
    data = storage.cut(clean(spark, sf).select("cohort_month", "avg_promo_days", "gross_add__type", "avg_net_billings_90_days"))
    inputs = preprocess.Inputs(["gross_add__type"], ["avg_promo_days"], impute="constant")
    frame = preprocess.time_series_frame(data, preprocess.fit(data, inputs), "cohort_month", "avg_net_billings_90_days")
    return plain(frame, 9, ["num__avg_promo_days"])


@query(
    "time_series_features",
    f"""WITH d AS ({o.clean(BRAND)}), s AS (SELECT avg(coalesce(avg_promo_days, 0)) AS a, stddev_pop(coalesce(avg_promo_days, 0)) AS s FROM d),
f AS (SELECT {O_KEYS}, 'num__avg_promo_days' AS feature, {o.rnd("(coalesce(avg_promo_days, 0) - a) / s")} AS value, avg_net_billings_90_days AS y FROM d, s
UNION ALL SELECT {O_KEYS}, 'cat__gross_add__type_' || coalesce(gross_add__type, 'unknown'), 1.0, avg_net_billings_90_days FROM d
UNION ALL SELECT {O_KEYS}, 'cat__brand_' || coalesce(brand, 'unknown'), 1.0, avg_net_billings_90_days FROM d)
SELECT * FROM f WHERE value <> 0""",
)
def time_series_features(spark, sf):
    """The sparse vectors of a series by row, feature and value."""
    data = storage.cut(clean(spark, sf))
    fitted = preprocess.fit(data, preprocess.Inputs(BRAND.categories, ["avg_promo_days"], impute="constant"))
    names = fitted.names_of(list(range(fitted.width)))
    rows = preprocess.series_vectors(data, fitted, None, "avg_net_billings_90_days", BRAND.keys)
    keyed = rows.select(*BRAND.keys, F.posexplode(vector_to_array("features")).alias("place", "value"), "y")
    named = F.create_map(*[F.lit(x) for item in names.items() for x in item])[F.col("place")]
    return plain(keyed.filter("value <> 0").select(*BRAND.keys, named.alias("feature"), "value", "y"), 9, ["value"])


# --- evaluation on a fixed predictor -------------------------------------------------------------

RATE = "gross_adds_canceled_day_three_rate"
O_SCORED = f"WITH d AS ({o.clean(BRAND)}), s AS (SELECT *, avg({RATE}) OVER (PARTITION BY brand) AS p FROM d)"


def scored(spark, sf) -> DataFrame:
    data = clean(spark, sf)
    means = data.groupBy("brand").agg(F.avg(RATE).alias("p"))
    return data.join(means, "brand")


@query(
    "eval_metrics",
    f"""{O_SCORED} SELECT plan__is_promo, count(*) AS rows, {o.rnd(f"sqrt(avg(({RATE} - p) * ({RATE} - p)))")} AS rmse,
{o.rnd(f"avg(abs({RATE} - p))")} AS mae, {o.rnd(f"100 * avg(CASE WHEN {RATE} <> 0 THEN abs(({RATE} - p) / {RATE}) END)")} AS mape,
CASE WHEN var_pop({RATE}) = 0 THEN CASE WHEN sum(({RATE} - p) * ({RATE} - p)) = 0 THEN 1.0 ELSE 0.0 END
ELSE {o.rnd(f"1 - sum(({RATE} - p) * ({RATE} - p)) / (var_pop({RATE}) * count({RATE}))")} END AS r2 FROM s GROUP BY plan__is_promo""",
)
def eval_metrics(spark, sf):
    return plain(metrics.evaluate(scored(spark, sf), RATE, "p", ["plan__is_promo"]), 9)


@query(
    "prediction_interval",
    f"""{O_SCORED}, e AS (SELECT plan__is_promo, stddev_pop({RATE} - p) AS sd FROM s GROUP BY plan__is_promo)
SELECT {o.MONTH} AS cohort_month, plan__is_promo, gross_add__type, brand, {o.rnd("p")} AS yhat,
{o.rnd("p - 1.959963984540054 * sd")} AS yhat_lower, {o.rnd("p + 1.959963984540054 * sd")} AS yhat_upper
FROM s JOIN e USING (plan__is_promo)""",
)
def prediction_interval(spark, sf):
    rows = scored(spark, sf)
    spread = rows.groupBy("plan__is_promo").agg(metrics.residual_spread(F.col(RATE), F.col("p")).alias("sd"))
    lower, upper = metrics.interval(F.col("p"), F.col("sd"))
    out = rows.join(spread, "plan__is_promo").select(
        *BRAND.keys, F.col("p").alias("yhat"), lower.alias("yhat_lower"), upper.alias("yhat_upper")
    )
    return plain(out, 9)


@query(
    "prediction_summary",
    f"""SELECT o_orderpriority, count(*) AS rows, {o.rnd("avg(o_totalprice)", 4)} AS mean, {o.rnd("median(o_totalprice)", 4)} AS median,
min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders GROUP BY o_orderpriority""",
)
def prediction_summary(spark, sf):
    return plain(metrics.prediction_summary(src.table(spark, sf, "orders"), "o_orderpriority", "o_totalprice"), 4, ["mean", "median"])


# --- masks, statuses and filled counts -----------------------------------------------------------


def o_masks(step, promo: bool) -> str:
    """SQL of both masks for the partition."""
    cohort, base = step.maturity, step.base(promo)
    targets = " AND ".join(f"{t} IS NOT NULL" for t in step.targets)
    train = f"coalesce({cohort} >= 20, false) AND {targets}"
    predict = f"(coalesce({cohort} < 20 AND {o.ratio(cohort, base)} < 0.5, false) OR {cohort} IS NULL OR {base} IS NULL)"
    return f"{train} AS trained, {predict} AS predicted"




@query(
    "training_mask",
    f"SELECT {O_KEYS}, {o_masks(BILLING_365, True)} FROM ({o.clean(BRAND)}) WHERE plan__is_promo",
)
def training_mask(spark, sf):
    promo = clean(spark, sf).filter("plan__is_promo")
    return plain(
        promo.select(
            *BRAND.keys,
            masks.training_mask(BILLING_365, SETTINGS).alias("trained"),
            masks.prediction_mask(BILLING_365, True, SETTINGS).alias("predicted"),
        )
    )


@query(
    "training_rule",
    f"""SELECT {O_KEYS}, coalesce(eligible_first_rebills >= 10, false)
AND coalesce(gross_adds_created_over_30_days_ago >= 20, false) AS trained FROM ({o.clean(BRAND)})""",
)
def training_rule(spark, sf):
    rule = masks.all_at_least([("eligible_first_rebills", 10), (c.matured_column(30), 20)])
    return plain(clean(spark, sf).select(*BRAND.keys, rule.alias("trained")))


O_STATUS = "CASE WHEN predicted THEN 'PREDICTED' WHEN trained THEN 'TRAINED' ELSE 'BYPASSED' END"


def o_fixed(step, promo: bool) -> str:
    """Clean rows of a partition with masks and the fixed predictor of every target."""
    means = ", ".join(f"avg({t}) OVER (PARTITION BY brand) AS p{i}" for i, t in enumerate(step.targets))
    flag = "plan__is_promo" if promo else "NOT plan__is_promo"
    return f"SELECT *, {o_masks(step, promo)}, {means} FROM ({o.clean(BRAND)}) WHERE {flag}"


def fixed(spark, sf, step, promo: bool) -> DataFrame:
    rows = clean(spark, sf).filter(F.col("plan__is_promo") == promo)
    means = rows.groupBy("brand").agg(*[F.avg(t).alias(f"p{i}") for i, t in enumerate(step.targets)])
    return rows.join(means, "brand").withColumns(
        {
            "trained": masks.training_mask(step, SETTINGS),
            "predicted": masks.prediction_mask(step, promo, SETTINGS),
        }
    )


@query(
    "prediction_status",
    f"""SELECT brand, {O_STATUS} AS avg_net_billings_365_days_model, count(*) AS n, {o.rnd("min(filled)", 6)} AS least,
{o.rnd("max(filled)", 6)} AS most FROM (SELECT *, CASE WHEN predicted THEN p0 ELSE avg_net_billings_365_days END AS filled
FROM ({o_fixed(BILLING_365, True)})) GROUP BY ALL""",
)
def prediction_status(spark, sf):
    rows = fixed(spark, sf, BILLING_365, True)
    target = BILLING_365.targets[0]
    filled = masks.fill_back(BILLING_365, True, F.col("predicted"), {target: F.col("p0")})
    out = rows.withColumns(
        {**filled, BILLING_365.status_column: masks.status(F.col("predicted"), F.col("trained"))}
    )
    return plain(
        out.groupBy("brand", BILLING_365.status_column).agg(
            F.count("*").alias("n"), F.min(target).alias("least"), F.max(target).alias("most")
        ),
        6,
    )


@query(
    "backfill_counts",
    f"""SELECT {O_KEYS}, {o.rnd("CASE WHEN predicted THEN p0 ELSE first_rebill_rate_excl_retries END", 6)} AS first_rebill_rate_excl_retries,
{o.rnd("CASE WHEN predicted THEN p0 * survived_promo_activations_excl_retries ELSE survived_first_rebills_excl_retries END", 6)} AS survived_first_rebills_excl_retries,
{o.rnd("CASE WHEN predicted THEN survived_promo_activations_excl_retries ELSE eligible_first_rebills END", 6)} AS eligible_first_rebills
FROM ({o_fixed(FIRST_REBILL, True)})""",
)
def backfill_counts(spark, sf):
    rows = fixed(spark, sf, FIRST_REBILL, True)
    filled = masks.fill_back(FIRST_REBILL, True, F.col("predicted"), {FIRST_REBILL.targets[0]: F.col("p0")})
    out = rows.select(*BRAND.keys, *[value.cast("double").alias(name) for name, value in filled.items()])
    return plain(out, 6)


@query(
    "null_targets",
    f"""SELECT brand, CAST(count(*) AS BIGINT) AS null_rows FROM ({o.clean(BRAND)})
WHERE gross_adds_created_over_365_days_ago >= 20 AND avg_net_billings_365_days IS NULL GROUP BY brand""",
)
def null_targets(spark, sf):
    rows = clean(spark, sf).filter(masks.null_target_mask(BILLING_365, SETTINGS))
    return rows.groupBy("brand").agg(F.count("*").alias("null_rows"))


@query(
    "null_target_report",
    f"""SELECT CAST(count(*) AS BIGINT) AS null_rows, count(DISTINCT brand) AS null_groups FROM ({o.clean(BRAND)})
WHERE gross_adds_created_over_365_days_ago >= 20 AND avg_net_billings_365_days IS NULL""",
)
def null_target_report(spark, sf):
    return masks.null_target_report(clean(spark, sf), BILLING_365, SETTINGS, ["brand"])


@query(
    "predictions_long",
    " UNION ALL ".join(
        f"""SELECT {O_KEYS}, '{t}' AS target_col, {o.rnd(f"p{i}")} AS yhat, {o.rnd(f"p{i} - 0.1")} AS yhat_lower,
{o.rnd(f"p{i} + 0.1")} AS yhat_upper, gross_adds AS prediction_base_col FROM ({o_fixed(DAY_3, False)}) WHERE predicted"""
        for i, t in enumerate(DAY_3.targets)
    ),
)
def predictions_long(spark, sf):
    rows = fixed(spark, sf, DAY_3, False).filter("predicted")
    bounded = rows.withColumns(
        {f"p{i}_{side}": F.col(f"p{i}") + shift for i in range(2) for side, shift in (("lower", -0.1), ("upper", 0.1))}
    )
    yhat = {t: f"p{i}" for i, t in enumerate(DAY_3.targets)}
    return plain(masks.predictions_long(bounded, DAY_3, BRAND.keys, "gross_adds", yhat), 9, ["yhat", "yhat_lower", "yhat_upper"])


def _o_dashboard() -> str:
    counts = [c.matured_column(1), c.canceled_column(1), c.cross_sell_column(1)]
    for step in c.STEPS:
        counts += [step.maturity, *step.filled]
    counts = list(dict.fromkeys(counts))
    derived = {
        "recurring_days": "avg_recurring_days",
        "recurring_price": "avg_recurring_price",
        "cross_sell_adds_day_one": "cross_sell_adds_day_one_rate",
        "cross_sell_price": "avg_cross_sell_price",
        "promo_days": "avg_promo_days",
        "promo_price": "avg_promo_price",
    }
    totals = {c.total_billings_column(n): c.avg_billings_column(n) for n in c.BILLING_DAYS}
    products = ", ".join(f"{x} * gross_adds AS {name}" for name, x in {**derived, **totals}.items())
    return f"""SELECT {O_KEYS}, predicted AS is_predicted, gross_adds, {", ".join(counts)}, {products}
FROM (SELECT * FROM ({o_fixed(BILLING_365, True)}) UNION ALL BY NAME SELECT * FROM ({o_fixed(BILLING_365, False)}))"""


@query("dashboard_dataset", _o_dashboard())
def dashboard_dataset(spark, sf):
    """Both partitions, with the statuses of two steps."""
    halves = [fixed(spark, sf, BILLING_365, promo) for promo in (True, False)]
    rows = halves[0].unionByName(halves[1], allowMissingColumns=True)
    predicted, trained = F.col("predicted"), F.col("trained")
    steps = {BILLING_365.status_column: masks.status(predicted, trained), DAY_3.status_column: masks.status(F.lit(False), trained)}
    return plain(dashboard.dashboard_rows(rows.withColumns(steps), BRAND))


# --- trees and cascade (no SQL equivalent) -------------------------------------------------------


def _fit(spark, sf, step):
    """One model over both partitions, with the inputs that both have."""
    rows = storage.cut(safe.nan_to_null(clean(spark, sf)))
    train = rows.filter(masks.training_mask(step, SETTINGS))
    inputs = preprocess.Inputs(BRAND.categories, c.regressors(step, False))
    fitted, models = trees.fit(train, list(step.targets), inputs, SMALL_TREES)
    return rows, fitted, models


ONE_TREE = TreeParams(trees=1, depth=8, row_share=1.0, column_share=1.0)


def _group_means(spark, sf, step):
    """One full tree over one category: every prediction is the mean of the brand's training rows."""
    rows = storage.cut(safe.nan_to_null(clean(spark, sf)))
    inputs = preprocess.Inputs(["brand"], [])
    fitted, models = trees.fit(rows.filter(masks.training_mask(step, SETTINGS)), list(step.targets), inputs, ONE_TREE)
    return trees.predict(rows, fitted, models)


def _o_group_means(step) -> str:
    means = ", ".join(f"avg({t}) AS {t}_yhat" for t in step.targets)
    trained = f"{step.maturity} >= {src.MIN_COHORT_SIZE} AND " + " AND ".join(f"{t} IS NOT NULL" for t in step.targets)
    rounded = ", ".join(f"round({t}_yhat, 6) AS {t}_yhat" for t in step.targets)
    return f"""WITH d AS ({o.clean(BRAND)}), m AS (SELECT brand, {means} FROM d WHERE {trained} GROUP BY brand)
SELECT {O_KEYS}, {rounded} FROM d JOIN m USING (brand)"""


@query("gbt_group_mean", _o_group_means(BILLING_365))
def gbt_group_mean(spark, sf):
    names = [f"{t}_yhat" for t in BILLING_365.targets]
    return plain(_group_means(spark, sf, BILLING_365).select(*BRAND.keys, *names), 6, names)


@query("gbt_multi_group_mean", _o_group_means(DAY_3))
def gbt_multi_group_mean(spark, sf):
    names = [f"{t}_yhat" for t in DAY_3.targets]
    return plain(_group_means(spark, sf, DAY_3).select(*BRAND.keys, *names), 6, names)


@query("gbt_predict")
def gbt_predict(spark, sf):
    rows, fitted, models = _fit(spark, sf, BILLING_365)
    return trees.predict(rows, fitted, models, {BILLING_365.targets[0]: "yhat"}).select(
        *BRAND.keys, BILLING_365.targets[0], "yhat", "yhat_lower", "yhat_upper"
    )


@query("gbt_multi_target")
def gbt_multi_target(spark, sf):
    rows, fitted, models = _fit(spark, sf, DAY_3)
    names = [f"{t}_yhat{suffix}" for t in DAY_3.targets for suffix in ("", "_lower", "_upper")]
    return trees.predict(rows, fitted, models).select(*BRAND.keys, *DAY_3.targets, *names)


@query("gbt_importance")
def gbt_importance(spark, sf):
    """Ten most important features per target."""
    _, _, models = _fit(spark, sf, DAY_3)
    rows = [(m.target, rank, *x) for m in models for rank, x in enumerate(m.importances()[:10], start=1)]
    return spark.createDataFrame(rows, "target_col string, rank int, feature string, importance double")


@query("cascade_run")
def cascade_run(spark, sf):
    """All steps of both partitions; the result rows carry every status and filled value."""
    return cascade_plan.CascadeRun(BRAND, clean(spark, sf), settings=SETTINGS).cascade()


def _own_masks(promo: bool) -> list:
    """Steps whose masks do not depend on what earlier steps predict."""
    return [s for s in c.STEPS if s.applies_to(promo) and not (promo and s is FIRST_REBILL)]


def _o_outcomes() -> str:
    parts = []
    for promo in (True, False):
        for step in _own_masks(promo):
            parts.append(f"""SELECT {O_KEYS}, '{step.name}' AS step, CASE WHEN predicted THEN '{c.PREDICTED}' WHEN trained THEN '{c.TRAINED}'
ELSE '{c.BYPASSED}' END AS status, CASE WHEN NOT predicted THEN round({step.targets[0]}, 9) END AS value
FROM (SELECT *, {o_masks(step, promo)} FROM ({o.clean(BRAND)}) WHERE plan__is_promo = {str(promo).lower()})""")
    return " UNION ALL ".join(parts)


@query("cascade_outcomes", _o_outcomes())
def cascade_outcomes(spark, sf):
    """Over all steps and both partitions: every row's status, and the value of each row that was not predicted."""
    result = cascade_plan.CascadeRun(BRAND, clean(spark, sf), settings=SETTINGS).cascade()
    parts = []
    for promo in (True, False):
        outcomes = [
            F.struct(
                F.lit(s.name).alias("step"),
                F.col(s.status_column).alias("status"),
                F.when(F.col(s.status_column) != c.PREDICTED, F.col(s.targets[0])).alias("value"),
            )
            for s in _own_masks(promo)
        ]
        rows = result.filter(F.col(c.IS_PROMO) == promo)
        parts.append(rows.select(*BRAND.keys, F.explode(F.array(*outcomes)).alias("o")).select(*BRAND.keys, "o.*"))
    return plain(parts[0].unionByName(parts[1]), 9, ["value"])


@query("cascade_stored_predictions")
def cascade_stored_predictions(spark, sf):
    """The long predictions of a stored run over all steps, with hold-out evaluation."""
    folder = storage.scratch_path(spark, "cascade")
    settings = CascadeSettings(min_cohort_size=src.MIN_COHORT_SIZE, trees=SMALL_TREES)
    cascade_plan.CascadeRun(BRAND, clean(spark, sf), sinks.make_sink("parquet", folder), settings).run()
    return sinks.read(spark, f"{folder}/BRAND_{cascade_plan.PREDICT_RESULTS}.parquet", merge_schema=True)


# fixed values: the numeric inputs of the last promo step in their order, those of promo rows at the end
O_REGRESSORS = """avg_recurring_days avg_recurring_price gross_adds_canceled_day_one_rate cross_sell_adds_day_one_rate avg_cross_sell_price
gross_adds_canceled_day_three_rate cross_sell_adds_day_three_rate gross_adds_canceled_day_seven_rate cross_sell_adds_day_seven_rate
promo_activation_rate_excl_retries first_rebill_rate_excl_retries avg_net_billings_30_days avg_net_billings_60_days avg_net_billings_90_days
avg_net_billings_180_days avg_net_billings_365_days avg_net_billings_730_days avg_net_billings_1095_days""".split()
O_PROMO_TERMS = "avg_promo_days avg_promo_price promo_to_recurring_days_ratio promo_to_recurring_price_ratio".split()
#: Numeric inputs that a step has before the promo terms.
O_WIDTHS = {1: 5, 2: 7, 3: 9, 4: 10, 5: 11, 6: 12, 7: 13, 8: 14, 9: 15, 10: 16, 11: 17, 12: 18}


def _o_records() -> str:
    parts = []
    for promo in (True, False):
        for step in _own_masks(promo):
            numbers = O_REGRESSORS[: O_WIDTHS[step.number]] + (O_PROMO_TERMS if promo else [])
            for target in step.targets:
                parts.append(f"""SELECT {step.number} AS step_number, '{step.name}' AS step_name, '{str(promo).lower()}' AS is_promo,
'{target}' AS target_col, {str(len(step.targets) > 1).lower()} AS is_multi_target, 'gross_add__type,brand' AS categories,
'{",".join(numbers)}' AS numbers, n - CASE WHEN n >= 4 THEN CAST(ceil(0.1 * n) AS BIGINT) ELSE 0 END AS training_rows,
CASE WHEN n >= 4 THEN CAST(ceil(0.1 * n) AS BIGINT) ELSE 0 END AS test_rows, n >= 4 AS evaluated,
CASE WHEN n >= 2 THEN m ELSE 0 END AS prediction_rows, CASE WHEN m > 0 AND n < 2 THEN n || ' training rows' END AS message,
CASE WHEN n >= 2 THEN m ELSE 0 END AS predictions, true AS same_id, 'BRAND' AS level_name, 'COMPLETED' AS status
FROM (SELECT count(*) FILTER (trained) AS n, count(*) FILTER (predicted) AS m
FROM (SELECT {o_masks(step, promo)} FROM ({o.clean(BRAND)}) WHERE plan__is_promo = {str(promo).lower()}))""")
    return " UNION ALL ".join(parts)


@query("cascade_records", _o_records())
def cascade_records(spark, sf):
    """What a stored and evaluated run says about its steps, read back: inputs, row counts, hold-out, predictions, ids, run.

    Steps whose masks depend on what earlier steps predict are left to ``cascade_stored_predictions``.
    """
    sink = sinks.make_sink("log", storage.scratch_path(spark, "cascade"), spark)
    settings = CascadeSettings(min_cohort_size=src.MIN_COHORT_SIZE, trees=SMALL_TREES)
    cascade_plan.CascadeRun(BRAND, clean(spark, sf), sink, settings).run()
    read, results = sink.log.read, f"BRAND_{cascade_plan.PREDICT_RESULTS}"
    split, steps = read(f"BRAND_{cascade_plan.SPLIT_METADATA}"), read(f"BRAND_{cascade_plan.PREDICT_METADATA}")
    none = spark.createDataFrame([], "id string, target_col string")  # where no step has a row to predict
    stored = (read(results) if sink.log.has(results) else none).groupBy("id", "target_col").agg(F.count("*").alias("predictions"))
    runs = read(cascade_plan.MODEL_METADATA).select(F.col("id").alias("model_id"), "level_name", "status")
    own_id = cascade_plan.step_id(F.col("model_id"), F.col("step_name"), F.col("partition_item.value"))
    both = (
        split.join(steps.select("id", "prediction_rows", "message"), "id")
        .join(stored, ["id", "target_col"], "left")
        .join(runs, "model_id")
    )
    masked = [(s.name, promo) for promo in (True, False) for s in _own_masks(promo)]
    known = F.struct("step_name", "partition_item.value").isin([F.struct(F.lit(n), F.lit(p)) for n, p in masked])
    return both.filter(known).select(
        "step_number",
        "step_name",
        F.col("partition_item.value").cast("string").alias("is_promo"),
        "target_col",
        "is_multi_target",
        F.concat_ws(",", "cat_cols").alias("categories"),
        F.concat_ws(",", "num_cols").alias("numbers"),
        "training_rows",
        "test_rows",
        F.coalesce(F.col("eval_result.rmse") >= 0, F.lit(False)).alias("evaluated"),
        "prediction_rows",
        "message",
        F.coalesce("predictions", F.lit(0)).alias("predictions"),
        (F.col("id") == own_id).alias("same_id"),
        "level_name",
        "status",
    )


@query(
    "cascade_failed_run",
    f"""SELECT 'BRAND' AS level_name, 'brand' AS level_columns, 'FAILED' AS status, true AS has_reason, true AS in_order,
(SELECT count(*) FROM ({o.clean(BRAND)})) AS stored_rows""",
)
def cascade_failed_run(spark, sf):
    """A run that fails is recorded with its reason, beside the data it began with."""
    folder = storage.scratch_path(spark, "failed")
    data = clean(spark, sf).drop(DAY_3.maturity)
    try:
        cascade_plan.CascadeRun(BRAND, data, sinks.make_sink("parquet", folder), SETTINGS).run()
    except AnalysisException:
        pass
    run = sinks.read(spark, f"{folder}/{cascade_plan.MODEL_METADATA}.parquet")
    stored = sinks.read(spark, f"{folder}/BRAND_{cascade_plan.SPINE_DATA}.parquet").agg(F.count("*").alias("stored_rows"))
    return run.select(
        "level_name",
        F.concat_ws(",", "level_group_bys").alias("level_columns"),
        "status",
        (F.length("message") > 0).alias("has_reason"),
        (F.col("created_at") <= F.col("completed_at")).alias("in_order"),
        F.lit(stored.first()[0]).alias("stored_rows"),
    )


@query(
    "gbt_importance_of_the_target",
    f"SELECT '{BILLING_365.targets[0]}' AS target_col, 1 AS rank, 'num__{BILLING_365.targets[0]}' AS feature, 1.0 AS importance",
)
def gbt_importance_of_the_target(spark, sf):
    """One full tree that is given its target and a constant: all gain is that of the target, and the constant has no rank."""
    target = BILLING_365.targets[0]
    rows = storage.cut(safe.nan_to_null(clean(spark, sf))).withColumn("constant", F.lit(3.0))
    inputs = preprocess.Inputs([], ["constant", target])
    _, models = trees.fit(rows.filter(masks.training_mask(BILLING_365, SETTINGS)), [target], inputs, ONE_TREE)
    ranked = [(m.target, rank, *x) for m in models for rank, x in enumerate(m.importances()[:10], start=1)]
    return plain(spark.createDataFrame(ranked, "target_col string, rank int, feature string, importance double"), 9)


@query("gbt_default_trees")
def gbt_default_trees(spark, sf):
    """The parameters of production: a hundred trees of depth six over 256 bins, with inputs of both partitions."""
    rows = storage.cut(safe.nan_to_null(clean(spark, sf)))
    inputs = preprocess.Inputs(BRAND.categories, c.regressors(BILLING_365, False))
    fitted, models = trees.fit(rows.filter(masks.training_mask(BILLING_365, SETTINGS)), list(BILLING_365.targets), inputs)
    return trees.predict(rows, fitted, models, {BILLING_365.targets[0]: "yhat"}).select(
        *BRAND.keys, BILLING_365.targets[0], "yhat", "yhat_lower", "yhat_upper"
    )


# --- series and forecasts ------------------------------------------------------------------------


@query(
    "trend_fit",
    f"""SELECT r_name, {o.rnd("regr_slope(y, date_diff('day', DATE '1970-01-01', ds))")} AS slope,
{o.rnd("regr_intercept(y, date_diff('day', DATE '1970-01-01', ds))", 4)} AS intercept FROM ({o.MONTHLY}) GROUP BY r_name""",
)
def trend_fit(spark, sf):
    trend = forecasting.linear_trend(src.monthly_series(spark, sf), ["r_name"])
    return plain(plain(trend, 9, ["slope"]), 4, ["intercept"])


O_CALENDAR = """SELECT event_type, CAST(unnest(generate_series(lo, hi + INTERVAL 480 DAY, INTERVAL 1 DAY)) AS DATE) AS ds
FROM (SELECT event_type, CAST(min(ds) AS TIMESTAMP) AS lo, CAST(max(ds) AS TIMESTAMP) AS hi FROM d GROUP BY event_type)"""
O_DAY = "strftime(ds, '%Y-%m-%d') AS ds"


@query("future_calendar", f"WITH d AS ({o.DAILY}) SELECT event_type, {O_DAY} FROM ({O_CALENDAR})")
def future_calendar(spark, sf):
    return plain(ltv.future_calendar(src.daily_series(spark, sf), ["event_type"]))


O_FORECAST = f"""WITH d AS ({o.DAILY}), t AS (SELECT event_type, regr_slope(y, date_diff('day', DATE '1970-01-01', ds)) AS a,
regr_intercept(y, date_diff('day', DATE '1970-01-01', ds)) AS b FROM d GROUP BY event_type),
f AS (SELECT k.event_type, ds, b + a * date_diff('day', DATE '1970-01-01', ds) AS yhat FROM ({O_CALENDAR}) k JOIN t USING (event_type)
WHERE ds >= DATE '2024-01-11')"""


def _linear(spark, sf):
    """Daily series and its linear forecast from January 11 on."""
    series = src.daily_series(spark, sf)
    calendar = ltv.future_calendar(series, ["event_type"])
    trend = forecasting.linear_trend(series, ["event_type"])
    forecast = forecasting.linear_prediction(calendar, trend, ["event_type"])
    return series, forecast.filter(F.col("ds") >= F.lit("2024-01-11").cast("date"))


@query(
    "forecast_regressors",
    f"""{O_FORECAST} SELECT event_type, {O_DAY}, round(yhat, 4) AS earlier FROM (SELECT k.event_type, k.ds, yhat
FROM ({O_CALENDAR}) k JOIN f ON k.event_type = f.event_type AND k.ds = f.ds)""",
)
def forecast_regressors(spark, sf):
    series, forecast = _linear(spark, sf)
    calendar = ltv.future_calendar(series, ["event_type"])
    earlier = forecast.withColumn("earlier", F.round("yhat", 4)).drop("yhat")
    return plain(ltv.with_earlier_predictions(calendar, earlier, ["event_type"]))


@query(
    "forecast_with_actuals",
    f"""{O_FORECAST} SELECT event_type, {O_DAY}, round(yhat, 4) AS yhat, y AS actuals
FROM (SELECT event_type, ds, yhat, y FROM f FULL JOIN d USING (event_type, ds))""",
)
def forecast_with_actuals(spark, sf):
    series, forecast = _linear(spark, sf)
    actuals = series.withColumnRenamed("y", "actuals")
    return plain(ltv.with_actuals(forecast.withColumn("yhat", F.round("yhat", 4)), actuals, ["event_type"]))


@query(
    "forecast_onto_history",
    f"""{O_FORECAST} SELECT event_type, {O_DAY}, y, round(yhat, 4) AS yhat
FROM (SELECT event_type, ds, yhat, y FROM d LEFT JOIN f USING (event_type, ds))""",
)
def forecast_onto_history(spark, sf):
    series, forecast = _linear(spark, sf)
    return plain(ltv.onto_history(series, forecast.withColumn("yhat", F.round("yhat", 4)), ["event_type"]))


@query("seasonal_regression")
def seasonal_regression(spark, sf):
    """One model of the 90-day average over all cohorts, with preprocessed features as regressors."""
    target = "avg_net_billings_90_days"
    data = storage.cut(clean(spark, sf))
    inputs = preprocess.Inputs(BRAND.categories, list(c.BASE_REGRESSORS), impute="constant")
    frame = preprocess.time_series_frame(data, preprocess.fit(data, inputs), "cohort_month", target)
    features = [n for n in frame.columns if n not in ("ds", "y")]
    fitted = seasonal.fit_seasonal(frame, features)
    return fitted.predict(frame).select("ds", "y", "yhat", "yhat_lower", "yhat_upper")


LINEAR = forecasting.SeriesModel(changepoints=0, yearly_order=0, weekly_order=0, multiplicative=False)
O_LINE = "regr_slope(y, date_diff('day', DATE '1970-01-01', ds)) AS a, regr_intercept(y, date_diff('day', DATE '1970-01-01', ds)) AS b"


@query(
    "seasonal_line",
    f"""WITH d AS ({o.MONTHLY}), t AS (SELECT {O_LINE} FROM d)
SELECT r_name, strftime(ds, '%Y-%m-%d') AS ds, y, round(b + a * date_diff('day', DATE '1970-01-01', ds), 3) AS yhat FROM d, t""",
)
def seasonal_line(spark, sf):
    """The distributed model without changepoints, seasons and regressors is one regression line over all rows."""
    series = src.monthly_series(spark, sf)
    fitted = seasonal.fit_seasonal(series, [], LINEAR)
    return plain(fitted.predict(series).select("r_name", "ds", "y", F.round("yhat", 3).alias("yhat")))


@query("group_forecast")
def group_forecast(spark, sf):
    """Monthly orders per region with a year ahead, next to the actual values."""
    series = src.monthly_series(spark, sf)
    forecast = forecasting.group_forecast(series, ["r_name"], horizon=12, step_days=30)
    return ltv.with_actuals(forecast, series.withColumnRenamed("y", "actuals"), ["r_name"])


@query("forecast_cascade")
def forecast_cascade(spark, sf):
    """Groups of more than two customers, so that every prefix has some."""
    forecast = ltv_forecast.ltv_forecast(src.customer_billings(spark, sf), min_size=2)
    return ltv_forecast.stored_result(forecast)


@query(
    "group_forecast_linear",
    f"""WITH d AS ({o.MONTHLY}), t AS (SELECT r_name, max(ds) AS last, {O_LINE} FROM d GROUP BY r_name),
k AS (SELECT r_name, ds FROM d UNION ALL SELECT r_name, CAST(last + to_days(CAST(30 * i AS INT)) AS DATE) FROM t, range(1, 13) x(i))
SELECT k.r_name, strftime(k.ds, '%Y-%m-%d') AS ds, round(b + a * date_diff('day', DATE '1970-01-01', k.ds), 2) AS yhat,
y AS actuals FROM k JOIN t USING (r_name) LEFT JOIN d ON d.r_name = k.r_name AND d.ds = k.ds""",
)
def group_forecast_linear(spark, sf):
    """Without changepoints and seasons the model is the regression line."""
    series = src.monthly_series(spark, sf)
    forecast = forecasting.group_forecast(series, ["r_name"], horizon=12, step_days=30, model=LINEAR)
    both = ltv.with_actuals(forecast, series.withColumnRenamed("y", "actuals"), ["r_name"])
    return plain(both.select("r_name", "ds", F.round("yhat", 2).alias("yhat"), "actuals"))


STIFF = dataclasses.replace(LINEAR, changepoints=25, changepoint_scale=1e-9, sparse=True)


@query(
    "forecast_bounds",
    f"""WITH d AS ({o.MONTHLY}), t AS (SELECT r_name, max(ds) AS last, {O_LINE},
1.2815515655446004 * sqrt((regr_syy(y, e) - regr_sxy(y, e) ^ 2 / regr_sxx(y, e)) / count(*)) AS w
FROM (SELECT *, date_diff('day', DATE '1970-01-01', ds) AS e FROM d) GROUP BY r_name),
k AS (SELECT r_name, ds FROM d UNION ALL SELECT r_name, CAST(last + to_days(CAST(30 * i AS INT)) AS DATE) FROM t, range(1, 13) x(i))
SELECT r_name, strftime(ds, '%Y-%m-%d') AS ds, round(p, 2) AS yhat, round(p - w, 2) AS yhat_lower, round(p + w, 2) AS yhat_upper
FROM (SELECT k.r_name, k.ds, w, b + a * date_diff('day', DATE '1970-01-01', k.ds) AS p FROM k JOIN t USING (r_name))""",
)
def forecast_bounds(spark, sf):
    """A trend that may change at 25 times, but at a price that no change is worth, is the regression line, its bounds as well."""
    forecast = forecasting.group_forecast(src.monthly_series(spark, sf), ["r_name"], horizon=12, step_days=30, model=STIFF)
    lines = [F.round(n, 2).alias(n) for n in ("yhat", "yhat_lower", "yhat_upper")]
    return plain(forecast.select("r_name", "ds", *lines))


@query(
    "forecast_future",
    f"""WITH c AS ({o.ltv([2])}), g AS (SELECT brand, acquisition_sku_bucket, acquisition_date AS ds, canceled_day_1 AS y, cohort_size FROM c
WHERE brand IS NOT NULL AND acquisition_sku_bucket IS NOT NULL),
s AS (SELECT brand, acquisition_sku_bucket, max(ds) AS last FROM g GROUP BY ALL HAVING sum(cohort_size) > 20),
r AS (SELECT g.* FROM g JOIN s USING (brand, acquisition_sku_bucket) WHERE ds <= last - 75 AND y IS NOT NULL),
t AS (SELECT brand, acquisition_sku_bucket, {O_LINE} FROM r GROUP BY ALL),
k AS (SELECT g.brand, g.acquisition_sku_bucket, ds FROM g JOIN s USING (brand, acquisition_sku_bucket)
UNION ALL SELECT brand, acquisition_sku_bucket, CAST(last + to_days(CAST(i AS INT)) AS DATE) FROM s, range(1, 481) x(i))
SELECT k.brand, k.acquisition_sku_bucket, strftime(k.ds, '%Y-%m-%d') AS ds,
round(b + a * date_diff('day', DATE '1970-01-01', k.ds), 4) AS yhat, r.y AS actuals
FROM k JOIN t USING (brand, acquisition_sku_bucket)
LEFT JOIN r ON r.brand = k.brand AND r.acquisition_sku_bucket = k.acquisition_sku_bucket AND r.ds = k.ds""",
)
def forecast_future(spark, sf):
    """The first target 480 days ahead beside its actual values, with the linear model."""
    cohorts_ = ltv.ltv_cohorts(src.customer_billings(spark, sf), [2])
    gated = forecasting.forecast_input(cohorts_, c.LTV_LEVELS[:2], 20)
    rows = forecasting.target_forecasts(gated, forecasting.FORECAST_KEYS, ["canceled_day_1"], LINEAR)
    level = lambda name: F.get_json_object("filters", f"$.{name}").alias(name)
    return plain(rows.select(level("brand"), level("acquisition_sku_bucket"), "ds", F.round("yhat", 4).alias("yhat"), "actuals"))


CHAIN = dataclasses.replace(LINEAR, season_scale=float("inf"))
O_FILTERS = """'{"brand":"' || brand || '","acquisition_sku_bucket":"' || acquisition_sku_bucket || '"'
|| coalesce(',"acquisition_channel":"' || acquisition_channel || '"', '') || coalesce(',"payment_type":"' || payment_type || '"', '')
|| coalesce(',"mobile":"' || mobile || '"', '') || '}'"""


@query(
    "ltv_results_table",
    f"""WITH c AS (SELECT *, {O_FILTERS} AS filters, CAST(date_diff('day', DATE '1970-01-01', acquisition_date) AS DOUBLE) AS d
FROM ({o.ltv([2, 3, 4, 5])})),
s AS (SELECT level, filters, max(d) AS last FROM c WHERE filters IS NOT NULL GROUP BY ALL HAVING sum(cohort_size) > 7),
g AS (SELECT c.*, d <= last - 75 AS old FROM c JOIN s USING (level, filters)),
one AS (SELECT level, filters, regr_slope(canceled_day_1, d) AS a, regr_intercept(canceled_day_1, d) AS b, count(*) AS n
FROM g WHERE old GROUP BY ALL),
r AS (SELECT level, filters, d, canceled_day_1 AS x, canceled_day_1 - a * d - b AS rest, ltv_1mo AS y FROM g JOIN one USING (level, filters) WHERE old),
two AS (SELECT level, filters, CASE WHEN var_pop(rest) > 1e-12 THEN covar_pop(rest, y) / var_pop(rest) ELSE 0 END AS k FROM r GROUP BY ALL),
z AS (SELECT level, filters, any_value(k) AS k, regr_slope(y - k * x, d) AS slope, regr_intercept(y - k * x, d) AS base
FROM r JOIN two USING (level, filters) GROUP BY ALL)
SELECT strftime(acquisition_date, '%Y-%m-%d') || 'T00:00:00Z' AS acquisition_date, cohort_size, canceled_day_1, ltv_1mo, ltv_3mo, ltv_6mo,
ltv_12mo, ltv_24mo, CASE WHEN n >= 2 THEN round(base + slope * d + k * (a * d + b), 0) END AS ltv_1mo_predicted, filters, level,
CASE WHEN n IS NULL OR n < 2 THEN 'canceled_day_1: a series needs two days of history' END AS error
FROM g LEFT JOIN one USING (level, filters) LEFT JOIN z USING (level, filters)""",
)
def ltv_results_table(spark, sf):
    """All groups of all four prefixes, the second target from the first, stored over an earlier result and read back.

    With the linear model and regressors that are not held back, two nested regressions say the same.
    """
    sink = sinks.make_sink("parquet", storage.scratch_path(spark, "ltv"))
    sink.write("LTV_RESULTS", spark.range(3).withColumnRenamed("id", "old"))
    ltv_forecast.ltv_forecast(
        src.customer_billings(spark, sf), ["canceled_day_1", "ltv_1mo"], 7, sink, "LTV_RESULTS", CHAIN
    )
    return plain(sinks.read(spark, sink.path("LTV_RESULTS")), 0, ["ltv_1mo_predicted"])


# --- sinks and caches ----------------------------------------------------------------------------


def _halves(spark, sf):
    spine = cohorts.cohort_spine(src.gross_add_metrics(spark, sf), BRAND, src.AS_OF, src.START, src.EXCLUDED_BRAND)
    slim = spine.select(*BRAND.keys, "gross_adds")
    return slim.filter("plan__is_promo"), slim.filter("not plan__is_promo")


@query(
    "sink_parquet_append",
    f"""SELECT {o.MONTH} AS cohort_month, plan__is_promo, gross_add__type, brand, gross_adds,
CASE WHEN plan__is_promo THEN NULL ELSE 'late' END AS note FROM ({o.spine(BRAND)})""",
)
def sink_parquet_append(spark, sf):
    """Append matches columns by name; a column that came later is NULL in earlier rows."""
    sink = sinks.make_sink("parquet", storage.scratch_path(spark, "append"))
    first, second = _halves(spark, sf)
    sink.write("spine", first)
    late = second.withColumn("note", F.lit("late"))
    sink.write("spine", late.select(*reversed(late.columns)), overwrite=False)
    return plain(sinks.read(spark, sink.path("spine"), merge_schema=True))


@query(
    "sink_csv_append",
    f"""SELECT {o.MONTH} AS cohort_month, CASE WHEN plan__is_promo THEN 'true' ELSE 'false' END AS plan__is_promo,
gross_add__type, brand, CAST(gross_adds AS VARCHAR) AS gross_adds FROM ({o.spine(BRAND)})""",
)
def sink_csv_append(spark, sf):
    sink = sinks.make_sink("csv", storage.scratch_path(spark, "csv"))
    first, second = _halves(spark, sf)
    sink.write("spine", first)
    sink.write("spine", second.toDF(*[f"c{i}" for i in range(len(second.columns))]), overwrite=False)
    return spark.read.option("header", True).csv(sink.path("spine"))


@query(
    "sink_table_columns",
    f"""SELECT {o.MONTH} AS "COHORT_MONTH", plan__is_promo AS "PLAN__IS_PROMO", gross_add__type AS "GROSS_ADD__TYPE",
brand AS "BRAND", gross_adds AS "GROSS_ADDS" FROM ({o.spine(BRAND)})""",
)
def sink_table_columns(spark, sf):
    """A managed table, overwritten and then appended to: upper-case names, dates as text."""
    name = f"vintner_{uuid.uuid4().hex}"
    sink = sinks.make_sink("table", spark=spark)
    first, second = _halves(spark, sf)
    sink.write(name, first)
    sink.write(name, second, overwrite=False)
    return sinks.read(spark, name)


@query(
    "collector_flush",
    f"""SELECT {o.MONTH} AS cohort_month, plan__is_promo, gross_add__type, brand, gross_adds FROM ({o.spine(BRAND)})""",
)
def collector_flush(spark, sf):
    sink = sinks.make_sink("parquet", storage.scratch_path(spark, "collector"))
    first, second = _halves(spark, sf)
    sinks.append_all({"spine": [first, second, second.limit(0)]}, sink)
    return plain(sinks.read(spark, sink.path("spine")))


@query(
    "commit_log_repeated_run",
    f"""SELECT {o.MONTH} AS cohort_month, plan__is_promo, gross_add__type, brand, gross_adds, runs FROM ({o.spine(BRAND)}),
(SELECT 2 AS runs)""",
)
def commit_log_repeated_run(spark, sf):
    """A run that dies between two tables and is started again twice, after another run: each row is there once."""
    sink = sinks.make_sink("log", storage.scratch_path(spark, "log"), spark)
    first, second = _halves(spark, sf)
    sinks.append_all({"spine": [first], "runs": [spark.createDataFrame([("first",)], "run string")]}, sink, "first")
    lost = spark.range(1).select(F.raise_error(F.lit("lost")).cast("string").alias("run"))
    try:
        sink.log.append({"spine": second, "runs": lost}, "second")
    except SparkRuntimeException:
        pass
    for _ in range(2):
        sinks.append_all({"spine": [second], "runs": [spark.createDataFrame([("second",)], "run string")]}, sink, "second")
    runs = sink.log.read("runs").agg(F.count("*").cast("int").alias("runs")).first()[0]
    return plain(sink.log.read("spine").withColumn("runs", F.lit(runs)))


@query(
    "registered_view",
    f"""WITH s AS ({o.spine(BRAND)}) SELECT {O_KEYS}, gross_adds,
CASE WHEN gross_adds >= 10 AND plan__is_promo IS NOT NULL AND brand IS NOT NULL AND gross_add__type IS NOT NULL AND cohort_month IS NOT NULL
THEN gross_adds * 2 END AS doubled FROM s""",
)
def registered_view(spark, sf):
    """A view from outside, checked, stored and replaced from its own stored version, then joined to the spine."""
    spine = storage.cut(cohorts.cohort_spine(src.gross_add_metrics(spark, sf), BRAND, src.AS_OF, src.START, src.EXCLUDED_BRAND))
    folder = storage.scratch_path(spark, "views")
    view = features.View("DOUBLED", spine.select(*BRAND.keys, (F.col("gross_adds") * 2).alias("doubled")))
    held = features.registered(view, BRAND.keys, folder)
    large = features.View("DOUBLED", held.rows.filter("doubled >= 20"))
    held = features.registered(large, BRAND.keys, folder, replace_stored=True)
    return plain(features.dataset(spine.select(*BRAND.keys, "gross_adds"), [held], BRAND.keys))


@query("dataset_cache", o.cohort(o.clean(BRAND)))
def dataset_cache(spark, sf):
    """Second load of a level reads what the first one stored."""
    folder = storage.scratch_path(spark, "cache")
    sources = src.cohort_sources(spark, sf)
    for _ in range(2):
        frame = dataset_plan.load_clean_dataset(sources, src.AS_OF, src.START, BRAND, src.EXCLUDED_BRAND, folder)
    return plain(frame)


def _two_dates() -> str:
    early = o.cohort(o.clean(BRAND)).replace(str(src.AS_OF), "1999-01-01")
    late = o.cohort(o.clean(BRAND))
    return f"SELECT 'late' AS loaded, * FROM ({late}) UNION ALL SELECT 'early' AS loaded, * FROM ({early})"


@query("dataset_cache_two_dates", _two_dates())
def dataset_cache_two_dates(spark, sf):
    """Two dates through one folder are two entries."""
    folder = storage.scratch_path(spark, "cache")
    sources = src.cohort_sources(spark, sf)
    load = lambda day: dataset_plan.load_clean_dataset(sources, day, src.START, BRAND, src.EXCLUDED_BRAND, folder)
    late, early = load(src.AS_OF), load(dt.date(1999, 1, 1))
    rows = late.withColumn("loaded", F.lit("late")).unionByName(early.withColumn("loaded", F.lit("early")))
    return plain(rows)


@query("spine_maintained", o.cohort(o.spine(BRAND)))
def spine_maintained(spark, sf):
    """Sums per day kept from two earlier dates, when later rows were not there yet."""
    folder, gross = storage.scratch_path(spark, "days"), src.gross_add_metrics(spark, sf)
    for as_of in (dt.date(1996, 9, 1), dt.date(1997, 11, 15), src.AS_OF):
        known = gross.filter(F.col("gross_add__created__day") <= F.lit(as_of)) if as_of < src.AS_OF else gross
        spine = dataset_plan.maintained_spine(known, BRAND, as_of, src.START, src.EXCLUDED_BRAND, folder=folder)
    return plain(spine)


@query("load_and_store", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def load_and_store(spark, sf):
    sink = sinks.make_sink("parquet", storage.scratch_path(spark, "raw"))
    source = cache.load_through(
        spark, sink.folder, "orders", lambda: src.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    )
    load_store.load_and_store(lambda: source, sink)
    return sinks.read(spark, sink.path("RAW_DATA"))
