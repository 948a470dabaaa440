"""The synthetic tables in the shape of the library's sources (see FIXTURES.md, part 2)."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintner.config import BILLING_DAYS, EARLY_DAYS, cross_sell_column
from vintner.plans.cohort_dataset import CohortSources
from vintner.plans.risk_report import RiskSources

AS_OF = dt.date(2001, 8, 2)
START = dt.date(1996, 1, 1)
EXCLUDED_BRAND = "MIDDLE EAST"
MIN_COHORT_SIZE = 20
MIN_BAD_COUNT = 500
RISK_START = dt.date(1996, 1, 1)


@lru_cache(maxsize=64)  # listing a folder and reading its footer takes longer than planning
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark, sf_dir) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").join(customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))


def _keys() -> dict:
    return {
        "brand": F.col("r_name"),
        "sku_type": F.col("c_mktsegment"),
        "channel": F.col("o_orderpriority"),
        "traffic_source": F.col("n_name"),
        "campaign": F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("C"), F.col("o_custkey") % 7)),
    }


def _entity_keys() -> list:
    keys = [value.alias(f"gross_add__{name}") for name, value in _keys().items()]
    return [
        *keys,
        F.col("o_orderstatus").alias("gross_add__type"),
        F.trunc(F.to_date("o_orderdate"), "MM").alias("gross_add__created__month"),
        (F.col("o_orderkey") % 2 == 0).alias("gross_add__plan__is_promo"),
    ]


def _flag(condition):
    return F.when(condition, 1).otherwise(0).cast("bigint")


def gross_add_metrics(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    return _orders(spark, sf_dir).select(
        F.to_date("o_orderdate").alias("gross_add__created__day"),
        F.col("o_orderstatus").alias("gross_add__type"),
        *[value.alias(name) for name, value in _keys().items()],
        (key % 2 == 0).alias("plan__is_promo"),
        (1 + key % 5).alias("plan__promo_price"),
        (7 * (1 + key % 3)).alias("plan__promo_days"),
        (10 + F.col("o_custkey") % 20).alias("plan__recurring_price"),
        (30 * (1 + F.col("o_custkey") % 3)).alias("plan__recurring_days"),
        (1 + key % 3).alias("gross_adds"),
        _flag(key % 12 == 0).alias("gross_adds_canceled_day_one"),
        _flag(key % 6 == 0).alias("gross_adds_canceled_day_three"),
        _flag(key % 3 == 0).alias("gross_adds_canceled_day_seven"),
    )


def retention_metrics(spark, sf_dir) -> DataFrame:
    key, adds = F.col("o_orderkey"), 1 + F.col("o_orderkey") % 3
    return _orders(spark, sf_dir).select(
        *_entity_keys(),
        F.when(key % 2 == 0, adds).otherwise(0).alias("eligible_promo_activations"),
        F.when(key % 4 == 0, adds).otherwise(0).alias("survived_promo_activations_excl_retries"),
        F.when(key % 5 != 0, adds).otherwise(0).alias("eligible_first_rebills"),
        F.when((key % 5 != 0) & (key % 7 != 0), adds).otherwise(0).alias("survived_first_rebills_excl_retries"),
    )


def _order_lines(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", F.to_date("l_shipdate").alias("shipped"))
    lag = F.date_diff(F.col("shipped"), F.to_date("o_orderdate"))
    return _orders(spark, sf_dir).join(lines, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("lag", lag)


def billing_metrics(spark, sf_dir) -> DataFrame:
    """One row per line; status P is left out, so that some cohorts have no billing at all."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return (
        _order_lines(spark, sf_dir)
        .filter(F.col("o_orderstatus") != "P")
        .select(
            *_entity_keys(),
            *[
                F.when(F.col("lag").between(0, n), price).alias(f"net_billings_{n}_days_since_gross_add")
                for n in BILLING_DAYS
            ],
        )
    )


def cross_sell_metrics(spark, sf_dir) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        *_entity_keys(),
        (10 + F.col("o_custkey") % 20).alias("plan__recurring_price"),
        F.lit(1).cast("bigint").alias("cross_sell_adds"),
        *[_flag(F.col("lag").between(0, n)).alias(cross_sell_column(n)) for n in EARLY_DAYS],
    )


def cohort_sources(spark, sf_dir) -> CohortSources:
    return CohortSources(
        gross_add_metrics(spark, sf_dir),
        retention_metrics(spark, sf_dir),
        billing_metrics(spark, sf_dir),
        cross_sell_metrics(spark, sf_dir),
    )


# --- payment risk --------------------------------------------------------------------------------


def transactions(spark, sf_dir) -> DataFrame:
    return _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("bt"), F.col("o_orderkey")).alias("payment_processor_id"),
        F.col("r_name").alias("brand_slug"),
        F.col("c_mktsegment").alias("sku_type_slug"),
        F.col("o_orderpriority").alias("channel_slug"),
        (F.col("o_custkey") % 50).cast("string").alias("bin"),
        F.col("c_nationkey").cast("bigint").alias("traffic_source_id"),
        (F.col("o_orderkey") % 2500).alias("plan_id"),
        (F.col("o_custkey") % 120).alias("payment_option_id"),
    )


def _network(key):
    # fixed values: spellings of card networks by supplier
    names = {0: "mc", 1: "Visa", 2: "American Express"}
    result = F.lit("visa")
    for remainder, name in names.items():
        result = F.when(key % 4 == remainder, name).otherwise(result)
    return result


def reference_text():
    key = F.col("l_orderkey").cast("string")
    return F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("TXN_"), key)).otherwise(F.lpad(key, 9, "0"))


def _record_type():
    flag = F.col("l_returnflag")
    return F.when(flag == "R", "Chargeback").when(flag == "A", "NotificationOfFraud").otherwise("Settled")


def _adyen_columns() -> list:
    return [
        F.concat(F.lit("M"), F.col("l_suppkey") % 8).alias("Merchant Account"),
        _network(F.col("l_suppkey")).alias("Payment Method"),
        _record_type().alias("Record Type"),
    ]


def risk_sources(spark, sf_dir, with_worldpay: bool = False) -> RiskSources:
    nation, part = table(spark, sf_dir, "nation"), table(spark, sf_dir, "part")
    supplier, lines = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "lineitem")
    events = table(spark, sf_dir, "events")
    number = F.col("l_linenumber")
    event_id = F.concat(F.lit("bt"), F.col("event_id"))
    merchant = F.concat(F.lit("m"), F.col("user_id") % 5)
    adyen_disputes = lines.select(
        reference_text().alias("Capture Modification Merchant Reference"),
        *_adyen_columns(),
        F.col("l_shipdate").alias("Record Date"),
        F.when(number != 6, number == 7).alias("RDR"),
    )
    adyen_payments = lines.select(
        reference_text().alias("Merchant Reference"), *_adyen_columns(), F.col("l_shipdate").alias("Creation Date")
    )
    # the JSON of an event carries a number under the key k; it picks a card type
    k = F.get_json_object("props", "$.k").cast("int") % 10
    network = F.when(k == 0, "paypal_account").when(k == 1, "Master Card").when(k == 2, "mc").otherwise("visa")
    as_json = F.concat(F.lit('{"paymentInstrumentSubtype": "'), network, F.lit('"}'))
    value_json = F.concat(F.lit('{"paymentInstrumentType": "'), network, F.lit('"}'))
    kind = F.when(F.col("event_type") == "click", "chargeback").otherwise(F.col("event_type"))
    braintree_disputes = events.select(
        event_id.alias("id"),
        merchant.alias("merchantaccountid"),
        kind.alias("kind"),
        as_json.alias("transaction"),
        F.col("ts").alias("receiveddate"),
    )
    braintree_fraud = events.filter(F.col("event_type") == "error").select(
        event_id.alias("transaction_id"),
        merchant.alias("merchant_account"),
        network.alias("payment_instrument_subtype"),
        F.col("ts").alias("fraud_post_date"),
    )
    braintree_transactions = events.select(
        event_id.alias("id"),
        merchant.alias("merchantaccountid"),
        F.when(F.col("event_type") == "purchase", "sale").otherwise(F.col("event_type")).alias("type"),
        value_json.alias("value"),
        F.col("ts").alias("createdat"),
    )
    worldpay = lines.filter(F.col("l_suppkey") % 9 == 0).select(
        F.concat(F.repeat(F.lit("'"), 1 + number % 2), F.lit("bt"), F.col("l_orderkey")).alias("Vantiv Payment ID"),
        F.concat(F.lit("Shop, Inc  "), F.col("l_suppkey") % 4).alias("Merchant Name"),
        (F.col("l_suppkey") % 3).cast("string").alias("MID"),
        F.concat(F.lit("ARN"), F.col("l_partkey")).alias("ARN"),
        F.when(F.col("l_returnflag") == "R", "FIRST_CHARGEBACK").otherwise("OTHER").alias("Cycle"),
        F.col("l_shipdate").alias("Reporting Date"),
    )
    return RiskSources(
        transactions(spark, sf_dir),
        nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("short_name")),
        part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("offer_type")),
        supplier.select(F.col("s_suppkey").alias("id"), _network(F.col("s_suppkey")).alias("card_network")),
        adyen_disputes,
        adyen_payments,
        braintree_disputes,
        braintree_fraud,
        braintree_transactions,
        worldpay if with_worldpay else None,
    )


# --- lifetime value ------------------------------------------------------------------------------


def customer_billings(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    first = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min("o_orderdate").alias("acquisition_date"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", F.to_date("l_shipdate").alias("shipped")
    )
    dims = customers(spark, sf_dir).select(F.col("c_custkey").alias("customer_id"), "r_name", "c_mktsegment")
    rows = (
        lines.join(orders.select("o_orderkey", F.col("o_custkey").alias("customer_id")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(dims.join(first, "customer_id"), "customer_id")
        .withColumn("days", F.date_diff(F.col("shipped"), F.to_date("acquisition_date")))
        .filter(F.col("days") >= 0)
    )
    customer, price = F.col("customer_id"), F.col("l_extendedprice").cast("decimal(18,2)")
    # fixed values: amount column by line number
    amounts = {1: "initial_sub", 2: "cross", 3: "upsell", 4: "resub", 5: "downsell"}
    return rows.select(
        "customer_id",
        "acquisition_date",
        F.col("r_name").alias("brand"),
        F.col("c_mktsegment").alias("acquisition_sku_bucket"),
        (customer % 3).cast("string").alias("acquisition_channel"),
        (customer % 4).cast("string").alias("payment_type"),
        (customer % 2).cast("string").alias("mobile"),
        _flag(customer % 9 == 0).cast("int").alias("canceled_day_1"),
        F.floor(F.col("days") / 30).cast("int").alias("month_age"),
        (30 * (1 + customer % 2)).cast("int").alias("recurring_period_days"),
        *[F.when(F.col("l_linenumber") == n, price).alias(f"{name}_amount") for n, name in amounts.items()],
        F.when(F.col("l_returnflag") == "R", price).alias("refund_amount"),
    )


def daily_series(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.to_date("ts").alias("ds"))
        .agg(F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("y"))
    )


def monthly_series(spark, sf_dir) -> DataFrame:
    return (
        _orders(spark, sf_dir)
        .groupBy("r_name", F.trunc(F.to_date("o_orderdate"), "MM").alias("ds"))
        .agg(F.count("*").cast("double").alias("y"))
    )
