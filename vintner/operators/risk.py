"""Fraud and dispute risk per payment dimension and per combination of dimensions.

Every report is normalised to distinct event rows, so a reference id that repeats a million times is
collapsed on the map side before it is joined. The transaction table is joined once per key, not once
per report.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintner.config import MIN_BAD_COUNT, RISK_DIMENSIONS
from vintner.functions.dates import since_local_date
from vintner.functions.safe import label_missing, ratio
from vintner.functions.text import card_network, joined, merchant_label, transaction_id, unquoted_id
from vintner.operators.iceberg import frequent_groups
from vintner.operators.joins import StoredSide, open_side, spread_left_join, store_side
from vintner.sources.storage import cut, written

FRAUD, DISPUTE, SETTLEMENT = "fraud", "dispute", "settlement"

EVENT_COLUMNS = [
    "ref_txn_id",
    "txn_id",
    "processor",
    "type",
    "merchant_account",
    "card_network",
    "brand_slug",
    "sku_type_slug",
    "channel_slug",
    "traffic_source_short_name",
    "bin",
    "offer_type",
    "count",
]


@dataclass(frozen=True)
class ReportWindow:
    """Start date in the report zone, and the zone the report timestamps are stored in."""

    date: dt.date
    source_zone: str = "UTC"

    def keeps(self, ts: Column) -> Column:
        return since_local_date(ts, self.date, source_zone=self.source_zone)


def _excluding(merchant: Column, excluded: str | None) -> Column:
    return F.lit(True) if excluded is None else merchant != excluded


def _distinct_events(rows: DataFrame, processor: str) -> DataFrame:
    columns = ["ref_txn_id", "type", "merchant_account", "card_network"]
    return rows.select(*columns).distinct().withColumn("processor", F.lit(processor))


# --- report normalisers: one row per distinct event, before transaction attributes ---------------


def adyen_disputes(report: DataFrame, window: ReportWindow, excluded: str | None = None) -> DataFrame:
    """Chargebacks and fraud notices, without cases already resolved by rapid dispute resolution."""
    record = F.col("Record Type")
    rows = report.filter(
        window.keeps(F.col("Record Date"))
        & _excluding(F.col("Merchant Account"), excluded)
        & ~F.col("RDR")
        & record.isin("Chargeback", "NotificationOfFraud")
    ).select(
        F.col("Capture Modification Merchant Reference").alias("ref_txn_id"),
        F.when(record == "Chargeback", DISPUTE).when(record == "NotificationOfFraud", FRAUD).alias("type"),
        F.col("Merchant Account").alias("merchant_account"),
        F.col("Payment Method").alias("card_network"),
    )
    return _distinct_events(rows, "adyen")


def adyen_settlements(report: DataFrame, window: ReportWindow, excluded: str | None = None) -> DataFrame:
    rows = report.filter(
        window.keeps(F.col("Creation Date"))
        & _excluding(F.col("Merchant Account"), excluded)
        & F.col("Record Type").isin("Settled")
    ).select(
        F.col("Merchant Reference").alias("ref_txn_id"),
        F.lit(SETTLEMENT).alias("type"),
        F.col("Merchant Account").alias("merchant_account"),
        F.col("Payment Method").alias("card_network"),
    )
    return _distinct_events(rows, "adyen")


def braintree_disputes(report: DataFrame, window: ReportWindow, excluded: str | None = None) -> DataFrame:
    network = F.get_json_object("transaction", "$.paymentInstrumentSubtype")
    rows = report.filter(
        window.keeps(F.col("receiveddate"))
        & _excluding(F.col("merchantaccountid"), excluded)
        & (F.col("kind") == "chargeback")
        & (network != "paypal_account")
    ).select(
        F.col("id").alias("ref_txn_id"),
        F.lit(DISPUTE).alias("type"),
        F.col("merchantaccountid").alias("merchant_account"),
        network.alias("card_network"),
    )
    return _distinct_events(rows, "braintree")


def braintree_fraud(report: DataFrame, window: ReportWindow, excluded: str | None = None) -> DataFrame:
    rows = report.filter(
        window.keeps(F.col("fraud_post_date")) & _excluding(F.col("merchant_account"), excluded)
    ).select(
        F.col("transaction_id").alias("ref_txn_id"),
        F.lit(FRAUD).alias("type"),
        "merchant_account",
        F.col("payment_instrument_subtype").alias("card_network"),
    )
    return _distinct_events(rows, "braintree")


def braintree_settlements(report: DataFrame, window: ReportWindow, excluded: str | None = None) -> DataFrame:
    """Sales; their card network comes from the payment option of the transaction."""
    rows = report.filter(
        window.keeps(F.col("createdat"))
        & _excluding(F.col("merchantaccountid"), excluded)
        & (F.col("type") == "sale")
        & (F.get_json_object("value", "$.paymentInstrumentType") != "paypal_account")
    ).select(
        F.col("id").alias("ref_txn_id"),
        F.lit(SETTLEMENT).alias("type"),
        F.col("merchantaccountid").alias("merchant_account"),
        F.lit(None).cast("string").alias("card_network"),
    )
    return _distinct_events(rows, "braintree")


def worldpay_disputes(report: DataFrame, window: ReportWindow, excluded_text: str | None = None) -> DataFrame:
    """First chargebacks; the only report whose count is not 0 or 1: distinct ARNs per event."""
    merchant = merchant_label(F.col("Merchant Name"), F.col("MID"))
    rows = report.filter(
        window.keeps(F.col("Reporting Date")) & (F.col("Cycle") == "FIRST_CHARGEBACK")
    ).select(
        unquoted_id(F.col("Vantiv Payment ID")).alias("ref_txn_id"),
        F.lit("worldpay").alias("processor"),
        F.lit(DISPUTE).alias("type"),
        merchant.alias("merchant_account"),
        "ARN",
    )
    if excluded_text is not None:
        rows = rows.filter(~F.col("merchant_account").ilike(f"%{excluded_text}%"))
    return rows.groupBy("ref_txn_id", "processor", "type", "merchant_account").agg(
        F.countDistinct("ARN").alias("count")
    )


# --- transaction attributes ----------------------------------------------------------------------


def transaction_columns(transactions: DataFrame) -> DataFrame:
    """What the reports need of a transaction: its ids, its own attributes and the keys of its dimensions."""
    return transactions.select(
        "id",
        "payment_processor_id",
        "brand_slug",
        "sku_type_slug",
        "channel_slug",
        "bin",
        "traffic_source_id",
        "plan_id",
        "payment_option_id",
    )


@dataclass(frozen=True)
class StoredTransactions:
    """The history bucketed by both ids it is looked up by, so that reports are shuffled and the history is not."""

    by_id: StoredSide
    by_processor_id: StoredSide


def _by_id(transactions: DataFrame) -> DataFrame:
    attributes = transaction_columns(transactions).withColumnRenamed("id", "txn_id")
    return attributes.drop("payment_processor_id", "payment_option_id")


def _by_processor_id(transactions: DataFrame) -> DataFrame:
    return transaction_columns(transactions).withColumnsRenamed({"payment_processor_id": "ref_txn_id", "id": "txn_id"})


def store_transactions(transactions: DataFrame, table: str, buckets: int | None = None) -> StoredTransactions:
    """Write the two bucketed tables ``<table>_by_id`` and ``<table>_by_processor_id``; earlier ones are replaced."""
    return StoredTransactions(
        store_side(_by_id(transactions), "txn_id", f"{table}_by_id", buckets, unique=True),
        store_side(_by_processor_id(transactions), "ref_txn_id", f"{table}_by_processor_id", buckets, ["txn_id"]),
    )


def open_transactions(spark: SparkSession, table: str) -> StoredTransactions:
    """The tables that ``store_transactions`` wrote under this name."""
    return StoredTransactions(
        open_side(spark, "txn_id", f"{table}_by_id"), open_side(spark, "ref_txn_id", f"{table}_by_processor_id")
    )


def with_dimensions(
    rows: DataFrame, traffic_sources: DataFrame, plans: DataFrame, payment_options: DataFrame | None = None
) -> DataFrame:
    """Traffic source, offer type and card network of rows that carry the keys of the dimensions.

    The rows are events that already met their transactions, so no dimension is joined to the whole
    history. No broadcast hint: Spark broadcasts a dimension when its measured size is below the
    threshold and shuffles it otherwise.
    """
    sources = traffic_sources.select(
        F.col("id").alias("traffic_source_id"), F.col("short_name").alias("traffic_source_short_name")
    )
    offers = plans.select(F.col("id").alias("plan_id"), "offer_type")
    out = rows.join(sources, "traffic_source_id", "left").join(offers, "plan_id", "left")
    if payment_options is None:
        return out
    options = payment_options.select(
        F.col("id").alias("payment_option_id"), F.col("card_network").alias("option_card_network")
    )
    return out.join(options, "payment_option_id", "left")


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1).select("_rows")


def one_row_per_id(transactions: DataFrame | StoredTransactions, *dimensions: DataFrame) -> bool:
    """Whether no id occurs twice in the transactions or in a dimension; runs a job over the ids alone.

    Distinct events then stay distinct when they meet their transactions: those that meet several differ in ``txn_id``.
    """
    if isinstance(transactions, StoredTransactions):
        # stored without shuffles: slices of an id lie together, and NULL ids only in the second table
        without_id = transactions.by_processor_id.rows.filter(F.col("txn_id").isNull())
        found = [_repeated(transactions.by_id.rows, "txn_id", "_salt"), _repeated(without_id, "ref_txn_id", "_salt")]
    else:
        found = [_repeated(transactions, "id")]
    found += [_repeated(d.filter(F.col("id").isNotNull()), "id") for d in dimensions]
    return reduce(DataFrame.unionByName, found).isEmpty()


def events_by_reference(
    events: DataFrame,
    transactions: DataFrame | StoredTransactions,
    traffic_sources: DataFrame,
    plans: DataFrame,
    payment_options: DataFrame,
    unique: bool = False,
) -> DataFrame:
    """Attach transactions by the numeric id inside the reference; an unreadable id counts 0.

    Grouping by every selected column leaves one row per tuple, so distinct rows with a 0/1 count say
    the same as a distinct count. ``unique`` says that the events are distinct and ``one_row_per_id`` holds, so the
    rows already are: whole events then need not be held in memory to compare them.
    """
    keyed = events.withColumn("txn_id", transaction_id(F.col("ref_txn_id")))
    history = transactions.by_id if isinstance(transactions, StoredTransactions) else _by_id(transactions)
    met = spread_left_join(keyed, history, "txn_id", unique=True)
    count = F.when(F.col("txn_id").isNull(), 0).otherwise(1).cast("bigint").alias("count")
    full = with_dimensions(met, traffic_sources, plans).select(*EVENT_COLUMNS[:-1], count)
    return full if unique else full.distinct()


def events_by_processor_id(
    events: DataFrame,
    transactions: DataFrame | StoredTransactions,
    traffic_sources: DataFrame,
    plans: DataFrame,
    payment_options: DataFrame,
    unique: bool = False,
) -> DataFrame:
    """Attach transactions by the processor's own id. One id may belong to several transactions.

    Settlements take the card network of the payment option. The card-file report comes with its own
    count and has neither a card network nor a SKU type. ``unique`` as for ``events_by_reference``, where
    settlements come without a card network of their own.
    """
    events = events.withColumns(
        {
            "_sells_sku": F.col("processor") != "worldpay",
            "count": F.coalesce("count", F.col("ref_txn_id").isNotNull().cast("bigint"))
            if "count" in events.columns
            else F.col("ref_txn_id").isNotNull().cast("bigint"),
        }
    )
    derived = {
        "card_network": F.when(F.col("type") == SETTLEMENT, F.col("option_card_network")).otherwise(F.col("card_network")),
        "sku_type_slug": F.when(F.col("_sells_sku"), F.col("sku_type_slug")),
    }
    if isinstance(transactions, StoredTransactions):
        met = spread_left_join(events, transactions.by_processor_id, "ref_txn_id")
    else:
        history = _by_processor_id(transactions)
        met = spread_left_join(events, history, "ref_txn_id", keys_of=history.select("ref_txn_id"), slice_by=["txn_id"])
    full = with_dimensions(met, traffic_sources, plans, payment_options)
    full = full.select(*(derived[c].alias(c) if c in derived else F.col(c) for c in EVENT_COLUMNS))
    return full if unique else full.distinct()


def reference_coverage(events: DataFrame) -> DataFrame:
    """Distinct references per processor and type, and how many of them have no readable or known id."""
    known = events.groupBy("processor", "type", "ref_txn_id").agg(F.count("txn_id").alias("_known"))
    return known.groupBy("processor", "type").agg(
        F.count("*").alias("references"), F.count_if(F.col("_known") == 0).alias("without_id")
    )


def clean_networks(events: DataFrame) -> DataFrame:
    return events.withColumn("card_network", card_network(F.col("card_network")))


# --- reports -------------------------------------------------------------------------------------


def _bad_and_good() -> list[Column]:
    kind, count = F.col("type"), F.col("count")
    return [
        F.sum(F.when(kind.isin(FRAUD, DISPUTE), count).otherwise(0)).alias("fraud_disputes_count"),
        F.sum(F.when(kind == SETTLEMENT, count).otherwise(0)).alias("settled_count"),
    ]


def _add_ratios(counts: DataFrame, totals: DataFrame, on: list[str]) -> DataFrame:
    """Ratios against the global ratio of the same level.

    ``totals`` has one row per level, so its size is fixed by the configuration and it is broadcast.
    ``delta_percentage`` is the quotient of both ratios. A group without settlements has no ratio.
    """
    return _with_deltas(counts.join(F.broadcast(totals), on))


def _with_deltas(counts: DataFrame) -> DataFrame:
    rated = counts.withColumn("ratio", ratio(F.col("fraud_disputes_count"), F.col("settled_count")))
    return rated.withColumns(
        {
            "delta": F.col("ratio") - F.col("global_ratio"),
            "delta_percentage": ratio(F.col("ratio"), F.col("global_ratio")),
        }
    )


def _global_ratio(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.groupBy(*by).agg(
        ratio(F.sum("fraud_disputes_count"), F.sum("settled_count")).alias("global_ratio")
    )


_REPORT = [
    "level",
    "value",
    "fraud_disputes_count",
    "settled_count",
    "ratio",
    "global_ratio",
    "delta",
    "delta_percentage",
]


def risk_ratios(events: DataFrame, dimensions: list[str]) -> DataFrame:
    """Counts and ratios per value of the dimensions, NULL values labelled, highest delta first."""
    counts = events.groupBy(*dimensions).agg(*_bad_and_good()).withColumn("_all", F.lit(1))
    labelled = counts.withColumns({d: label_missing(F.col(d).cast("string"), d) for d in dimensions})
    return (
        _add_ratios(labelled, _global_ratio(counts, ["_all"]), ["_all"])
        .select(*dimensions, *_REPORT[2:])
        .orderBy(F.col("delta").desc_nulls_first())
    )


def risk_all_levels(
    events: DataFrame, dimensions=RISK_DIMENSIONS, min_bad_count: int = MIN_BAD_COUNT, ordered: bool = True
) -> DataFrame:
    """All single-dimension reports from one read: rows are unpivoted and combined on the map side."""
    bad, good = F.col("type").isin(FRAUD, DISPUTE), F.col("type") == SETTLEMENT
    slim = events.select(
        *[F.col(d).cast("string").alias(d) for d in dimensions],
        F.when(bad, F.col("count")).otherwise(0).alias("bad"),
        F.when(good, F.col("count")).otherwise(0).alias("good"),
    )
    counts = (
        slim.unpivot(["bad", "good"], list(dimensions), "level", "value")
        .groupBy("level", "value")
        .agg(F.sum("bad").alias("fraud_disputes_count"), F.sum("good").alias("settled_count"))
    )
    # rows and totals both come from the counts; stored, the events behind them are read only once
    report = _thresholded(cut(counts), min_bad_count, F.coalesce("value", F.concat(F.lit("MISSING_"), F.upper("level"))))
    position = F.array_position(F.array(*[F.lit(d.upper()) for d in dimensions]), F.col("level"))
    return report.orderBy(position, F.col("delta_percentage").desc_nulls_first()) if ordered else report


def level_combinations(dimensions=RISK_DIMENSIONS, min_size: int = 2, max_size: int | None = None) -> list[list[str]]:
    sizes = range(min_size, (max_size or len(dimensions)) + 1)
    return [list(combo) for size in sizes for combo in combinations(dimensions, size)]


def risk_combinations(
    events: DataFrame,
    combos: list[list[str]] | None = None,
    dimensions=RISK_DIMENSIONS,
    min_bad_count: int = MIN_BAD_COUNT,
    ordered: bool = True,
) -> DataFrame:
    """Reports for many combinations of dimensions, by default all pairs, those far above the global ratio first.

    Most groups of a large combination fall below the threshold, so they are never built: events are
    reduced to distinct dimension tuples and stored, and the lattice of combinations is walked from single
    dimensions downwards (``iceberg``). A combination is a bit mask, so generated code does not grow with
    their number. Every event lies in one group of each combination, so the global ratio is the same for all.
    """
    combos = combos or level_combinations(dimensions, 2, 2)
    bit = {d: 1 << i for i, d in enumerate(dimensions)}
    name_of = {sum(bit[d] for d in combo): "-".join(combo).upper() for combo in combos}

    def used(dimension):
        return F.col("_mask").bitwiseAND(bit[dimension]) != 0

    tuples = written(events.groupBy(*dimensions).agg(*_bad_and_good()), "risk-tuples")
    global_ratio = tuples.agg(ratio(F.sum("fraud_disputes_count"), F.sum("settled_count"))).first()[0]
    counts = frequent_groups(tuples, list(dimensions), list(name_of), "fraud_disputes_count", "settled_count", min_bad_count)
    # label after the aggregate: one string per group, not one per row and combination
    names = F.create_map(*[F.lit(x) for item in name_of.items() for x in item])
    parts = [F.when(used(d), label_missing(F.col(d).cast("string"), d)) for d in dimensions]
    rated = counts.withColumns(
        {"level": names[F.col("_mask")], "value": joined(*parts), "global_ratio": F.lit(global_ratio).cast("double")}
    )
    report = _with_deltas(rated).select(*_REPORT)
    return report.orderBy(F.col("delta_percentage").desc_nulls_first()) if ordered else report


def _thresholded(counts: DataFrame, min_bad_count: int, value: Column) -> DataFrame:
    totals = _global_ratio(counts, ["level"])
    kept = counts.filter(F.col("fraud_disputes_count") > min_bad_count)
    return (
        _add_ratios(kept, totals, ["level"])
        .withColumns({"value": value, "level": F.upper("level")})
        .select(*_REPORT)
    )
