"""Payment-risk job: processor reports -> normalised events -> report over all dimensions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from vintner.config import MIN_BAD_COUNT
from vintner.functions.dates import months_back
from vintner.functions.safe import upper_names
from vintner.operators import risk
from vintner.sources.cache import load_through


@dataclass(frozen=True)
class RiskSources:
    transactions: DataFrame | risk.StoredTransactions
    traffic_sources: DataFrame
    plans: DataFrame
    payment_options: DataFrame
    adyen_disputes: DataFrame | None = None
    adyen_payments: DataFrame | None = None
    braintree_disputes: DataFrame | None = None
    braintree_fraud: DataFrame | None = None
    braintree_transactions: DataFrame | None = None
    worldpay_chargebacks: DataFrame | None = None  # off unless given


def processor_events(
    sources: RiskSources, window: risk.ReportWindow, excluded_adyen=None, excluded_braintree=None, excluded_worldpay=None
) -> DataFrame:
    """All reports as one frame of events. Transactions are shuffled once per join key, stored ones not at all; dimensions meet only events."""
    tables = sources.transactions, sources.traffic_sources, sources.plans, sources.payment_options
    by_reference = [
        normalise(report, window, excluded_adyen)
        for normalise, report in (
            (risk.adyen_disputes, sources.adyen_disputes),
            (risk.adyen_settlements, sources.adyen_payments),
        )
        if report is not None
    ]
    by_processor_id = [
        normalise(report, window, excluded)
        for normalise, report, excluded in (
            (risk.braintree_disputes, sources.braintree_disputes, excluded_braintree),
            (risk.braintree_fraud, sources.braintree_fraud, excluded_braintree),
            (risk.braintree_settlements, sources.braintree_transactions, excluded_braintree),
            (risk.worldpay_disputes, sources.worldpay_chargebacks, excluded_worldpay),
        )
        if report is not None
    ]
    if not by_reference and not by_processor_id:
        raise ValueError("no processor report given")
    unique = risk.one_row_per_id(*tables)  # each report has its own types or processor, so the stacked rows are distinct
    attached = [
        attach(_stack(frames), *tables, unique=unique)
        for attach, frames in (
            (risk.events_by_reference, by_reference),
            (risk.events_by_processor_id, by_processor_id),
        )
        if frames
    ]
    return risk.clean_networks(_stack(attached))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def risk_report(
    sources: RiskSources,
    as_of: dt.date,
    min_bad_count: int = MIN_BAD_COUNT,
    cache_folder: str | None = None,
    sink=None,
    **exclusions,
) -> DataFrame:
    """Report over the last six months; events are cached by start date, sources and exclusions when a folder is given."""
    start = months_back(as_of, 6)
    spark = sources.plans.sparkSession
    history, *reports = vars(sources).values()
    tables = [history.by_id.rows, history.by_processor_id.rows] if isinstance(history, risk.StoredTransactions) else [history]
    events = load_through(
        spark,
        cache_folder,
        start.isoformat(),
        lambda: processor_events(sources, risk.ReportWindow(start), **exclusions),
        enabled=cache_folder is not None,
        sources=[*tables, *reports],
        **exclusions,
    )
    report = risk.risk_all_levels(events, min_bad_count=min_bad_count)
    if sink is not None:
        sink.write("threshold_all_levels", upper_names(report))
    return report
