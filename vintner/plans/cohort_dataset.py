"""Cohort dataset job: spine and three views joined at one level."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from vintner.config import EARLY_DAYS, LEVELS, Level
from vintner.operators.cohorts import (
    DAY,
    billing_view,
    clean_dataset,
    cohort_spine,
    cohort_spine_of_days,
    cross_sell_view,
    retention_view,
    spine_days,
)
from vintner.operators.features import View, dataset, store_dataset, store_view
from vintner.sources.cache import load_through
from vintner.sources.increments import load_days


@dataclass(frozen=True)
class CohortSources:
    gross_adds: DataFrame
    retention: DataFrame
    billing: DataFrame
    cross_sell: DataFrame


VIEWS = {
    "RETENTION_METRICS": (retention_view, "retention"),
    "BILLING_METRICS": (billing_view, "billing"),
    "CROSS_SELL_METRICS": (cross_sell_view, "cross_sell"),
}


def cohort_dataset(
    sources: CohortSources,
    level: Level,
    as_of: dt.date,
    start: dt.date,
    excluded_brand: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Spine and views at one level; with a folder, views and dataset are stored there.

    The views are aggregates by their keys, so none can hold a key twice and none is tested for it.
    """
    spine = cohort_spine(sources.gross_adds, level, as_of, start, excluded_brand)
    views = [View(f"{level.name}_{name}", make(getattr(sources, source), level)) for name, (make, source) in VIEWS.items()]
    if folder:
        views = [store_view(view, folder, replace_stored=True) for view in views]
    rows = dataset(spine, views, level.keys)
    return store_dataset(rows, folder, "COHORT_DATASET") if folder else rows


def load_clean_dataset(
    sources: CohortSources,
    as_of: dt.date,
    start: dt.date,
    level: Level = LEVELS[-1],
    excluded_brand: str | None = None,
    cache_folder: str | None = None,
) -> DataFrame:
    """Cleaned dataset; with a cache folder, the joined dataset is stored once per level, arguments and sources."""
    stored = load_through(
        sources.gross_adds.sparkSession,
        cache_folder,
        level.name,
        lambda: cohort_dataset(sources, level, as_of, start, excluded_brand),
        enabled=cache_folder is not None,
        sources=[sources.gross_adds, sources.retention, sources.billing, sources.cross_sell],
        columns=level.columns,
        as_of=as_of,
        start=start,
        excluded_brand=excluded_brand,
    )
    return clean_dataset(stored)


def maintained_spine(
    gross_adds: DataFrame,
    level: Level,
    as_of: dt.date,
    start: dt.date,
    excluded_brand: str | None = None,
    *,
    folder: str,
    settled_days: int = max(EARLY_DAYS) + 30,
) -> DataFrame:
    """The spine over sums per day that are kept in a folder: each date reads only the days since the last one, less
    ``settled_days``. Those are by default the longest time that cancellations are counted for and a month."""
    spark, make = gross_adds.sparkSession, lambda rows: spine_days(rows, level)
    days = load_days(spark, folder, level.name, gross_adds, DAY, make, as_of, settled_days, columns=level.columns)
    return cohort_spine_of_days(days, level, as_of, start, excluded_brand)
