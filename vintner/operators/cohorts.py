"""Monthly cohort spine and the three feature views, at any level of the hierarchy.

All measures are sums, or ratios of sums taken after the aggregate, so every groupBy combines on the
map side: a cohort that holds a third of the rows shuffles as one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner import config as c
from vintner.config import Level
from vintner.functions.dates import matured, month_of
from vintner.functions.safe import div0, ratio

# (name, source column) of the averages weighted by gross adds
_WEIGHTED = {
    "avg_promo_days": "plan__promo_days",
    "avg_promo_price": "plan__promo_price",
    "avg_recurring_days": "plan__recurring_days",
    "avg_recurring_price": "plan__recurring_price",
}
_ENTITY = "gross_add__"
DAY = "gross_add__created__day"


def _weight_sum(name: str) -> str:
    return f"_{name}_sum"


def _sum_if(condition: Column, value: str) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(0))


def spine_sums(
    gross_adds: DataFrame,
    level: Level,
    as_of: dt.date,
    start: dt.date,
    excluded_brand: str | None = None,
) -> DataFrame:
    """The additive part of the spine: one row per cohort month, promo flag, type and level prefix."""
    rows = _from_start(gross_adds, start, excluded_brand)
    weighted = {_weight_sum(name): F.col(source) * F.col(c.GROSS_ADDS) for name, source in _WEIGHTED.items()}
    return _matured_sums(_with_keys(rows).withColumns(weighted), level, as_of)


def _from_start(rows: DataFrame, start: dt.date, excluded_brand: str | None) -> DataFrame:
    rows = rows.filter(F.col(DAY) >= F.lit(start))
    return rows if excluded_brand is None else rows.filter(F.col("brand") != excluded_brand)


def _with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"campaign": F.coalesce("campaign", F.lit(c.MISSING_CAMPAIGN)), c.COHORT_MONTH: month_of(F.col(DAY))}
    )


def _matured_sums(rows: DataFrame, level: Level, as_of: dt.date) -> DataFrame:
    def is_matured(days):
        return matured(F.col(DAY), days, as_of)

    return rows.groupBy(*level.keys).agg(
        *[_sum_if(is_matured(n), c.GROSS_ADDS).alias(c.matured_column(n)) for n in c.MATURITY_DAYS],
        F.sum(c.GROSS_ADDS).alias(c.GROSS_ADDS),
        *[_sum_if(is_matured(n), c.canceled_column(n)).alias(c.canceled_column(n)) for n in c.EARLY_DAYS],
        *[F.sum(_weight_sum(name)).alias(_weight_sum(name)) for name in _WEIGHTED],
    )


def spine_days(gross_adds: DataFrame, level: Level) -> DataFrame:
    """Sums per day and key of the level, for any date and start: what a folder of days keeps of the raw rows."""
    counts = [c.GROSS_ADDS, *(c.canceled_column(n) for n in c.EARLY_DAYS)]
    weights = [F.sum(F.col(x) * F.col(c.GROSS_ADDS)).alias(_weight_sum(name)) for name, x in _WEIGHTED.items()]
    return _with_keys(gross_adds).groupBy(DAY, *level.keys).agg(*[F.sum(n).alias(n) for n in counts], *weights)


def cohort_spine_of_days(days: DataFrame, level: Level, as_of, start, excluded_brand=None) -> DataFrame:
    """The spine from the sums of ``spine_days``."""
    return spine_measures(_matured_sums(_from_start(days, start, excluded_brand), level, as_of), level.keys)


def spine_measures(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Rates, weighted averages and promo ratios on top of the sums."""
    averages = {name: div0(F.col(_weight_sum(name)), F.col(c.GROSS_ADDS)) for name in _WEIGHTED}
    for name in ("avg_promo_days", "avg_promo_price"):
        averages[name] = F.when(F.col(c.IS_PROMO), averages[name])
    with_averages = sums.withColumns(averages)
    early = []
    for n in c.EARLY_DAYS:
        count = c.canceled_column(n)
        early += [F.col(count), div0(F.col(count), F.col(c.matured_column(n))).alias(f"{count}_rate")]
    return with_averages.select(
        *keys,
        *[c.matured_column(n) for n in c.MATURITY_DAYS],
        c.GROSS_ADDS,
        *early,
        *_WEIGHTED,
        *[
            div0(F.col(f"avg_promo_{kind}"), F.col(f"avg_recurring_{kind}")).alias(
                f"promo_to_recurring_{kind}_ratio"
            )
            for kind in ("days", "price")
        ],
    )


def cohort_spine(gross_adds, level: Level, as_of, start, excluded_brand=None) -> DataFrame:
    sums = spine_sums(gross_adds, level, as_of, start, excluded_brand)
    return spine_measures(sums, level.keys)


def cohort_spine_all_levels(gross_adds, as_of, start, excluded_brand=None) -> DataFrame:
    """Every level in one pass: the finest sums are rolled up, the raw rows are read once.

    ``level`` names the depth; columns below it are NULL.
    """
    finest = c.LEVELS[-1]
    sums = spine_sums(gross_adds, finest, as_of, start, excluded_brand)
    measures = [name for name in sums.columns if name not in finest.keys]
    sets = [[F.col(k) for k in level.keys] for level in c.LEVELS]
    depth_of = {
        # grouping_id has one bit per key, 1 where the key is rolled up
        (1 << (len(c.LEVELS) - i)) - 1: level.name
        for i, level in enumerate(c.LEVELS, start=1)
    }
    level_name = F.coalesce(*[F.when(F.col("_gid") == gid, F.lit(name)) for gid, name in depth_of.items()])
    rolled = (
        sums.groupingSets(sets, *[F.col(k) for k in finest.keys])
        .agg(F.grouping_id().alias("_gid"), *[F.sum(m).alias(m) for m in measures])
        .withColumn("level", level_name)
    )
    return spine_measures(rolled, ["level", *finest.keys])


def without_entity_prefix(source: DataFrame) -> DataFrame:
    """``gross_add__brand`` -> ``brand`` and so on; the month becomes the cohort month."""
    kept_prefix = {c.ADD_TYPE}
    renamed = {
        name: name.removeprefix(_ENTITY)
        for name in source.columns
        if name.startswith(_ENTITY) and name not in kept_prefix
    }
    renamed["gross_add__created__month"] = c.COHORT_MONTH
    return source.withColumnsRenamed(renamed).withColumn(
        "campaign", F.coalesce("campaign", F.lit(c.MISSING_CAMPAIGN))
    )


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def retention_view(source: DataFrame, level: Level) -> DataFrame:
    pairs = [
        ("eligible_promo_activations", "survived_promo_activations_excl_retries", "promo_activation_rate_excl_retries"),
        ("eligible_first_rebills", "survived_first_rebills_excl_retries", "first_rebill_rate_excl_retries"),
    ]
    counts = [name for eligible, survived, _ in pairs for name in (eligible, survived)]
    sums = without_entity_prefix(source).groupBy(*level.keys).agg(*[F.sum(n).alias(n) for n in counts])
    measures = []
    for eligible, survived, rate in pairs:
        measures += [
            _or_zero(F.col(eligible)).alias(eligible),
            _or_zero(F.col(survived)).alias(survived),
            _or_zero(div0(F.col(survived), F.col(eligible))).alias(rate),
        ]
    return sums.select(*level.keys, *measures)


def billing_view(source: DataFrame, level: Level) -> DataFrame:
    """Net billings within N days of the gross add; a cohort without any stays NULL."""
    return (
        without_entity_prefix(source)
        .groupBy(*level.keys)
        .agg(*[F.sum(f"net_billings_{n}_days_since_gross_add").alias(c.billings_column(n)) for n in c.BILLING_DAYS])
    )


def cross_sell_view(source: DataFrame, level: Level) -> DataFrame:
    days = [c.cross_sell_column(n) for n in c.EARLY_DAYS]
    sums = (
        without_entity_prefix(source)
        .groupBy(*level.keys)
        .agg(
            F.sum("cross_sell_adds").alias("total_cross_sell_adds"),
            F.sum(F.col("plan__recurring_price") * F.col("cross_sell_adds")).alias("_price_sum"),
            *[F.sum(d).alias(d) for d in days],
        )
    )
    price = _or_zero(div0(F.col("_price_sum"), F.col("total_cross_sell_adds")))
    return sums.select(
        *level.keys,
        "total_cross_sell_adds",
        price.alias("avg_cross_sell_price"),
        *[_or_zero(F.col(d)).alias(d) for d in days],
    )


def clean_dataset(dataset: DataFrame) -> DataFrame:
    """Cohort month as a timestamp, billing totals -> averages, cross-sell counts -> rates.

    Billing totals cover all gross adds of a cohort and are divided by the matured ones, as reported.
    """
    averages = {
        c.avg_billings_column(n): ratio(F.col(c.billings_column(n)), F.col(c.matured_column(n)))
        for n in c.BILLING_DAYS
    }
    rates = {
        c.cross_sell_rate_column(n): ratio(F.col(c.cross_sell_column(n)), F.col(c.matured_column(n)))
        for n in c.EARLY_DAYS
        if {c.cross_sell_column(n), c.matured_column(n)} <= set(dataset.columns)
    }
    month = {c.COHORT_MONTH: F.col(c.COHORT_MONTH).cast("timestamp_ntz")}
    return dataset.withColumns({**month, **averages, **rates}).drop(
        *[c.billings_column(n) for n in c.BILLING_DAYS]
    )
