"""Lifetime value per acquisition cohort at every prefix of the customer hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner.config import FORECAST_DAYS, LTV_LEVELS, LTV_MONTHS, MIN_GROUP_SIZE
from vintner.functions.safe import ratio, same_keys
from vintner.functions.text import digits_in

# fixed values: amounts added and subtracted
_PLUS = ("initial_sub_amount", "cross_amount", "upsell_amount", "resub_amount", "downsell_amount")
_MINUS = ("refund_amount",)


def _net_amount() -> Column:
    def amount(name):
        return F.coalesce(F.col(name), F.lit(0)).cast("decimal(18,2)")

    total = sum((amount(n) for n in _PLUS[1:]), amount(_PLUS[0]))
    return (total - sum((amount(n) for n in _MINUS[1:]), amount(_MINUS[0]))).cast("decimal(18,2)")


def customer_totals(billings: DataFrame, months=LTV_MONTHS, levels=LTV_LEVELS) -> DataFrame:
    """One row per acquisition day, dimension tuple and customer: what all cohorts are made of."""
    age = F.col("month_age") * (F.col("recurring_period_days").cast("double") / 30)
    rows = billings.select(
        F.to_date("acquisition_date").alias("acquisition_date"),
        *levels,
        "customer_id",
        (F.col("canceled_day_1") == 1).alias("_canceled"),
        age.alias("_age"),
        _net_amount().alias("_net"),
    )
    return rows.groupBy("acquisition_date", *levels, "customer_id").agg(
        F.max(F.coalesce("_canceled", F.lit(False))).alias("_canceled"),
        *[F.sum(F.when(F.col("_age") < m, F.col("_net")).otherwise(0)).alias(f"_net_{m}") for m in months],
    )


def ltv_cohorts(billings: DataFrame, depths=None, months=LTV_MONTHS, levels=LTV_LEVELS) -> DataFrame:
    """Cohorts at the given prefix lengths of the hierarchy (default 2 to all), told apart by ``level``.

    Distinct customers do not add up across dimensions, so they are deduplicated per prefix. Rows are
    first reduced to one per customer and tuple, then placed by day and customer once; the fan-out to
    prefixes and the deduplication happen inside that placement without another shuffle.
    """
    depths = list(depths or range(2, len(levels) + 1))
    customers = customer_totals(billings, months, levels).repartition("acquisition_date", "customer_id")
    prefixes = customers.withColumn("_depth", F.explode(F.array(*[F.lit(d) for d in depths])))
    masked = prefixes.withColumns(
        {name: F.when(F.col("_depth") >= i, F.col(name)) for i, name in enumerate(levels, start=1)}
    )
    sums = [f"_net_{m}" for m in months]
    per_customer = masked.groupBy("_depth", "acquisition_date", *levels, "customer_id").agg(
        F.max("_canceled").alias("_canceled"), *[F.sum(s).alias(s) for s in sums]
    )
    known = F.col("customer_id").isNotNull()
    cohorts = per_customer.groupBy("_depth", "acquisition_date", *levels).agg(
        F.count("customer_id").alias("cohort_size"),
        F.count(F.when(known & F.col("_canceled"), 1)).alias("_canceled"),
        *[F.sum(s).alias(s) for s in sums],
    )
    level_name = F.element_at(F.array(*[F.lit(name) for name in levels]), F.col("_depth"))
    return cohorts.select(
        level_name.alias("level"),
        "acquisition_date",
        *levels[: max(depths)],
        "cohort_size",
        ratio(F.col("_canceled"), F.col("cohort_size")).alias("canceled_day_1"),
        *[ratio(F.col(f"_net_{m}"), F.col("cohort_size")).alias(f"ltv_{m}mo") for m in months],
    )


def ltv_report(billings: DataFrame, depth: int = len(LTV_LEVELS)) -> DataFrame:
    """Cohorts of one prefix by day, largest first."""
    return ltv_cohorts(billings, [depth]).orderBy("acquisition_date", F.desc("cohort_size"))


def large_groups(cohorts: DataFrame, keys: list[str], min_size: int = MIN_GROUP_SIZE) -> DataFrame:
    """Cohort rows of groups whose sizes add up to more than ``min_size``."""
    sizes = cohorts.groupBy(*keys).agg(F.sum("cohort_size").alias("_size")).filter(F.col("_size") > min_size)
    return cohorts.alias("a").join(sizes.alias("b"), same_keys("a", "b", keys), "left_semi")


def blackout_days(target: str) -> int:
    """Days at the end of a series whose value of the target is not complete yet."""
    return digits_in(target) * 30 + 45


def before_blackout(series: DataFrame, keys: list[str], target: str, date: str = "ds") -> DataFrame:
    """Rows old enough for the target, counted back from the last day of their group.

    The last day is an aggregate joined back, not a window: a window would bring a whole group into
    one task.
    """
    last = series.groupBy(*keys).agg(F.max(date).alias("_last"))
    same_group = same_keys("a", "b", keys)
    old_enough = F.col(f"a.{date}") <= F.date_sub("b._last", blackout_days(target))
    return series.alias("a").join(last.alias("b"), same_group & old_enough, "left_semi")


# --- series and their calendars ------------------------------------------------------------------


def future_calendar(series: DataFrame, keys: list[str], date: str = "ds", days: int = FORECAST_DAYS) -> DataFrame:
    """Every day from the first date of a series to ``days`` after its last one."""
    return (
        series.groupBy(*keys)
        .agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
        .select(*keys, F.explode(F.sequence("_first", F.date_add("_last", days))).alias(date))
    )


def with_earlier_predictions(calendar: DataFrame, predictions: DataFrame, keys: list[str], date: str = "ds") -> DataFrame:
    """Calendar days for which the earlier target has a prediction."""
    return calendar.join(predictions, [*keys, date], "inner")


def with_actuals(forecast: DataFrame, actuals: DataFrame, keys: list[str], date: str = "ds") -> DataFrame:
    """Forecast and actual values side by side; either may be missing on a day."""
    return forecast.join(actuals, [*keys, date], "full_outer")


def onto_history(history: DataFrame, forecast: DataFrame, keys: list[str], date: str = "ds") -> DataFrame:
    """All days of the history, with the forecast where there is one."""
    return history.join(forecast, [*keys, date], "left")
