"""Which cohort rows train, which get a prediction, and how predictions fill the row back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner.config import BYPASSED, PREDICTED, TRAINED, CascadeSettings, Step
from vintner.functions.safe import certain, ratio


def old_enough(step: Step, settings: CascadeSettings) -> Column:
    return certain(F.col(step.maturity) >= settings.min_cohort_size)


def no_target_missing(step: Step) -> Column:
    condition = F.lit(True)
    for target in step.targets:
        condition = condition & F.col(target).isNotNull()
    return condition


def training_mask(step: Step, settings: CascadeSettings) -> Column:
    return old_enough(step, settings) & no_target_missing(step)


def null_target_mask(step: Step, settings: CascadeSettings) -> Column:
    """Rows that could train but for a missing target."""
    return old_enough(step, settings) & ~no_target_missing(step)


def prediction_mask(step: Step, is_promo: bool, settings: CascadeSettings) -> Column:
    """Too small and not yet mature, or cohort or base unknown. Never NULL, so ``~`` is its complement."""
    cohort, base = F.col(step.maturity), F.col(step.base(is_promo))
    immature = (cohort < settings.min_cohort_size) & (ratio(cohort, base) < settings.base_threshold)
    return certain(immature) | cohort.isNull() | base.isNull()


def all_at_least(minimums: Iterable[tuple[str, float]]) -> Column:
    """Rows whose columns all reach their minimum, for a hand-made training rule."""
    condition = F.lit(True)
    for name, minimum in minimums:
        condition = condition & certain(F.col(name) >= minimum)
    return condition


def status(predicted: Column, trained: Column) -> Column:
    """A row can satisfy both masks when its base is unknown; the prediction wins."""
    return F.when(predicted, PREDICTED).when(trained, TRAINED).otherwise(BYPASSED)


def fill_back(step: Step, is_promo: bool, predicted: Column, yhat: dict[str, Column]) -> dict[str, Column]:
    """New values of the predicted rows: target, count = rate x base, and for retention steps the
    eligible count, so that the rate can be recomputed in an aggregate."""
    base = F.col(step.base(is_promo))

    def on_predicted(value: Column, name: str) -> Column:
        return F.when(predicted, value).otherwise(F.col(name))

    filled = {t: on_predicted(yhat[t], t) for t in step.targets}
    for target, count in zip(step.targets, step.filled):
        filled[count] = on_predicted(yhat[target] * base, count)
    if step.is_retention:
        filled[step.maturity] = on_predicted(base, step.maturity)
    return filled


def null_target_report(df: DataFrame, step: Step, settings: CascadeSettings, keys: list[str]) -> DataFrame:
    """Number of quarantined rows and of the key tuples they belong to."""
    tuples = df.filter(null_target_mask(step, settings)).groupBy(*keys).agg(F.count("*").alias("_rows"))
    return tuples.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("null_rows"), F.count("*").alias("null_groups")
    )


def predictions_long(scored: DataFrame, step: Step, keys: list[str], base: str, yhat: dict[str, str]) -> DataFrame:
    """One row per key and target: target_col, yhat, its bounds and the prediction base."""
    entries = [
        F.struct(
            F.lit(t).alias("target_col"),
            F.col(yhat[t]).alias("yhat"),
            F.col(f"{yhat[t]}_lower").alias("yhat_lower"),
            F.col(f"{yhat[t]}_upper").alias("yhat_upper"),
        )
        for t in step.targets
    ]
    return scored.select(*keys, F.inline(F.array(*entries)), F.col(base).alias("prediction_base_col"))
