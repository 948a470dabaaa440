"""Lifetime-value job: cohorts at every hierarchy prefix, forecast per group, one overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.config import FORECAST_TARGETS, LTV_LEVELS, LTV_MONTHS, MIN_GROUP_SIZE
from vintner.functions.dates import iso_text
from vintner.operators.forecasting import CASCADE_MODEL, SeriesModel, forecast_groups
from vintner.operators.ltv import ltv_cohorts


def ltv_forecast(
    billings: DataFrame,
    targets=FORECAST_TARGETS,
    min_size: int = MIN_GROUP_SIZE,
    sink=None,
    name: str = "LTV_RESULTS",
    model: SeriesModel = CASCADE_MODEL,
) -> DataFrame:
    forecast = forecast_groups(ltv_cohorts(billings), LTV_LEVELS, targets, min_size, model)
    if sink is not None:
        sink.write(name, stored_result(forecast), overwrite=True)
    return forecast


def stored_result(forecast: DataFrame) -> DataFrame:
    """Columns of the result table, the date as ISO-8601 text; rows of a group with an error carry its reason."""
    values = ["canceled_day_1", *[f"ltv_{m}mo" for m in LTV_MONTHS]]
    predicted = [f"ltv_{m}mo_predicted" for m in LTV_MONTHS if f"ltv_{m}mo_predicted" in forecast.columns]
    return forecast.select(
        iso_text(F.col("acquisition_date")).alias("acquisition_date"),
        "cohort_size",
        *values,
        *predicted,
        "filters",
        "level",
        "error",
    )
