"""Model evaluation and prediction summaries as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner.config import Z_95
from vintner.operators.order_stats import medians_of


def metric_columns(actual: Column, predicted: Column) -> list[Column]:
    """RMSE, MAE, MAPE in percent over non-zero actuals, R2.

    R2 of a constant actual is 1 for a perfect prediction and 0 otherwise.
    """
    y, p = actual.cast("double"), predicted.cast("double")
    error = y - p
    sse = F.sum(error * error)
    sst = F.var_pop(y) * F.count(y)
    r2 = F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(sse, sst))
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.when(y != 0, F.abs(F.try_divide(error, y)))) * 100).alias("mape"),
        r2.alias("r2"),
    ]


def evaluate(df: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    both = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return both.groupBy(*by).agg(F.count("*").alias("rows"), *metric_columns(F.col(actual), F.col(predicted)))


def residual_spread(actual: Column, predicted: Column) -> Column:
    return F.stddev_pop(actual - predicted)


def interval(predicted: Column, spread: Column, z: float = Z_95) -> tuple[Column, Column]:
    return predicted - z * spread, predicted + z * spread


def prediction_summary(df: DataFrame, name: str, value: str) -> DataFrame:
    """Mean, exact median, minimum and maximum per name."""
    rows = df.select(F.col(name).alias("name"), F.col(value).cast("double").alias("value")).filter(
        F.col("value").isNotNull()
    )
    middles = medians_of(rows).withColumnRenamed("name", "_name")
    summary = rows.groupBy("name").agg(
        F.count("*").alias("rows"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    # A NULL name is a group like others.
    both = summary.join(middles, F.col("name").eqNullSafe(F.col("_name")), "left")
    return both.select(F.col("name").alias(name), "rows", "mean", "min", "max", "median")
