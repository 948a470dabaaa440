"""Trend, yearly seasonality and regressors in one model over all rows of a frame.

The per-group forecast fits short series inside a task. This one is for a single model over any number
of rows, such as all cohorts of a dataset with their preprocessed features: trend and Fourier terms are
column expressions, and each ridge fit is one distributed pass that sums a matrix as wide as the terms.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner.config import Z_80
from vintner.operators.forecasting import MULTIPLICATIVE_ROUNDS, WEEK, YEAR, SeriesModel


def _day(ds: str) -> Column:
    return F.unix_date(F.to_date(F.col(ds))).cast("double")


def _dot(values: Column, weights: list[float]) -> Column:
    products = F.zip_with(values, F.lit(weights), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _ridge(
    rows: DataFrame, label: Column, terms: Column, penalty: list[float], n: int, intercept: bool = False
) -> list[float]:
    """Weights that minimise squared error plus penalty x weight squared, one penalty per term.

    With ``intercept`` its value comes first; the solver ignores a constant term.

    Up to a few thousand terms the normal equations are solved, beyond that the solver iterates; both sum
    over the rows in one pass each. The solver has a single penalty, so every term is divided by the root of its own. It also divides
    the penalty by the spread of the label, which is undone here.
    """
    roots = [math.sqrt(p) for p in penalty]
    scaled = F.zip_with(terms, F.lit(roots), lambda x, r: x / r)
    frame = rows.select(label.alias("label"), array_to_vector(scaled).alias("features"))
    spread, mean = frame.agg(F.stddev_pop("label"), F.avg("label")).first()
    solver = LinearRegression(
        regParam=(spread or abs(mean)) / n, fitIntercept=intercept, standardization=False, solver="auto", maxIter=1000, tol=1e-10
    )
    fitted = solver.fit(frame)
    weights = [float(w) / r for w, r in zip(fitted.coefficients, roots)]
    return [fitted.intercept, *weights] if intercept else weights


@dataclass
class SeasonalRegression:
    """A fitted model; ``predict`` adds yhat and its bounds to any frame with ds and the regressors."""

    model: SeriesModel
    regressors: list[str]
    start: float
    span: float
    knots: list[float]
    trend_weights: list[float]
    season_weights: list[float]
    spread: float = 0.0

    def trend_terms(self) -> Column:
        t = (_day("ds") - self.start) / self.span
        return F.array(F.lit(1.0), t, *[F.greatest(t - k, F.lit(0.0)) for k in self.knots])

    def season_terms(self) -> Column:
        waves = []
        for period, order in ((YEAR, self.model.yearly_order or 0), (WEEK, self.model.weekly_order or 0)):
            for k in range(1, order + 1):
                angle = _day("ds") * (2 * math.pi * k / period)
                waves += [F.sin(angle), F.cos(angle)]
        return F.array(*waves, *[F.col(r).cast("double") for r in self.regressors])

    def value(self, trend: Column, season: Column) -> Column:
        level, swing = _dot(trend, self.trend_weights), _dot(season, self.season_weights)
        return level * (1 + swing) if self.model.multiplicative else level + swing

    def predict(self, df: DataFrame, z: float = Z_80) -> DataFrame:
        out = df.withColumn("yhat", self.value(self.trend_terms(), self.season_terms()))
        return out.withColumns(
            {"yhat_lower": F.col("yhat") - z * self.spread, "yhat_upper": F.col("yhat") + z * self.spread}
        )


def fit_seasonal(df: DataFrame, regressors: list[str], model: SeriesModel = SeriesModel()) -> SeasonalRegression:
    """Fit on the rows of (ds, y, regressors) that have a target."""
    if model.logistic or model.sparse:
        raise ValueError("logistic growth and sparse changes of the trend are for per-group models")
    known = df.filter(F.col("y").isNotNull() & F.col("ds").isNotNull())
    y = F.col("y").cast("double")
    n, first, last, deviation, size = known.agg(
        F.count("*"), F.min(_day("ds")), F.max(_day("ds")), F.stddev_pop(y), F.avg(F.abs(y))
    ).first()
    if n < 2 or first == last:
        raise ValueError("a series needs two days of history")
    knots = [model.changepoint_share * (i + 1) / model.changepoints for i in range(model.changepoints)]
    fitted = SeasonalRegression(model, list(regressors), first, last - first, knots, [], [])
    rows = known.select(
        y.alias("y"), fitted.trend_terms().alias("trend"), fitted.season_terms().alias("season")
    ).persist()
    try:
        trend, season = F.col("trend"), F.col("season")
        n_season = len(rows.select(season).first()[0])
        noise = max(deviation, 0.01 * size, 1e-6) ** 2 * 0.01
        trend_penalty = [1e-8, 1e-8] + [noise / model.changepoint_scale**2] * len(knots)
        season_penalty = [noise / 10.0**2 + 1e-8] * n_season
        moving = F.concat(F.slice(trend, 2, len(trend_penalty) - 1), season)
        both = _ridge(rows, F.col("y"), moving, trend_penalty[1:] + season_penalty, n, intercept=True)
        fitted.trend_weights, fitted.season_weights = both[: len(trend_penalty)], both[len(trend_penalty) :]
        if model.multiplicative and n_season:
            # y = trend x (1 + season): each factor in turn, given the other
            for _ in range(MULTIPLICATIVE_ROUNDS):
                level = _dot(trend, fitted.trend_weights)
                terms = F.transform(season, lambda x: x * level)
                fitted.season_weights = _ridge(rows, F.col("y") - level, terms, season_penalty, n)
                factor = 1 + _dot(season, fitted.season_weights)
                terms = F.transform(trend, lambda x: x * factor)
                fitted.trend_weights = _ridge(rows, F.col("y"), terms, trend_penalty, n)
        fitted.spread = rows.agg(F.stddev_pop(F.col("y") - fitted.value(trend, season))).first()[0]
        return fitted
    finally:
        rows.unpersist()
