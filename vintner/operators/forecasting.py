"""Forecasts of one short series per group.

A series has one row per day, so a group is bounded by the calendar however many raw rows were behind
it; each group is one ``applyInPandas`` call and the groups are spread by Spark. The model is the
published additive one: piecewise-linear trend, Fourier seasonality and regressors. Changes of the trend
have an absolute penalty, so that few are made, if the model is sparse; all else is held back by a squared one. Beyond the last
day trained on, the bounds take in that the trend may change again as often and as much as it did.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.config import FORECAST_DAYS, FORECAST_TARGETS, MIN_GROUP_SIZE, Z_80
from vintner.operators.ltv import blackout_days, large_groups

YEAR, WEEK = 365.25, 7.0
MULTIPLICATIVE_ROUNDS = 5
SPARSE_ROUNDS = 60
#: Simulated paths of the trend behind the bounds, and where their numbers begin.
PATHS, SEED = 400, 11


@dataclass(frozen=True)
class SeriesModel:
    changepoints: int = 25
    changepoint_share: float = 0.8  # part of the history that may hold changepoints
    changepoint_scale: float = 0.5
    sparse: bool = False  # an absolute penalty on changes of the trend, so that few are made, instead of a squared one
    yearly_order: int | None = 10  # None: 10 when the history spans two years, else 0
    weekly_order: int | None = 0  # None: 3 when the history spans two weeks, else 0
    season_scale: float = 10.0  # usual size of the effects of seasons and regressors; infinite: not held back
    multiplicative: bool = True
    logistic: bool = False
    cap_factor: float = 1.2


# the growth and flexibility of the cascaded cohort forecast
CASCADE_MODEL = SeriesModel(
    changepoint_scale=0.82, sparse=True, yearly_order=None, weekly_order=None, multiplicative=False, logistic=True
)
GROUP_MODEL = SeriesModel(sparse=True)


def _ridge(design: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(design.T @ design + np.diag(penalty), design.T @ y)


def objective(design, y, weights, squared, absolute) -> float:
    """Half the squared error with the penalties of the weights."""
    return 0.5 * np.sum((y - design @ weights) ** 2) + 0.5 * squared @ weights**2 + absolute @ np.abs(weights)


def sparse_fit(design: np.ndarray, y: np.ndarray, squared: np.ndarray, absolute: np.ndarray) -> np.ndarray:
    """Weights with the least ``objective``: ridge where ``absolute`` is zero, lasso elsewhere.

    |w| is at most w^2 / 2|v| + |v| / 2 for any v and equal at w = v, so each round minimises a squared penalty at
    the last weights, on the Gram matrix alone; weights that are not worth their penalty go to zero. Then the signs
    are known, and one solution of linear equations is exact.
    """
    gram, moment = design.T @ design + np.diag(squared), design.T @ y
    lasso = absolute > 0
    weights = np.linalg.solve(gram + np.diag(absolute), moment)
    for _ in range(SPARSE_ROUNDS if lasso.any() else 0):
        root = np.where(lasso, np.sqrt(np.abs(weights)), 1.0)
        last, weights = weights, root * np.linalg.solve(root[:, None] * gram * root + np.diag(absolute), root * moment)
        if np.abs(weights - last).max() <= 1e-9 * np.abs(weights).max():
            break
    used = ~lasso | (np.abs(weights) > 1e-4 * np.abs(weights).max())
    exact = np.zeros_like(weights)
    pull = (absolute * np.sign(weights))[used]
    exact[used] = np.linalg.solve(gram[np.ix_(used, used)], moment[used] - pull)
    choices = (exact, weights) if lasso.any() else (exact,)
    return min(choices, key=lambda w: objective(design, y, w, squared, absolute))


def spread_ahead(ahead: np.ndarray, changes: np.ndarray, noise: float, paths: int = PATHS, factor=None) -> np.ndarray:
    """Half the width of the 80% interval at times ``ahead`` (history ends at 1): future changes of the trend and noise.

    Along each of the seeded paths the slope changes as often as in the history, at any time, by amounts of the
    average size of ``changes`` (Laplace). The interval holds 80% of the paths and never narrows with distance,
    but where the trend's part is multiplied by a ``factor`` per time. Without changes it is that of the noise.
    """
    width = np.full(len(ahead), Z_80 * noise)
    size = np.abs(changes).mean() if len(changes) else 0.0
    late = np.flatnonzero(ahead > 1)
    if size <= 0 or not len(late) or not paths:
        return width
    order = late[np.argsort(ahead[late], kind="stable")]
    at, rng = ahead[order], np.random.default_rng(SEED)
    number = rng.poisson(len(changes) * (at[-1] - 1), paths)
    path = np.repeat(np.arange(paths), number)
    when = 1 + (at[-1] - 1) * rng.random(len(path))
    step = rng.laplace(0, size, len(path))
    # A change counts from the first of the times after it on: sums of changes, and of changes times their time.
    cell = path * len(at) + np.searchsorted(at, when)
    slopes, offsets = (
        np.bincount(cell, w, paths * len(at)).reshape(paths, len(at)).cumsum(axis=1) for w in (step, step * when)
    )
    drawn = noise * rng.permutation(_normal_quantiles(paths))
    off = np.abs((slopes * at - offsets) * (1.0 if factor is None else factor[order]) + drawn[:, None])
    width[order] = np.maximum(np.quantile(off, 0.8, axis=0), Z_80 * noise)
    if factor is None:
        width[order] = np.maximum.accumulate(width[order])
    return width


@lru_cache
def _normal_quantiles(n: int) -> np.ndarray:
    return np.array([NormalDist().inv_cdf((k + 0.5) / n) for k in range(n)])


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angles = 2 * np.pi * np.outer(days, np.arange(1, order + 1)) / period
    return np.hstack([np.sin(angles), np.cos(angles)])


def fit_predict(days, y, x, future_days, future_x, model: SeriesModel, paths: int = PATHS):
    """Fit on (days, y, regressors x) and return prediction, lower and upper for the future days.

    ``paths`` is the number of simulated trends; with 0 the bounds are those of the noise alone.
    """
    days, y = np.asarray(days, float), np.asarray(y, float)
    future_days = np.asarray(future_days, float)
    if len(y) < 2 or np.ptp(days) == 0:
        raise ValueError("a series needs two days of history")
    start, span = days.min(), np.ptp(days)
    cap = max(y.max() * model.cap_factor, 1e-9)
    z = y
    if model.logistic:
        share = np.clip(y / cap, 0.005, 0.995)
        z = np.log(share / (1 - share))
    yearly = model.yearly_order if model.yearly_order is not None else 10 * (span >= 2 * YEAR)
    weekly = model.weekly_order if model.weekly_order is not None else 3 * (span >= 2 * WEEK)
    n_knots = min(model.changepoints, max(len(np.unique(days)) - 2, 0))
    knots = np.linspace(0, model.changepoint_share, n_knots + 1)[1:]
    x = np.asarray(x, float).reshape(len(days), -1)
    future_x = np.asarray(future_x, float).reshape(len(future_days), -1)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    # a regressor that never moved in training says nothing about the days ahead
    scale = np.where(scale <= 1e-9 * (1 + np.abs(centre)), np.inf, scale)

    def parts(at, regressors):
        t = (at - start) / span
        trend = np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - knots, 0)])
        season = np.hstack([_fourier(at, YEAR, yearly), _fourier(at, WEEK, weekly), (regressors - centre) / scale])
        return trend, season

    noise = max(z.std(), 0.01 * np.abs(z).mean(), 1e-6) ** 2 * 0.01
    trend, season = parts(days, x)
    changes = 1e-12 if model.sparse else noise / model.changepoint_scale**2
    trend_squared = np.r_[1e-12, 1e-12, np.full(n_knots, changes)]
    # Changes are measured in the largest value, so that a series in cents gets the trend of the same one in euros.
    unit = 1.0 if model.logistic else max(np.abs(z).max(), 1e-9)
    trend_absolute = np.r_[0.0, 0.0, np.full(n_knots, model.sparse * noise / (model.changepoint_scale * unit))]
    season_penalty = np.full(season.shape[1], noise / model.season_scale**2 + 1e-8)
    both = sparse_fit(
        np.hstack([trend, season]), z, np.r_[trend_squared, season_penalty], np.r_[trend_absolute, np.zeros(season.shape[1])]
    )
    trend_fit, season_fit = both[: trend.shape[1]], both[trend.shape[1] :]
    if model.multiplicative:
        # y = trend x (1 + season): each factor in turn, given the other
        for _ in range(MULTIPLICATIVE_ROUNDS):
            level = trend @ trend_fit
            season_fit = _ridge(season * level[:, None], z - level, season_penalty)
            trend_fit = sparse_fit(trend * (1 + season @ season_fit)[:, None], z, trend_squared, trend_absolute)

    def raw(a, b):
        level, swing = a @ trend_fit, b @ season_fit
        return level * (1 + swing) if model.multiplicative else level + swing

    future = parts(future_days, future_x)
    factor = 1 + future[1] @ season_fit if model.multiplicative else None
    spread = spread_ahead((future_days - start) / span, trend_fit[2:], np.std(z - raw(trend, season)), paths, factor)
    centre_line = raw(*future)
    lines = centre_line, centre_line - spread, centre_line + spread
    return tuple(cap / (1 + np.exp(-np.clip(v, -50, 50))) for v in lines) if model.logistic else lines


def _day_numbers(dates: pd.Series) -> np.ndarray:
    return pd.to_datetime(dates).to_numpy().astype("datetime64[D]").astype(float)


def _spread_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Place groups over all shuffle partitions. Fitting is heavy on little data, and partitions sized
    by bytes would put thousands of groups into one task."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)


def _schema(df: DataFrame, keys: list[str], rest: str) -> str:
    types = dict(df.dtypes)
    return ", ".join([f"`{k}` {types[k]}" for k in keys] + [rest])


def group_forecast(
    series: DataFrame,
    keys: list[str],
    horizon: int = FORECAST_DAYS,
    step_days: int = 1,
    model: SeriesModel = GROUP_MODEL,
) -> DataFrame:
    """History and ``horizon`` further points per group: ds, yhat, yhat_lower, yhat_upper, error.

    ``series`` has the keys, ``ds`` and ``y``; several rows of a day count as their mean, so that a group
    is never longer than its calendar. A group that cannot be fitted yields one row with the reason.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["ds", "y"]).sort_values("ds") if len(pdf) else pdf
        try:
            days = _day_numbers(pdf["ds"])
            ahead = days.max() + step_days * np.arange(1, horizon + 1)
            at = np.concatenate([days, ahead])
            none = np.empty((len(days), 0)), np.empty((len(at), 0))
            yhat, lower, upper = fit_predict(days, pdf["y"], none[0], at, none[1], model)
            out = pd.DataFrame({"ds": at.astype("datetime64[D]"), "yhat": yhat, "yhat_lower": lower, "yhat_upper": upper})
            out["ds"] = pd.to_datetime(out["ds"]).dt.date
            return out.assign(error=None)
        except (ValueError, np.linalg.LinAlgError) as problem:
            return pd.DataFrame(
                {"ds": [None], "yhat": [np.nan], "yhat_lower": [np.nan], "yhat_upper": [np.nan], "error": [str(problem)]}
            )

    def keyed(key, pdf):
        out = run(pdf)
        for position, (name, value) in enumerate(zip(keys, key)):
            out.insert(position, name, value)
        return out

    schema = _schema(series, keys, "ds date, yhat double, yhat_lower double, yhat_upper double, error string")
    daily = series.groupBy(*keys, F.to_date("ds").alias("ds")).agg(F.avg(F.col("y").cast("double")).alias("y"))
    return _spread_groups(daily, keys).groupBy(*keys).applyInPandas(keyed, schema)


def _cascade(pdf: pd.DataFrame, targets: list[str], model: SeriesModel, date: str, horizon: int, paths: int = PATHS):
    """(target, forecast days, prediction with bounds, days trained on, reason of failure) one after another.

    ``pdf`` is one group in the order of its days. The first target is predicted ``horizon`` days ahead; a
    later one on the days for which all earlier ones have a value or a prediction, the history. The
    chain ends with the first target that cannot be fitted.
    """
    days = _day_numbers(pdf[date])
    actual = {t: pdf[t].astype(float) for t in targets}
    predicted: dict[str, np.ndarray] = {}
    for target in targets:
        trained = (days <= days.max() - blackout_days(target)) & actual[target].notna().to_numpy()
        if predicted:
            at = days
            x = np.column_stack([actual[e].fillna(0) for e in predicted])
            ahead = np.column_stack(list(predicted.values()))
        else:
            at = np.concatenate([days, days.max() + np.arange(1, horizon + 1)])
            x, ahead = np.empty((len(days), 0)), np.empty((len(at), 0))
        try:
            lines = fit_predict(days[trained], actual[target][trained], x[trained], at, ahead, model, paths)
        except (ValueError, np.linalg.LinAlgError) as problem:
            yield target, at[:0], (at[:0],) * 3, trained, str(problem)
            return
        predicted[target] = lines[0][: len(days)]
        yield target, at, lines, trained, None


def cascade_forecast(
    cohorts: DataFrame,
    keys: list[str],
    targets=FORECAST_TARGETS,
    model: SeriesModel = CASCADE_MODEL,
    date: str = "acquisition_date",
) -> DataFrame:
    """Predict the targets one after another per group, on every day of its history.

    Each model trains on the days before the target's blackout. Earlier targets are regressors: their
    actual values in training, their predictions on the days to forecast. A group keeps all its rows; if
    a target cannot be fitted, ``error`` says why and that target and the later ones have no prediction.
    """
    targets = list(targets)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date).reset_index(drop=True).assign(error=None)
        for t in targets:
            pdf[f"{t}_predicted"] = np.nan
        for target, _, (yhat, *_), _, problem in _cascade(pdf.copy(), targets, model, date, 0, paths=0):
            if problem is None:
                pdf[f"{target}_predicted"] = yhat
            else:
                pdf["error"] = f"{target}: {problem}"
        return pdf

    predicted = ", ".join(f"{t}_predicted double" for t in targets)
    schema = ", ".join(f"`{n}` {t}" for n, t in cohorts.dtypes) + f", error string, {predicted}"
    return _spread_groups(cohorts, keys).groupBy(*keys).applyInPandas(run, schema)


def target_forecasts(
    cohorts: DataFrame,
    keys: list[str],
    targets=FORECAST_TARGETS,
    model: SeriesModel = CASCADE_MODEL,
    date: str = "acquisition_date",
    horizon: int = FORECAST_DAYS,
) -> DataFrame:
    """Per group, target and day: yhat with its bounds, and the actual value where the model was trained on it.

    The first target reaches ``horizon`` days beyond the history. A target that cannot be fitted is one row
    with the reason in ``error``; the targets after it have no rows.
    """
    targets = list(targets)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date).reset_index(drop=True)
        days, parts = _day_numbers(pdf[date]), []
        for target, at, lines, trained, problem in _cascade(pdf, targets, model, date, horizon):
            if problem is not None:
                parts.append(pd.DataFrame({"target": [target], "error": [problem]}))
                continue
            known = pd.Series(np.where(trained, pdf[target].astype(float), np.nan), index=days)
            part = pd.DataFrame(dict(zip(("yhat", "yhat_lower", "yhat_upper"), lines)))
            part["ds"] = pd.to_datetime(at.astype("datetime64[D]")).date
            part["actuals"] = known.reindex(at).to_numpy()
            parts.append(part.assign(target=target, error=None))
        out = pd.concat(parts, ignore_index=True).reindex(columns=["target", "ds", "yhat", "yhat_lower", "yhat_upper", "actuals", "error"])
        for position, (name, value) in enumerate(zip(keys, key)):
            out.insert(position, name, value)
        return out

    rest = "target string, ds date, yhat double, yhat_lower double, yhat_upper double, actuals double, error string"
    return _spread_groups(cohorts, keys).groupBy(*keys).applyInPandas(run, _schema(cohorts, keys, rest))


def forecast_groups(
    cohorts: DataFrame, levels, targets=FORECAST_TARGETS, min_size: int = MIN_GROUP_SIZE, model: SeriesModel = CASCADE_MODEL
) -> DataFrame:
    """Cascaded forecast for every group of every prefix, tagged with its filters as JSON.

    ``cohorts`` comes from ``ltv_cohorts``. Groups with a missing dimension and groups of at most
    ``min_size`` customers are left out.
    """
    return cascade_forecast(forecast_input(cohorts, levels, min_size), FORECAST_KEYS, targets, model)


FORECAST_KEYS = ["level", "filters"]


def forecast_input(cohorts: DataFrame, levels, min_size: int = MIN_GROUP_SIZE) -> DataFrame:
    """Cohort rows of the groups to forecast, keyed by level and filters."""
    levels = list(levels)
    depth = F.array_position(F.array(*[F.lit(n) for n in levels]), F.col("level"))
    complete = F.lit(True)
    for i, name in enumerate(levels, start=1):
        complete = complete & ((depth < i) | F.col(name).isNotNull())
    tagged = cohorts.filter(complete).withColumn("filters", F.to_json(F.struct(*levels)))
    return large_groups(tagged.drop(*levels), FORECAST_KEYS, min_size)


def linear_trend(series: DataFrame, keys: list[str], ds: str = "ds", y: str = "y") -> DataFrame:
    """Slope per day and intercept at 1970-01-01 of every group, as a plain aggregate."""
    day = F.unix_date(F.to_date(ds)).cast("double")
    return series.groupBy(*keys).agg(
        F.regr_slope(F.col(y).cast("double"), day).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), day).alias("intercept"),
    )


def linear_prediction(calendar: DataFrame, trend: DataFrame, keys: list[str], ds: str = "ds") -> DataFrame:
    """``yhat`` of the linear trend on every calendar day."""
    day = F.unix_date(F.to_date(ds)).cast("double")
    return calendar.join(trend, keys).withColumn("yhat", F.col("intercept") + F.col("slope") * day).drop("slope", "intercept")
