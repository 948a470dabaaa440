import datetime as dt

import numpy as np
import pytest

from vintner.operators.forecasting import SeriesModel, fit_predict
from vintner.operators.seasonal import fit_seasonal

START = dt.date(2020, 1, 1)
DAYS = np.arange(900, dtype=float) + (START - dt.date(1970, 1, 1)).days
X = np.cos(DAYS / 3)
Y = (50 + 0.05 * (DAYS - DAYS[0])) * (1 + 0.1 * np.sin(2 * np.pi * DAYS / 365.25)) + 2 * X


def frame(spark, n=900):
    rows = [(START + dt.timedelta(days=i), float(Y[i]) if i < n else None, float(X[i])) for i in range(900)]
    return spark.createDataFrame(rows, "ds date, y double, x double").repartition(4)


@pytest.mark.parametrize("multiplicative", [False, True])
def test_agrees_with_the_per_group_fit(spark, multiplicative):
    model = SeriesModel(multiplicative=multiplicative, yearly_order=3)
    fitted = fit_seasonal(frame(spark, 800), ["x"], model)
    out = fitted.predict(frame(spark, 800)).orderBy("ds").select("yhat", "yhat_lower", "yhat_upper").toPandas()
    yhat, lower, upper = fit_predict(DAYS[:800], Y[:800], X[:800, None], DAYS, X[:, None], model)
    assert np.abs(out["yhat"][:800] / yhat[:800] - 1).max() < 0.01
    assert np.abs(out["yhat"][:800] / Y[:800] - 1).mean() < 0.01
    assert (out["yhat_lower"] <= out["yhat"]).all() and (out["yhat"] <= out["yhat_upper"]).all()
    assert np.abs(out["yhat"][800:] / Y[800:] - 1).mean() < 0.2


def test_without_regressors_and_seasons_it_is_the_trend(spark):
    model = SeriesModel(multiplicative=False, yearly_order=0, changepoints=0)
    line = frame(spark).selectExpr("ds", "2d * unix_date(ds) as y")
    out = fit_seasonal(line, [], model).predict(line)
    assert out.filter("abs(yhat / y - 1) > 1e-6").isEmpty()


def test_too_short(spark):
    with pytest.raises(ValueError, match="two days"):
        fit_seasonal(frame(spark).limit(1), ["x"])
