import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import sample_sources as src
from vintner.config import FORECAST_TARGETS, LTV_LEVELS
from vintner.operators import forecasting as f
from vintner.plans import ltv_forecast as plan

START = dt.date(2020, 1, 1)


def series(spark, fn, n, key="a"):
    rows = [(key, START + dt.timedelta(days=i), float(fn(i))) for i in range(n)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_linear_trend_is_exact(spark):
    out = f.linear_trend(series(spark, lambda i: 3 + 2 * i, 20), ["k"]).first()
    assert out["slope"] == pytest.approx(2.0)
    day = (START - dt.date(1970, 1, 1)).days
    assert out["intercept"] == pytest.approx(3 - 2 * day)


@pytest.mark.parametrize("multiplicative", [False, True])
def test_additive_model_follows_trend_and_year(multiplicative):
    days = np.arange(3 * 365, dtype=float) + 18262
    season = 1 + 0.2 * np.sin(2 * np.pi * days / f.YEAR)
    y = (100 + 0.1 * (days - days[0])) * season
    model = f.SeriesModel(multiplicative=multiplicative)
    train = days < days[0] + 900
    none = np.empty((len(days), 0))
    yhat, lower, upper = f.fit_predict(days[train], y[train], none[train], days, none, model)
    assert np.all(lower <= yhat) and np.all(yhat <= upper)
    assert np.mean(np.abs(yhat[train] / y[train] - 1)) < 0.03
    assert np.mean(np.abs(yhat[~train] / y[~train] - 1)) < 0.25


def test_logistic_growth_stays_below_the_cap_and_regressors_help():
    days = np.arange(200, dtype=float)
    x = np.sin(days)[:, None]
    y = 5 + x[:, 0]
    model = f.SeriesModel(multiplicative=False, logistic=True, yearly_order=0)
    yhat, _, upper = f.fit_predict(days[:150], y[:150], x[:150], days, x, model)
    assert np.all(yhat > 0) and np.all(upper <= y[:150].max() * 1.2 + 1e-9)
    without, *_ = f.fit_predict(days[:150], y[:150], np.empty((150, 0)), days, np.empty((200, 0)), model)
    assert np.abs(yhat - y)[150:].mean() < np.abs(without - y)[150:].mean()


def test_group_forecast_spans_history_and_horizon(spark):
    df = series(spark, lambda i: 10 + i, 60).union(series(spark, lambda i: 5, 1, key="short"))
    out = f.group_forecast(df, ["k"], horizon=5)
    good = out.filter("k = 'a'").orderBy("ds").collect()
    assert len(good) == 65 and good[-1]["ds"] == START + dt.timedelta(days=64)
    assert good[-1]["yhat"] == pytest.approx(74, rel=0.1)
    (bad,) = out.filter("k = 'short'").collect()
    assert "two days" in bad["error"] and bad["yhat"] is None or np.isnan(bad["yhat"])


def cohorts(spark, days, size=10, brand="b", sku="s"):
    rows = [
        ("acquisition_sku_bucket", START + dt.timedelta(days=i), brand, sku, None, None, None, size, 0.1, 1.0, 2.0, 3.0, 4.0, 5.0)
        for i in range(days)
    ]
    dims = ", ".join(f"{n} string" for n in LTV_LEVELS)
    return spark.createDataFrame(
        rows,
        f"level string, acquisition_date date, {dims}, cohort_size bigint, canceled_day_1 double, "
        "ltv_1mo double, ltv_3mo double, ltv_6mo double, ltv_12mo double, ltv_24mo double",
    )


def test_cascade_per_group_with_gate_and_errors(spark):
    data = (
        cohorts(spark, 500)
        .union(cohorts(spark, 100, brand="young"))  # no history before the longest blackout
        .union(cohorts(spark, 5, brand="tiny"))
        .union(cohorts(spark, 500, brand="null", sku=None))
    )
    out = f.forecast_groups(data, LTV_LEVELS)
    by = {json.loads(r["filters"])["brand"]: r for r in out.groupBy("filters").agg(
        F.count("*").alias("n"), F.max("error").alias("error"), F.max("ltv_12mo_predicted").alias("p"),
        F.max("ltv_1mo_predicted").alias("p1"),
    ).collect()}
    assert set(by) == {"b", "young"}  # tiny is gated, a missing dimension is left out
    assert by["b"]["n"] == 500 and by["b"]["error"] is None
    assert by["b"]["p"] == pytest.approx(4.0, rel=0.05)
    assert by["young"]["error"].startswith("ltv_3mo") and by["young"]["p1"] == pytest.approx(1.0, rel=0.05)
    stored = plan.stored_result(out)
    assert stored.count() == 600
    assert stored.filter("error IS NOT NULL").select("filters").distinct().count() == 1
    assert stored.columns == [
        "acquisition_date", "cohort_size", "canceled_day_1", "ltv_1mo", "ltv_3mo", "ltv_6mo", "ltv_12mo", "ltv_24mo",
        "ltv_1mo_predicted", "ltv_3mo_predicted", "ltv_6mo_predicted", "ltv_12mo_predicted", "filters", "level", "error",
    ]
    row = stored.filter("error IS NULL").orderBy("acquisition_date").first()
    assert row["acquisition_date"] == "2020-01-01T00:00:00Z"
    assert json.loads(row["filters"]) == {"brand": "b", "acquisition_sku_bucket": "s"}


def test_job_overwrites_its_table(spark, folder):
    from vintner.sources.sinks import make_sink

    billings = src.customer_billings(spark, "/root/testdata/sf0.001")
    sink = make_sink("parquet", folder)
    for _ in range(2):
        plan.ltv_forecast(billings, min_size=5, sink=sink)
    stored = spark.read.parquet(sink.path("LTV_RESULTS"))
    assert stored.groupBy("filters", "level", "acquisition_date").count().filter("count > 1").isEmpty()


def test_forecast_days_bounds_and_actuals_per_target(spark):
    data = f.forecast_input(cohorts(spark, 500).union(cohorts(spark, 100, brand="young")), LTV_LEVELS)
    out = f.target_forecasts(data, f.FORECAST_KEYS, horizon=30).withColumn("brand", F.get_json_object("filters", "$.brand"))
    by = {(r["brand"], r["target"]): r for r in out.groupBy("brand", "target").agg(
        F.count("ds").alias("days"), F.count("actuals").alias("known"), F.max("error").alias("error"),
        F.count_if(F.expr("yhat_lower > yhat OR yhat > yhat_upper")).alias("wrong"),
    ).collect()}
    assert {t for b, t in by if b == "b"} == set(FORECAST_TARGETS)
    assert by["b", "canceled_day_1"]["days"] == 530 and by["b", "ltv_1mo"]["days"] == 500
    assert by["b", "canceled_day_1"]["known"] == 500 - 75 and all(r["wrong"] == 0 for r in by.values())
    assert [t for b, t in by if b == "young" and by[b, t]["error"]] == ["ltv_3mo"]
    assert ("young", "ltv_6mo") not in by


def descended(design, y, squared, absolute, rounds=20000):
    """The same minimum one coordinate at a time."""
    gram, moment = design.T @ design, design.T @ y
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        before = w.copy()
        for j in range(len(w)):
            rest = moment[j] - gram[j] @ w + gram[j, j] * w[j]
            w[j] = np.sign(rest) * max(abs(rest) - absolute[j], 0) / (gram[j, j] + squared[j])
        if np.abs(w - before).max() <= 1e-13 * np.abs(w).max():
            break
    return w


@pytest.mark.parametrize("price", [0.01, 0.3, 3.0, 1e4])
def test_sparse_fit_finds_the_least_objective(price):
    rng = np.random.default_rng(3)
    for _ in range(5):
        design = np.column_stack([np.ones(80), rng.normal(size=(80, 9))])
        y = design @ np.where(rng.random(10) < 0.4, rng.normal(size=10) * 3, 0) + rng.normal(size=80)
        squared, absolute = np.full(10, 1e-6), np.r_[0, 0, np.full(8, price)]
        best = f.objective(design, y, descended(design, y, squared, absolute), squared, absolute)
        found = f.sparse_fit(design, y, squared, absolute)
        assert f.objective(design, y, found, squared, absolute) <= best * (1 + 1e-6)
        assert price < 1e4 or not found[2:].any()


def test_a_planted_break_of_the_trend_is_found():
    days = np.arange(300, dtype=float)
    t = days / days[-1]
    knots = np.linspace(0, 0.8, 26)[1:]
    y = 5 + 2 * t + 9 * np.maximum(t - knots[11], 0) + np.random.default_rng(4).normal(0, 0.05, 300)
    design = np.column_stack([np.ones(300), t, np.maximum(t[:, None] - knots, 0)])
    noise = y.std() ** 2 * 0.01
    w = f.sparse_fit(design, y, np.full(27, 1e-12), np.r_[0, 0, np.full(25, noise / 0.5)])[2:]
    assert np.count_nonzero(np.abs(w) > 0.5) <= 3 and abs(np.abs(w).argmax() - 11) <= 1
    assert w.sum() == pytest.approx(9, rel=0.1)


@pytest.mark.parametrize("quiet, least", [(True, 0.5), (False, 0.2)])
def test_bounds_widen_with_distance_and_hold_more_days(quiet, least):
    """Held-out days of trends that change at random; ``quiet`` ones do not in the last fifth, where no change is sought."""
    rng, none = np.random.default_rng(6), np.empty((0, 0))
    model, days = f.SeriesModel(yearly_order=0, multiplicative=False, sparse=True), np.arange(600, dtype=float)
    inside = {0: [], f.PATHS: []}
    for _ in range(40):
        changes = (rng.random(600) < 0.03) & ((days < 360) | (days >= 450) | (not quiet))
        y = 100 + np.cumsum(np.cumsum(np.where(changes, rng.laplace(0, 0.3, 600), 0))) + rng.normal(0, 2, 600)
        lines = {n: f.fit_predict(days[:450], y[:450], none.reshape(450, 0), days, none.reshape(600, 0), model, n) for n in inside}
        width = lines[f.PATHS][2] - lines[f.PATHS][0]
        assert np.allclose(width[:450], width[0]) and np.all(np.diff(width) >= -1e-9) and width[-1] > width[0]
        assert np.array_equal(lines[0][0], lines[f.PATHS][0])
        for paths, held in inside.items():
            held.append(np.mean((lines[paths][1] <= y)[450:] & (y <= lines[paths][2])[450:]))
    assert np.mean(inside[f.PATHS]) > max(2 * np.mean(inside[0]), least), {k: np.mean(v) for k, v in inside.items()}


def test_bounds_are_the_same_every_time():
    a, b = (f.spread_ahead(np.linspace(0, 2, 50), np.array([0.5, 0, -0.2]), 0.1) for _ in range(2))
    assert np.array_equal(a, b) and (a[:25] == a[0]).all() and a[-1] > a[0]
    assert (f.spread_ahead(np.linspace(0, 2, 50), np.zeros(3), 0.1) == a[0]).all()


@pytest.mark.parametrize("multiplicative", [False, True])
def test_the_unit_of_a_series_does_not_change_its_trend(multiplicative):
    days = np.arange(400, dtype=float)
    y = 50 + 0.1 * days + np.maximum(days - 200, 0) + np.random.default_rng(8).normal(0, 3, 400)
    model, none = f.SeriesModel(yearly_order=0, multiplicative=multiplicative, sparse=True), np.empty((400, 0))
    one, hundred = (f.fit_predict(days, y * c, none, days + 100, none, model) for c in (1, 100))
    for a, b in zip(one, hundred):
        assert np.allclose(a * 100, b, rtol=1e-4)
