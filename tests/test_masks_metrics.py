import math

import pytest
from pyspark.sql import functions as F

from vintner import config as c
from vintner.config import STEPS, CascadeSettings
from vintner.operators import cohort_masks as m
from vintner.operators import metrics

STEP = STEPS[4]  # average billings after 30 days
TARGET = STEP.targets[0]
SETTINGS = CascadeSettings()


def frame(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], f"id int, {STEP.maturity} double, gross_adds double, {TARGET} double"
    )
    return df.withColumns(
        {"trained": m.training_mask(STEP, SETTINGS), "predicted": m.prediction_mask(STEP, True, SETTINGS)}
    ).orderBy("id")


CASES = [
    # cohort, base, target -> status
    ((400.0, 500.0, 1.0), c.TRAINED),
    ((400.0, 500.0, None), c.BYPASSED),  # old enough, target unknown
    ((399.0, 1000.0, 1.0), c.PREDICTED),
    ((399.0, 500.0, 1.0), c.BYPASSED),  # small but mostly mature
    ((0.0, 0.0, None), c.BYPASSED),  # no share of an empty base
    ((None, 500.0, 1.0), c.PREDICTED),
    ((500.0, None, 1.0), c.PREDICTED),  # both masks hold; the prediction wins
    ((500.0, 100.0, 1.0), c.TRAINED),
]


def test_masks_and_statuses(spark):
    df = frame(spark, [case for case, _ in CASES])
    rows = df.withColumn("s", m.status(F.col("predicted"), F.col("trained"))).collect()
    assert [r["s"] for r in rows] == [s for _, s in CASES]
    assert all(r["trained"] is not None and r["predicted"] is not None for r in rows)
    assert rows[6]["trained"] and rows[6]["predicted"]
    assert df.filter(~F.col("predicted")).count() + df.filter("predicted").count() == len(CASES)


def test_null_targets_are_reported(spark):
    df = frame(spark, [case for case, _ in CASES]).withColumn("g", F.col("id") % 2)
    assert tuple(m.null_target_report(df, STEP, SETTINGS, ["g"]).first()) == (1, 1)
    assert tuple(m.null_target_report(df.limit(0), STEP, SETTINGS, ["g"]).first()) == (0, 0)


def test_fill_back_touches_predicted_rows_only(spark):
    step = STEPS[3]  # first rebill: based on survived promo activations
    columns = [step.targets[0], *step.filled, step.maturity, step.base(True)]
    assert step.base(True) == "survived_promo_activations_excl_retries" and step.base(False) == "gross_adds"
    df = spark.createDataFrame(
        [(1, True, 0.1, 5.0, 50.0, 200.0), (2, False, 0.1, 5.0, 50.0, 200.0), (3, True, 0.1, 5.0, 50.0, None)],
        "id int, p boolean, " + ", ".join(f"{n} double" for n in columns),
    )
    filled = m.fill_back(step, True, F.col("p"), {step.targets[0]: F.lit(0.5)})
    out = [tuple(r)[2:5] for r in df.withColumns(filled).orderBy("id").collect()]
    assert out == [(0.5, 100.0, 200.0), (0.1, 5.0, 50.0), (0.5, None, None)]


def test_steps_and_regressors():
    assert [s.name for s in STEPS][:4] == [
        "DAY_3_METRICS", "DAY_7_METRICS", "PROMO_ACTIVATION_RATE_EXCL_RETRIES", "FIRST_REBILL_RATE_EXCL_RETRIES",
    ]
    assert len(STEPS) == 12 and sum(s.applies_to(False) for s in STEPS) == 11
    assert c.regressors(STEPS[0], False) == list(c.BASE_REGRESSORS)
    assert len(c.regressors(STEPS[-1], True)) == 5 + 13 + 4
    assert STEPS[0].filled == ("gross_adds_canceled_day_three", "cross_sell_adds_three_days_since_gross_add")


def test_training_rule_ignores_unknown(spark):
    df = spark.createDataFrame([(250, 250), (249, 250), (None, 300)], "a int, b int")
    assert [r[0] for r in df.select(m.all_at_least([("a", 250), ("b", 250)])).collect()] == [True, False, False]


@pytest.mark.parametrize(
    ("pairs", "expected"),
    [
        ([(1.0, 2.0), (3.0, 3.0), (0.0, 1.0)], (math.sqrt(2 / 3), 2 / 3, 50.0, 1 - 2 / (14 / 3))),
        ([(0.0, 1.0), (0.0, 0.0)], (math.sqrt(0.5), 0.5, None, 0.0)),
        ([(2.0, 2.0)], (0.0, 0.0, 0.0, 1.0)),
    ],
)
def test_metrics(spark, pairs, expected):
    r = metrics.evaluate(spark.createDataFrame([*pairs, (None, 1.0)], "y double, p double"), "y", "p").first()
    assert r["rows"] == len(pairs)
    for got, want in zip(r[1:], expected):
        assert got == (want if want is None else pytest.approx(want))


def test_interval_and_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", 4.0)], "k string, v double")
    spread = df.agg(metrics.residual_spread(F.col("v"), F.lit(4.0))).first()[0]
    values = [-3.0, -2.0, 5.0, 0.0]
    assert spread == pytest.approx(math.sqrt(sum(x * x for x in values) / 4))
    lower, upper = metrics.interval(F.lit(10.0), F.lit(1.0))
    assert df.select(lower, upper).first() == pytest.approx((10 - 1.959963984540054, 10 + 1.959963984540054))
    rows = {r["k"]: (r["mean"], r["median"], r["min"], r["max"]) for r in metrics.prediction_summary(df, "k", "v").collect()}
    assert rows == {"a": (4.0, 2.0, 1.0, 9.0), "b": (4.0, 4.0, 4.0, 4.0)}
