import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks import sample_sources as src
from vintner import config as c
from vintner.config import STEPS, CascadeSettings, Level, TreeParams
from vintner.operators import cohort_masks as m
from vintner.plans import cascade as plan
from vintner.operators.dashboard import dashboard_rows
from vintner.sources.sinks import make_sink, read

SF = "/root/testdata/sf0.01"
LEVEL = Level("BRAND")
TREES = TreeParams(trees=2, depth=2, bins=16)
CHAIN = (STEPS[0], STEPS[2], STEPS[3], STEPS[8])
SETTINGS = CascadeSettings(min_cohort_size=src.MIN_COHORT_SIZE, trees=TREES, steps=CHAIN)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    data = q.clean(spark, SF).cache()
    run = plan.CascadeRun(LEVEL, data, make_sink("parquet", folder), SETTINGS)
    result = run.run().cache()
    return data, run, result, lambda name: read(spark, f"{folder}/{name}.parquet", merge_schema=True)


def test_every_partitioned_row_comes_out_once(stored):
    data, _, result, table = stored
    assert result.count() == data.filter(F.col(c.IS_PROMO).isNotNull()).count()
    assert result.groupBy(*LEVEL.keys).count().filter("count > 1").isEmpty()
    assert table("BRAND_RAW_RESULTS").count() == result.count()
    assert table("BRAND_SPINE_DATA").count() == data.count()


def test_statuses_partition_the_rows(stored):
    _, _, result, _ = stored
    for step in CHAIN:
        applicable = result if not step.promo_only else result.filter(c.IS_PROMO)
        values = {r[0] for r in applicable.select(step.status_column).distinct().collect()}
        assert values <= {c.TRAINED, c.PREDICTED, c.BYPASSED}
    assert result.filter(~F.col(c.IS_PROMO)).filter(F.col(STEPS[2].status_column).isNotNull()).isEmpty()


def test_predicted_rows_are_those_of_the_mask_and_others_stay(stored):
    data, _, result, table = stored
    step = STEPS[0]
    masked = data.withColumn("mask", m.prediction_mask(step, True, SETTINGS)).select(
        *LEVEL.keys, "mask", *[F.col(t).alias(f"old_{t}") for t in (*step.targets, *step.filled)]
    )
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in LEVEL.keys]
    both = result.alias("a").join(masked.alias("b"), same)
    assert both.filter(F.col("mask") != (F.col(step.status_column) == c.PREDICTED)).isEmpty()
    kept = both.filter(~F.col("mask"))
    for name in (*step.targets, *step.filled):
        changed = ~F.col(f"old_{name}").cast("double").eqNullSafe(F.col(f"a.{name}"))
        assert kept.filter(changed).isEmpty()
    predictions = table(f"BRAND_{plan.PREDICT_RESULTS}")
    n = predictions.filter(F.col("target_col") == step.targets[0]).count()
    assert n == both.filter("mask").count()


def test_filled_counts_are_rate_times_base(stored):
    _, _, result, _ = stored
    for step, is_promo in ((STEPS[0], True), (STEPS[2], True), (STEPS[3], True), (STEPS[3], False)):
        rows = result.filter(F.col(c.IS_PROMO) == is_promo).filter(F.col(step.status_column) == c.PREDICTED)
        base = F.col(step.base(is_promo))
        for target, count in zip(step.targets, step.filled):
            assert rows.filter(F.abs(F.col(count) - F.col(target) * base) > 1e-9).isEmpty()
        if step.is_retention:
            assert rows.filter(~F.col(step.maturity).eqNullSafe(base)).isEmpty()


def test_records(stored):
    _, run, _, table = stored
    steps = table(f"BRAND_{plan.PREDICT_METADATA}")
    assert steps.count() == len(CHAIN) * 2 - 1
    assert steps.select("id").distinct().count() == len(CHAIN) * 2 - 1
    one = steps.filter("step_name = 'DAY_3_METRICS' and partition_item.value").first()
    assert one["is_multi_target"] and one["target_cols"] == list(STEPS[0].targets)
    assert one["num_cols"] == c.regressors(STEPS[0], True) and one["cat_cols"] == LEVEL.categories
    split = table(f"BRAND_{plan.SPLIT_METADATA}")
    for r in split.collect():
        total = r["training_rows"] + r["test_rows"]
        assert r["test_rows"] == -(-total // 10)
        assert r["eval_result"]["rmse"] >= 0
    important = table(f"BRAND_{plan.IMPORTANCES}")
    assert important.filter("importance <= 0").isEmpty() and not important.isEmpty()
    run_row = table(plan.MODEL_METADATA).first()
    assert (run_row["id"], run_row["status"], run_row["level_group_bys"]) == (run.model_id, "COMPLETED", ["brand"])
    interval = table(f"BRAND_{plan.PREDICT_RESULTS}")
    assert interval.filter("yhat < yhat_lower or yhat > yhat_upper").isEmpty()


def test_nothing_to_learn_or_predict(spark):
    data = q.clean(spark, "/root/testdata/sf0.001")
    huge = CascadeSettings(min_cohort_size=10**9, trees=TREES, steps=(STEPS[0],), evaluate=True)
    out = plan.CascadeRun(LEVEL, data, settings=huge).cascade()
    assert {r[0] for r in out.select(STEPS[0].status_column).distinct().collect()} <= {c.BYPASSED}
    none = CascadeSettings(min_cohort_size=0, trees=TREES, steps=(STEPS[8],), evaluate=False)
    run = plan.CascadeRun(LEVEL, data, settings=none)
    statuses = {r[0] for r in run.cascade().select(STEPS[8].status_column).distinct().collect()}
    assert statuses <= {c.TRAINED, c.BYPASSED}
    assert f"BRAND_{plan.PREDICT_RESULTS}" not in run.outputs


def test_failure_is_recorded_and_raised(spark, folder):
    data = q.clean(spark, "/root/testdata/sf0.001").drop("avg_recurring_price")
    settings = CascadeSettings(min_cohort_size=2, trees=TREES, steps=(STEPS[0],), evaluate=False)
    with pytest.raises(Exception):
        plan.CascadeRun(LEVEL, data, make_sink("parquet", folder), settings).run()
    record = read(spark, f"{folder}/{plan.MODEL_METADATA}.parquet").first()
    assert record["status"] == "FAILED" and record["message"]
    assert read(spark, f"{folder}/BRAND_SPINE_DATA.parquet").count() == data.count()


def test_job_from_sources(spark, folder):
    settings = CascadeSettings(min_cohort_size=5, trees=TREES, steps=(STEPS[8],), evaluate=False)
    sources = src.cohort_sources(spark, "/root/testdata/sf0.001")
    out = plan.run_cascade(
        sources, src.AS_OF, src.START, make_sink("csv", folder), LEVEL, settings, cache_folder=f"{folder}/cache"
    )
    stored = spark.read.option("header", True).csv(f"{folder}/BRAND_{plan.RAW_RESULTS}.csv")
    assert stored.count() == out.count() > 0
    assert spark.read.parquet(f"{folder}/cache/BRAND-*.parquet").count() == out.count()


def test_dashboard_totals(stored):
    _, _, result, _ = stored
    out = dashboard_rows(result, LEVEL)
    assert out.columns[: 2 + len(LEVEL.keys)] == ["model_id", *LEVEL.keys, "is_predicted"]
    both = out.join(result.select(*LEVEL.keys, "avg_net_billings_365_days"), LEVEL.keys)
    wrong = F.abs(F.col("total_net_billings_365_days") - F.col("avg_net_billings_365_days") * F.col("gross_adds")) > 1e-6
    assert both.filter(wrong).isEmpty()
