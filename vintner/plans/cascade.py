"""Cohort value cascade: each step predicts what young cohorts cannot show yet and feeds the next.

Promo and non-promo rows are two independent chains; they run side by side, and so do the two targets
of a step. Each step ends in a checkpoint in the shared folder, so plans stay short and a lost executor
costs one step.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintner import config as c
from vintner.config import CascadeSettings, Level, Step
from vintner.functions.safe import nan_to_null
from vintner.functions.text import record_id
from vintner.operators import cohort_masks as masks
from vintner.operators import trees
from vintner.operators.metrics import evaluate
from vintner.operators.order_stats import holdout, key_hash
from vintner.operators.preprocess import Categories, Inputs
from vintner.plans.cohort_dataset import CohortSources, load_clean_dataset
from vintner.sources.sinks import append_all
from vintner.sources.storage import cut

log = logging.getLogger(__name__)

# fixed values: result tables, prefixed by the level except the run record
SPINE_DATA = "SPINE_DATA"
RAW_RESULTS = "RAW_RESULTS"
NULL_VALUES = "NULL_VALUES"
MODEL_METADATA = "MODEL_METADATA"
SPLIT_METADATA = "TEST_TRAIN_SPLIT_METADATA"
IMPORTANCES = "TEST_TRAIN_SPLIT_FEATURE_IMPORTANCES"
PREDICT_METADATA = "TRAIN_PREDICT_METADATA"
PREDICT_RESULTS = "TRAIN_PREDICT_RESULTS"

MIN_TRAINING_ROWS = 2

_STEP_FIELDS = """id string, model_id string, step_number int, step_name string,
    partition_item struct<partition: string, value: boolean>, target_cols array<string>,
    is_multi_target boolean, cat_cols array<string>, num_cols array<string>, boolean_cols array<string>"""
_RUN_SCHEMA = """id string, created_at string, completed_at string, level_name string,
    level_group_bys array<string>, status string, message string, run_time double"""
_SPLIT_SCHEMA = f"""{_STEP_FIELDS}, target_col string, training_rows bigint, test_rows bigint,
    eval_result struct<rmse: double, mae: double, mape: double, r2: double>"""
_PREDICT_SCHEMA = f"{_STEP_FIELDS}, prediction_rows bigint, message string"
_IMPORTANCE_SCHEMA = "feature string, importance double, target_col string, id string"


def step_id(model_id, step_name, is_promo):
    """Identity of a step within a run: the run, the step and the partition value, hashed."""
    return record_id(model_id, step_name, F.concat(F.lit(f"{c.IS_PROMO}="), is_promo.cast("string")))


class CascadeRun:
    """One run over a cleaned cohort dataset at one level."""

    def __init__(
        self, level: Level, dataset: DataFrame, sink=None, settings: CascadeSettings = CascadeSettings(), run_id: str | None = None
    ):
        """``run_id`` names a run that may have to be repeated: into a commit log its results go once."""
        self.level = level
        self.settings = settings
        self.sink = sink
        self.spark = dataset.sparkSession
        self.dataset = dataset
        self.model_id = run_id or str(uuid.uuid4())
        self.created_at = dt.datetime.now(dt.timezone.utc)
        self.outputs: dict[str, list[DataFrame]] = defaultdict(list)

    # --- run -------------------------------------------------------------------------------------

    def run(self) -> DataFrame:
        """Run the cascade and store its results; a failure is recorded and raised again."""
        try:
            self.dataset = cut(self.dataset)
            self._collect(SPINE_DATA, self.dataset)
            result = self._both_chains()
            self._collect(RAW_RESULTS, result)
        except Exception as problem:
            self._finish("FAILED", str(problem))
            raise
        self._finish("COMPLETED")
        return result

    def cascade(self) -> DataFrame:
        """All steps over both partitions, without storing anything but checkpoints."""
        self.dataset = cut(self.dataset)
        return self._both_chains()

    def _both_chains(self) -> DataFrame:
        """Rows whose promo flag is unknown belong to neither chain."""
        measures = [f.name for f in self.dataset.schema.fields if isinstance(f.dataType, T.NumericType)]
        start = nan_to_null(self.dataset.withColumns({m: F.col(m).cast("double") for m in measures}))
        with ThreadPoolExecutor(2) as pool:
            chains = [
                pool.submit(inheritable_thread_target(self.spark)(self._chain), start, is_promo) for is_promo in (True, False)
            ]
            promo, regular = [chain.result() for chain in chains]
        return promo.unionByName(regular, allowMissingColumns=True).withColumn("model_id", F.lit(self.model_id))

    def _chain(self, start: DataFrame, is_promo: bool) -> DataFrame:
        """The steps of one chain. No step changes a category, so their places are learnt once."""
        frame = start.filter(F.col(c.IS_PROMO) == is_promo)
        columns, categories = frame.columns, None
        if self.settings.max_categories is None:
            categories = Categories.of(frame, self.level.categories)
            frame = cut(categories.with_places(frame))
        for step in self.settings.steps:
            if step.applies_to(is_promo):
                frame = self._step(step, is_promo, frame, categories)
        statuses = [x for x in frame.columns if x not in columns and not x.startswith("_place_of_")]
        return frame.select(*columns, *statuses)

    # --- one step --------------------------------------------------------------------------------

    def _step(self, step: Step, is_promo: bool, frame: DataFrame, categories: Categories | None) -> DataFrame:
        settings = self.settings
        columns = frame.columns
        base = step.base(is_promo)
        inputs = Inputs(
            categorical=self.level.categories,
            numeric=c.regressors(step, is_promo),
            impute=settings.impute,
            max_categories=settings.max_categories,
        )
        flagged = frame.withColumns(
            {
                "_train": masks.training_mask(step, settings),
                "_predict": masks.prediction_mask(step, is_promo, settings),
                "_null_target": masks.null_target_mask(step, settings),
            }
        )
        counts = flagged.agg(
            *[F.count_if(F.col(f)).alias(f) for f in ("_train", "_predict", "_null_target")]
        ).first()
        log.info("%s promo=%s: %s", step.name, is_promo, counts.asDict())
        if counts["_null_target"]:
            own = [x for x in columns if not x.startswith("_place_of_")]
            self._collect(NULL_VALUES, flagged.filter("_null_target").select(*own))

        train = flagged.filter("_train")
        message = None
        if settings.evaluate:
            self._evaluate(step, is_promo, train, inputs, counts["_train"], categories)

        trained, wanted = F.col("_train"), F.col("_predict")
        if not counts["_predict"]:
            result = frame.withColumn(step.status_column, masks.status(F.lit(False), masks.training_mask(step, settings)))
            n_predicted = 0
        elif counts["_train"] < MIN_TRAINING_ROWS:
            # nothing to learn from: rows keep what they have
            message = f"{counts['_train']} training rows"
            result = frame.withColumn(step.status_column, masks.status(F.lit(False), masks.training_mask(step, settings)))
            n_predicted = 0
        else:
            fitted, models = trees.fit(train, list(step.targets), inputs, settings.trees, categories, counts["_train"])
            yhat = {t: f"_yhat{i}" for i, t in enumerate(step.targets)}
            scored = trees.predict(flagged, fitted, models, yhat)
            bounds = [n + suffix for n in yhat.values() for suffix in ("", "_lower", "_upper")]
            filled = masks.fill_back(step, is_promo, wanted, {t: F.col(n) for t, n in yhat.items()})
            stored = cut(
                scored.withColumns(
                    {**filled, step.status_column: masks.status(wanted, trained), "_base": F.col(base)}
                ).select(*columns, step.status_column, "_predict", "_base", *bounds)
            )
            long = masks.predictions_long(stored.filter("_predict"), step, self.level.keys, "_base", yhat)
            self._collect(PREDICT_RESULTS, long.withColumn("id", self._step_id(step, is_promo)))
            result = stored.select(*columns, step.status_column)
            n_predicted = counts["_predict"]
        row = (*self._step_values(step, is_promo, inputs), n_predicted, message)
        self._collect(PREDICT_METADATA, self._rows([row], _PREDICT_SCHEMA, step, is_promo))
        return result

    def _evaluate(
        self, step: Step, is_promo: bool, train: DataFrame, inputs: Inputs, n_train: int, categories: Categories | None
    ) -> None:
        """Hold out a tenth of the training rows, fit on the rest, store metrics and importances."""
        if n_train < 2 * MIN_TRAINING_ROWS:
            # too few rows for two parts: recorded without a result
            values = self._step_values(step, is_promo, inputs)
            rows = [(*values, target, n_train, 0, None) for target in step.targets]
            self._collect(SPLIT_METADATA, self._rows(rows, _SPLIT_SCHEMA, step, is_promo))
            return
        order = key_hash(self.level.keys, self.settings.split_seed)
        split = holdout(train, order, self.settings.test_share)
        fit_on, test = split.filter(~F.col("_test")), split.filter("_test")
        fitted, models = trees.fit(fit_on, list(step.targets), inputs, self.settings.trees, categories)
        scored = trees.predict(test, fitted, models).persist()
        values = self._step_values(step, is_promo, inputs)
        split_rows, importance_rows = [], []
        for model in models:
            m = evaluate(scored, model.target, f"{model.target}_yhat").first()
            n_test = m["rows"]
            result = (m["rmse"], m["mae"], m["mape"], m["r2"])
            split_rows.append((*values, model.target, n_train - n_test, n_test, result))
            importance_rows += [(name, gain, model.target, None) for name, gain in model.importances()]
            log.info("%s promo=%s %s: %s, top features %s", step.name, is_promo, model.target, result, model.importances()[:10])
        scored.unpersist()
        self._collect(SPLIT_METADATA, self._rows(split_rows, _SPLIT_SCHEMA, step, is_promo))
        if importance_rows:
            self._collect(IMPORTANCES, self._rows(importance_rows, _IMPORTANCE_SCHEMA, step, is_promo))

    # --- records ---------------------------------------------------------------------------------

    def _step_id(self, step: Step, is_promo: bool):
        return step_id(F.lit(self.model_id), F.lit(step.name), F.lit(is_promo))

    def _step_values(self, step: Step, is_promo: bool, inputs: Inputs):
        return (
            None,
            self.model_id,
            step.number,
            step.name,
            (c.IS_PROMO, is_promo),
            list(step.targets),
            len(step.targets) > 1,
            inputs.categorical,
            inputs.numeric,
            inputs.boolean,
        )

    def _rows(self, rows, schema: str, step: Step, is_promo: bool) -> DataFrame:
        return self.spark.createDataFrame(rows, schema).withColumn("id", self._step_id(step, is_promo))

    def _collect(self, table: str, frame: DataFrame) -> None:
        self.outputs[f"{self.level.name}_{table}"].append(frame)

    def _finish(self, status: str, message: str | None = None) -> None:
        done = dt.datetime.now(dt.timezone.utc)
        row = (
            self.model_id,
            self.created_at.isoformat(),
            done.isoformat(),
            self.level.name,
            self.level.columns,
            status,
            message,
            (done - self.created_at).total_seconds(),
        )
        self.outputs[MODEL_METADATA].append(self.spark.createDataFrame([row], _RUN_SCHEMA))
        if self.sink is not None:
            append_all(self.outputs, self.sink, self.model_id)
            self.outputs.clear()


def run_cascade(
    sources: CohortSources,
    as_of: dt.date,
    start: dt.date,
    sink=None,
    level: Level = c.LEVELS[-1],
    settings: CascadeSettings = CascadeSettings(),
    excluded_brand: str | None = None,
    cache_folder: str | None = None,
) -> DataFrame:
    """Load and clean the dataset of a level, by default the finest, and run the cascade on it."""
    dataset = load_clean_dataset(sources, as_of, start, level, excluded_brand, cache_folder)
    return CascadeRun(level, dataset, sink, settings).run()
