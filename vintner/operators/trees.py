"""Gradient-boosted trees on a preprocessed frame: fit, predict with intervals, importances."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.config import Z_95, TreeParams
from vintner.operators import preprocess
from vintner.operators.metrics import interval, residual_spread


@dataclass
class Model:
    """Fitted trees of one target plus what is needed to score any frame."""

    target: str
    trees: GBTRegressionModel
    spread: float
    inputs: preprocess.Fitted

    def importances(self) -> list[tuple[str, float]]:
        """Share of the total gain per feature, used features only, largest first."""
        vector = self.trees.featureImportances
        used = {int(i): float(v) for i, v in zip(vector.indices, vector.values) if v > 0}
        names = self.inputs.names_of(list(used))
        return sorted(((names[i], v) for i, v in used.items()), key=lambda x: -x[1])


def _fit_target(prepared: DataFrame, target: str, inputs: preprocess.Fitted, params: TreeParams) -> Model:
    regressor = GBTRegressor(
        featuresCol="features",
        labelCol="_label",
        predictionCol="_prediction",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.learning_rate,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share),
        seed=params.seed,
        maxBins=params.bins,
    )
    rows = prepared.select("features", F.col(target).cast("double").alias("_label"))
    trees = regressor.fit(rows)
    spread = trees.transform(rows).agg(residual_spread(F.col("_label"), F.col("_prediction"))).first()[0]
    return Model(target, trees, spread, inputs)


def partitions_for(rows: int, rows_per_partition: int) -> int:
    """The least power of two that leaves no more rows than asked for in a partition on average."""
    return 1 << max(0, -(-rows // rows_per_partition) - 1).bit_length()


def fit(
    train: DataFrame,
    targets: list[str],
    inputs: preprocess.Inputs,
    params: TreeParams = TreeParams(),
    categories: preprocess.Categories | None = None,
    n_rows: int | None = None,
) -> tuple[preprocess.Fitted, list[Model]]:
    """One model per target on shared features; the fits run side by side as separate Spark jobs.

    Row sampling goes by partition and position, so the rows are dealt by a hash of their values over
    partitions and sorted there: the model depends on rows, parameters and seed alone, not on the layout they
    arrive in. The number of partitions follows from that of the rows, ``n_rows`` if it is known already.
    """
    fitted = preprocess.fit(train, inputs, categories)
    partitions = partitions_for(train.count() if n_rows is None else n_rows, params.rows_per_partition)
    placed = train.withColumn("_order", F.xxhash64(*train.columns)).repartition(partitions, "_order")
    prepared = fitted.transform(placed).select("_order", "features", *targets)
    prepared = prepared.sortWithinPartitions("_order", *targets).drop("_order").persist()
    try:
        prepared.count()
        with ThreadPoolExecutor(len(targets)) as pool:
            jobs = [
                pool.submit(inheritable_thread_target(train.sparkSession)(_fit_target), prepared, t, fitted, params)
                for t in targets
            ]
            return fitted, [job.result() for job in jobs]
    finally:
        prepared.unpersist()


def predict(
    df: DataFrame, fitted: preprocess.Fitted, models: list[Model], names: dict[str, str] | None = None, z: float = Z_95
) -> DataFrame:
    """Add ``<name>``, ``<name>_lower`` and ``<name>_upper`` per model; rows keep their columns.

    ``names`` maps a target to the name of its prediction, by default ``<target>_yhat``.
    """
    out = fitted.transform(df, "_features")
    for model in models:
        name = (names or {}).get(model.target, f"{model.target}_yhat")
        scorer = model.trees.copy().setFeaturesCol("_features").setPredictionCol(name)
        out = scorer.transform(out)
        lower, upper = interval(F.col(name), F.lit(model.spread), z)
        out = out.withColumns({f"{name}_lower": lower, f"{name}_upper": upper})
    return out.drop("_features")
