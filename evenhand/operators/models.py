"""Forest regressors with and without a sensitive feature, and their evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from evenhand import schemas
from evenhand.fixed_values import BASELINE_FEATURES, FAIR_FEATURES, FOREST
from evenhand.operators.disparity import with_errors
from evenhand.operators.sampling import hash_split
from evenhand.session import written

FEATURE_SETS = {"baseline": BASELINE_FEATURES, "fair": FAIR_FEATURES}
LABEL = "fare_amount"


def ml_ready(trips: DataFrame, features: Sequence[str] = BASELINE_FEATURES) -> DataFrame:
    """Rows with a positive fare, distance and duration and without nulls among label and features."""
    positive = [F.col(c) > 0 for c in (LABEL, "trip_distance", "trip_duration_minutes")]
    usable = positive[0] & positive[1] & positive[2]
    return trips.filter(usable).na.drop(subset=[LABEL, *features])


def numeric(trips: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add every feature as a double under ``x_<name>``; flags become 1 and 0, an unknown flag 0."""
    kinds = dict(trips.dtypes)
    added = {}
    for name in features:
        value = F.col(name)
        added[f"x_{name}"] = F.when(value, 1.0).otherwise(0.0) if kinds[name] == "boolean" else value.cast("double")
    return trips.withColumns(added)


def feature_stages(feature_sets: Mapping[str, Sequence[str]]) -> list:
    """For each model an assembler that skips invalid rows and a scaler to zero mean and unit deviation."""
    stages = []
    for model, features in feature_sets.items():
        raw = f"{model}_raw"
        stages.append(VectorAssembler(inputCols=[f"x_{f}" for f in features], outputCol=raw, handleInvalid="skip"))
        stages.append(StandardScaler(inputCol=raw, outputCol=f"{model}_features", withMean=True, withStd=True))
    return stages


@dataclass
class TrainedModels:
    """Fitted features and forests, with the rows held back for evaluation."""

    features: PipelineModel
    forests: dict[str, RandomForestRegressionModel]
    feature_sets: Mapping[str, Sequence[str]]
    train: DataFrame
    test: DataFrame

    @property
    def predictions(self) -> dict[str, str]:
        return {name: f"predicted_fare_{name}" for name in self.forests}

    def score(self, rows: DataFrame | None = None) -> DataFrame:
        """All predictions and errors side by side; the held-back rows unless others are given."""
        scored = self.test if rows is None else self.features.transform(numeric(rows, self.all_features))
        for forest in self.forests.values():
            scored = forest.transform(scored)
        return with_errors(scored, LABEL, self.predictions)

    @property
    def all_features(self) -> list[str]:
        return sorted({f for features in self.feature_sets.values() for f in features})

    def importances(self, spark: SparkSession) -> DataFrame:
        """Rows of ``model, feature, importance``, most important first; one row per model and feature."""
        rows = [
            (name, feature, float(weight))
            for name, forest in self.forests.items()
            for feature, weight in zip(self.feature_sets[name], forest.featureImportances.toArray())
        ]
        table = spark.createDataFrame(rows, "model string, feature string, importance double")
        return table.orderBy("model", F.desc("importance"), "feature")

    def save(self, folder: str) -> None:
        self.features.write().overwrite().save(f"{folder}/features")
        for name, forest in self.forests.items():
            forest.write().overwrite().save(f"{folder}/{name}_model")

    def hold(self) -> None:
        """Keep the held-back rows cached, for callers that score them more than once."""
        self.test.persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        self.test.unpersist()


def load_forest(path: str) -> RandomForestRegressionModel:
    return RandomForestRegressionModel.load(path)


def train(
    trips: DataFrame,
    split_keys: Sequence[str],
    feature_sets: Mapping[str, Sequence[str]] = FEATURE_SETS,
    train_part: float = 0.8,
    forest: Mapping[str, int] = FOREST,
    keep: Sequence[str] = schemas.PREDICTIONS.fieldNames(),
) -> TrainedModels:
    """Fit one forest per feature set on the same rows.

    Scalers see all rows, the held-back ones included. The split goes by row content, so it does not change
    with the partitioning. Labels and features of the training rows are cached, on disk where memory is short,
    while the forests grow. Of the columns that no model needs only those in ``keep`` are carried along.
    """
    names = sorted({f for features in feature_sets.values() for f in features})
    carried = [c for c in trips.columns if c in {*names, LABEL, *split_keys, *keep}]
    # read by two scalers and two splits: written once instead of derived four times
    usable = written(numeric(ml_ready(trips, names), names).select(*carried, *[f"x_{n}" for n in names]), "features")
    cores = usable.sparkSession.sparkContext.defaultParallelism
    if usable.rdd.getNumPartitions() < cores:
        usable = usable.repartition(cores)  # few rows, read again for every level of every tree
    pipeline = Pipeline(stages=feature_stages(feature_sets)).fit(usable)
    fit_rows, held_back = hash_split(pipeline.transform(usable), split_keys, train_part)
    grown_from = fit_rows.select(LABEL, *[f"{model}_features" for model in feature_sets]).persist(StorageLevel.MEMORY_AND_DISK)
    forests = {}
    for model in feature_sets:
        regressor = RandomForestRegressor(
            featuresCol=f"{model}_features", labelCol=LABEL, predictionCol=f"predicted_fare_{model}", **forest
        )
        forests[model] = regressor.fit(grown_from)
    grown_from.unpersist()
    return TrainedModels(pipeline, forests, feature_sets, fit_rows, held_back)


def regression_metrics(scored: DataFrame, models: Mapping[str, str], label: str = LABEL) -> DataFrame:
    """RMSE, MAE and R² of every model from one aggregation, and R² relative to the first in points."""
    measures = [F.count(F.lit(1)).alias("n"), F.var_pop(label).alias("variance")]
    for name, prediction in models.items():
        error = F.col(prediction) - F.col(label)
        measures += [F.avg(error * error).alias(f"{name}_mse"), F.avg(F.abs(error)).alias(f"{name}_mae")]
    first = next(iter(models))
    rows = []
    for name in models:
        r2 = F.lit(1.0) - F.try_divide(F.col(f"{name}_mse"), F.col("variance"))
        first_r2 = F.lit(1.0) - F.try_divide(F.col(f"{first}_mse"), F.col("variance"))
        rows.append(
            F.struct(
                F.lit(name).alias("model"),
                F.sqrt(f"{name}_mse").alias("rmse"),
                F.col(f"{name}_mae").alias("mae"),
                r2.alias("r2"),
                ((r2 - first_r2) * 100.0).alias("r2_delta_pp"),
            )
        )
    return scored.agg(*measures).select("n", F.inline(F.array(*rows)))


def evaluate(scored: DataFrame, prediction: str, metric: str, label: str = LABEL) -> float:
    """One metric by MLlib's own evaluator."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric).evaluate(scored)
