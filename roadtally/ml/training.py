"""Fitting, evaluating and storing the severity classifier."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.ml.frame import (
    FEATURES,
    MIN_ROWS,
    SEED,
    TARGET,
    TEST_PERCENT,
    class_weights,
    feature_options,
    split_groups,
    target_distribution,
)
from roadtally.ml.newton import newton
from roadtally.ml.report import accuracies
from roadtally.session import checkpointed
from roadtally.sources.files import read_extract

# Fixed value: inverse regularisation strength.
C = 1.0

METADATA_SCHEMA = (
    "version string, feature_columns array<string>, classes array<string>,"
    " feature_options map<string, array<string>>, trained_at string, n_samples_total bigint,"
    " n_samples_train bigint, n_samples_test bigint, accuracy_train double, accuracy_test double,"
    " target_distribution map<string, double>"
)


@dataclass(frozen=True)
class TrainedModel:
    pipeline: PipelineModel
    metadata: DataFrame
    classes: list[str]
    groups: DataFrame


def encoder_stages() -> list:
    """One slot per known category in alphabetic order; an unknown or missing value encodes to zeros.

    The indexer keeps unknowns in an extra last place and the encoder drops that place.
    """
    indexed = [f"{c}_index" for c in FEATURES]
    encoded = [f"{c}_slots" for c in FEATURES]
    return [
        StringIndexer(
            inputCols=list(FEATURES), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=encoded, outputCol="features"),
    ]


def fit(groups: DataFrame, classes: list[str]) -> PipelineModel:
    """Class-balanced multinomial logistic regression on the training counts of split groups.

    A group of n equal rows is one row of weight n, which leaves the objective unchanged. Each class must have training rows.
    """
    balanced = {r[TARGET]: r["weight"] for r in class_weights(groups).collect()}  # a row per severity class
    label, weight = F.lit(None).cast("int"), F.lit(0.0)
    for position, name in enumerate(classes):
        is_class = F.col(TARGET) == name
        label = F.when(is_class, F.lit(position)).otherwise(label)
        weight = F.when(is_class, F.lit(balanced[name])).otherwise(weight)
    weighted = groups.where("n_train > 0").select(
        *FEATURES, label.alias("label"), (F.col("n_train") * weight).alias("weight")
    )
    encoder = Pipeline(stages=encoder_stages()).fit(weighted)
    slots, known = [F.lit(0)], 1
    for feature, values in zip(FEATURES, encoder.stages[0].labelsArray, strict=True):
        slots.append((F.col(f"{feature}_index") + known).cast("int"))
        known += len(values)
    rows = encoder.transform(weighted).select(F.array(*slots).alias("slots"), "label", "weight").persist()
    try:
        weights = newton(rows, len(classes), known, 1.0 / C)
    finally:
        rows.unpersist()
    return PipelineModel(stages=[*encoder.stages, _classifier(weights)])


def _classifier(weights: np.ndarray) -> LogisticRegressionModel:
    """Spark's model for given coefficients; the intercepts come first in each class's row."""
    classes, slots = weights.shape
    matrix = DenseMatrix(classes, slots - 1, weights[:, 1:].ravel().tolist(), isTransposed=True)
    intercepts = DenseVector(weights[:, 0])
    name = "org.apache.spark.ml.classification.LogisticRegressionModel"
    uid = f"LogisticRegression_{uuid.uuid4().hex[:12]}"
    made = LogisticRegressionModel._new_java_obj(name, uid, matrix, intercepts, classes, True)
    return LogisticRegressionModel(made)


def with_prediction(rows: DataFrame, pipeline: PipelineModel, classes: list[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in classes])
    scored = pipeline.transform(rows)
    return scored.withColumn("predicted", F.element_at(names, F.col("prediction").cast("int") + 1))


def train(
    vehicles: DataFrame,
    accidents: DataFrame,
    min_rows: int = MIN_ROWS,
    test_percent: int = TEST_PERCENT,
    seed: int = SEED,
) -> TrainedModel:
    """Join, clean, split, fit and evaluate. The full data is read once, into the counted groups."""
    spark = vehicles.sparkSession
    if vehicles.isEmpty() or accidents.isEmpty():
        raise ValueError("no accidents or no vehicles to train on")
    groups = checkpointed(split_groups(vehicles, accidents, test_percent, seed))
    sizes = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.sum("n_train").alias("train"),
        F.sum("n_test").alias("test"),
    ).first()
    if sizes["total"] < min_rows:
        raise ValueError(f"too few clean rows to train on: {sizes['total']} < {min_rows}")
    shares = {r[TARGET]: r["share"] for r in target_distribution(groups).collect()}
    fitted = {r[TARGET] for r in class_weights(groups).select(TARGET).collect()}
    classes = sorted(set(shares) & fitted)
    pipeline = fit(groups, classes)
    predicted = with_prediction(groups, pipeline, classes)
    scores = {r["part"]: r["accuracy"] for r in accuracies(predicted).collect()}
    options = {feature: [] for feature in FEATURES}
    for row in feature_options(groups.where("n_train > 0")).orderBy("feature", "place").collect():
        options[row["feature"]].append(row["value"])
    metadata = (
        uuid.uuid4().hex,
        list(FEATURES),
        classes,
        options,
        datetime.now(timezone.utc).isoformat(),
        sizes["total"],
        sizes["train"],
        sizes["test"],
        scores["train"],
        scores["test"],
        shares,
    )
    return TrainedModel(pipeline, spark.createDataFrame([metadata], METADATA_SCHEMA), classes, groups)


def save(model: TrainedModel, root: str) -> str:
    """Store a new version; the metadata is written last and makes the version complete."""
    version = model.metadata.first()["version"]
    path = f"{root.rstrip('/')}/version={version}"
    model.pipeline.write().save(f"{path}/model")
    model.metadata.drop("version").coalesce(1).write.parquet(f"{path}/metadata")
    return path


def retrain(spark: SparkSession, accidents_path: str, vehicles_path: str, models_root: str) -> TrainedModel:
    """Train on all extracts so far and store the result as the newest version."""
    accidents = read_extract(spark, accidents_path, "accidents")
    vehicles = read_extract(spark, vehicles_path, "vehicles")
    model = train(vehicles, accidents)
    save(model, models_root)
    return model
