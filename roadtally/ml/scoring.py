"""Scoring any number of rows with a stored model, and its description for callers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from roadtally.ml.training import with_prediction


def newest_version(spark: SparkSession, root: str) -> Row:
    """Metadata of the newest complete version: a row per version is read, the model files are not."""
    root = root.rstrip("/")
    versions = spark.read.option("basePath", root).parquet(f"{root}/version=*/metadata")
    newest = versions.orderBy(F.desc("trained_at"), "version").first()
    if newest is None:
        raise FileNotFoundError(f"no trained model below {root}")
    return newest


def load_version(root: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/version={version}/model")


def load_newest(spark: SparkSession, root: str) -> tuple[PipelineModel, Row]:
    metadata = newest_version(spark, root)
    return load_version(root, metadata["version"]), metadata


def score(rows: DataFrame, pipeline: PipelineModel, metadata: Row) -> DataFrame:
    """Best class, probability per class, the classes ranked with percentages, and model facts per row.

    The model is a narrow transformation of the rows as they are: no shuffle, no table of cases.
    """
    return _apply(rows, pipeline, metadata)


def _apply(rows: DataFrame, pipeline: PipelineModel, metadata: Row) -> DataFrame:
    classes = list(metadata["classes"])
    names = F.array(*[F.lit(c) for c in classes])
    scored = with_prediction(rows, pipeline, classes).withColumn("p", vector_to_array("probability"))
    # Sorting by the negative probability first and the name second ranks ties by name.
    places = [F.struct((-F.col("p")[i]).alias("below"), F.lit(c).alias("class")) for i, c in enumerate(classes)]
    ranked = F.transform(
        F.sort_array(F.array(*places)),
        lambda place: F.struct(
            place["class"].alias("class"),
            (-place["below"]).alias("probability"),
            F.round(-place["below"] * 100, 1).alias("percent"),
        ),
    )
    return scored.select(
        *rows.columns,
        F.col("predicted").alias("predicted_severity"),
        F.map_from_arrays(names, F.col("p")).alias("probabilities"),
        ranked.alias("ranked"),
        F.lit(metadata["trained_at"]).alias("model_trained_at"),
        F.lit(metadata["n_samples_total"]).alias("model_n_samples"),
        F.lit(metadata["accuracy_test"]).alias("model_accuracy_test"),
    )


def describe(metadata: Row) -> dict:
    """What a caller needs to offer the features and judge the model."""
    return {
        "feature_options": dict(metadata["feature_options"]),
        "classes": list(metadata["classes"]),
        "trained_at": metadata["trained_at"],
        "n_samples": metadata["n_samples_total"],
        "accuracy_test": metadata["accuracy_test"],
    }
