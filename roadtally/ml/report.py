"""Quality of predictions from counted groups: confusion, accuracy, per-class report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.ml.frame import TARGET


def confusion(predicted: DataFrame, count: str = "n") -> DataFrame:
    """Rows per actual and predicted class."""
    counted = predicted.groupBy(F.col(TARGET).alias("actual"), "predicted").agg(F.sum(count).alias("n"))
    return counted.where(F.col("n") > 0)


def accuracies(predicted: DataFrame, parts: Sequence[str] = ("train", "test")) -> DataFrame:
    """Share of right predictions per part, ``(part, accuracy)``, from one pass over the counts ``n_<part>``."""
    rows = F.explode(F.create_map(*[x for p in parts for x in (F.lit(p), F.col(f"n_{p}"))])).alias("part", "n")
    hits = F.sum(F.when(F.col("right"), F.col("n")).otherwise(0))
    counted = predicted.select((F.col(TARGET) == F.col("predicted")).alias("right"), rows)
    return counted.groupBy("part").agg((hits.cast("double") / F.sum("n").cast("double")).alias("accuracy"))


def classification_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    A ratio without cases is 0. Works on the confusion matrix, which has one row per pair of classes.
    """
    hits = "if(actual = predicted, n, 0L)"
    sides = matrix.selectExpr(
        "inline(array("
        f"named_struct('class', actual, 'support', n, 'claimed', 0L, 'hits', {hits}),"
        "named_struct('class', predicted, 'support', 0L, 'claimed', n, 'hits', 0L)))"
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hits")])
    per_class = sums.select(
        "class",
        _ratio("hits", "claimed").alias("precision"),
        _ratio("hits", "support").alias("recall"),
        _ratio("2 * hits", "claimed + support").alias("f1"),
        "support",
    )
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], total.alias("support"))
    weighted = per_class.agg(
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures], total.alias("support")
    )
    overall = sums.agg((F.sum("hits").cast("double") / total.cast("double")).alias("f1"), total.alias("support"))
    return (
        per_class.unionByName(overall.withColumn("class", F.lit("accuracy")), allowMissingColumns=True)
        .unionByName(macro.withColumn("class", F.lit("macro avg")))
        .unionByName(weighted.withColumn("class", F.lit("weighted avg")))
    )


def _ratio(numerator: str, denominator: str) -> Column:
    return F.expr(f"coalesce(cast({numerator} as double) / nullif(cast({denominator} as double), 0), 0)")
