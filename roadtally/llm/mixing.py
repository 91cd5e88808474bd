"""Mixing sources to target weights: iterative proportional fitting, then sampling, in DataFrame operations only.

Documents are counted into cells of source, language and topic, each weighing its tokens (runs without white space). The cell
weights are raked: for one dimension after the other they are scaled so that its marginal meets the target, until all
marginals do. The ratio of raked weight to tokens, times one budget factor, is a cell's sampling probability, at most 1;
the factor is set so that the expected tokens are ``rate`` of all tokens. Cells that need more than all of their documents
keep them all, and the rest make up for the tokens, not for the mix.

Default targets temper the token shares: the share of a value is its tokens to ``TEMPER`` of the dimension, normalised. Given targets
are shares per value; values without one are not sampled, and targets without documents are left out.

Only cells, not documents, are raked, and nothing but a few sums reaches the driver. Null source, language or topic is a value
of its own. Null and empty texts weigh nothing and are drawn like the rest of their cell; a cell without tokens has
the probability ``rate``. The draw hashes id and text, so it is the same in every run and repeated rows share it. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import written

DIMENSIONS = ("source", "lang", "topic")
# Exponents of the default targets: 1 keeps the shares, 0 makes them equal.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.9}
RATE = 0.6
ROUNDS, TOLERANCE = 15, 1e-4
SEED = 8
# Words from which a text counts as medium or long, and bars per word from which it counts as a table.
MEDIUM, LONG, BARS = 100, 1000, 0.1
NONE = "(none)"


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """The form of a text, where the corpus has no topics of its own: table, short, medium or long."""
    bars = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("|"), F.lit("")))
    return (
        F.when(bars > BARS * tokens, "table").when(tokens >= LONG, "long").when(tokens >= MEDIUM, "medium").otherwise("short")
    )


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """``(dimension, target)``: tokens to the given power; only their proportions matter."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0")
    return sums.select(dimension, F.pow("tokens", F.lit(power)).alias("target"))


def given(cells: DataFrame, dimension: str, shares: Mapping[str, float]) -> DataFrame:
    rows = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in shares.items()], f"{dimension} string, target double")
    there = cells.where("tokens > 0").select(dimension).distinct()
    return rows.join(there, dimension, "left_semi").where("target > 0")


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``weight``, whose marginals meet the targets in shares; the weights sum to 1.

    Steps are written tables. Sums per value are pre-aggregated in the tasks and joined back, so a value that most cells
    share is never gathered in one task.
    """
    shares = {}
    for dimension, target in targets.items():
        whole = target.agg(F.sum("target")).first()[0] or 1.0
        shares[dimension] = written(target.select(dimension, (F.col("target") / whole).alias("target")), "target")
    raked = cells.withColumn("weight", F.col("tokens").cast("double")).where("weight > 0")
    for _ in range(rounds):
        worst = 0.0
        for dimension in shares:
            factors = written(
                raked.groupBy(dimension)
                .agg(F.sum("weight").alias("now"))
                .join(shares[dimension], dimension)
                .select(dimension, (F.col("target") / F.col("now")).alias("factor")),
                "factors",
            )
            worst = max(worst, factors.agg(F.max(F.abs(F.col("factor") - 1))).first()[0] or 0.0)
            raked = raked.join(factors, dimension).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
            raked = raked.where("weight > 0")
        raked = written(raked, "raked")
        if worst <= tolerance:
            break
    return raked


def budget_factor(raked: DataFrame, wanted: float) -> float:
    """The factor b at which the sum of ``least(tokens, b * weight)`` is the wanted number of tokens."""
    factor = 0.0
    while True:
        full = F.col("tokens") <= factor * F.col("weight")
        taken, open_ = raked.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_:
            return factor
        following = (wanted - float(taken or 0)) / open_
        if following <= factor * (1 + 1e-12):
            return factor
        factor = following


def sample_to_targets(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    rate: float = RATE,
    topic: Column | None = None,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``(row, source, lang, topic, tokens, probability, sampled)`` for every row of ``docs(doc_id, text, source, lang)``."""
    value = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    counted = docs.select(
        F.struct(*keep).alias("row"),
        value(F.col("source")).alias("source"),
        value(F.col("lang")).alias("lang"),
        tokens_of(F.col("text")).alias("tokens"),
        (F.lit(None).cast("string") if topic is None else value(topic)).alias("given_topic"),
        F.col("text").alias("_text"),
        (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "text"), 11) / F.lit(float(1 << 53))).alias("draw"),
    )
    form = value(topic_of(F.col("_text"), F.col("tokens")))
    rows = counted.withColumn("topic", F.coalesce("given_topic", form)).drop("given_topic", "_text")
    cells = written(
        rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents")), "cells"
    )
    goals = {
        d: given(cells, d, targets[d]) if targets and d in targets else tempered(cells, d, TEMPER[d]) for d in DIMENSIONS
    }
    raked = rake(cells, goals)
    whole = cells.agg(F.sum("tokens")).first()[0] or 0
    factor = budget_factor(raked, rate * whole)
    chance = F.least(F.lit(1.0), F.lit(factor) * F.col("weight") / F.col("tokens"))
    chances = written(
        cells.join(raked.select(*DIMENSIONS, "weight"), list(DIMENSIONS), "left").select(
            *DIMENSIONS,
            F.when(F.col("tokens") == 0, F.lit(rate)).otherwise(F.coalesce(chance, F.lit(0.0))).alias("probability"),
        ),
        "chances",
    )
    return rows.join(chances, list(DIMENSIONS)).select(
        "row", *DIMENSIONS, "tokens", "probability", (F.col("draw") < F.col("probability")).alias("sampled")
    )
