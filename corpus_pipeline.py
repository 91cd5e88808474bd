"""From raw documents to sharded training text in five stages; each result is written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.llm import decontamination, mixing, sharding, toxicity
from roadtally.llm.common import table, written
from roadtally.llm.jaccard_join import jaccard_rows

SHARDS = 24
# Share of the tokens that the mixing stage keeps.
MIX_RATE = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; the lexicon is learned from this stage's own documents."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, lexicon, docs.columns).where("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the text with the smallest id, and one row of it.

    An id may stand for several texts: each text is judged as a document of its own. Rows without an id stay.
    """
    rows = jaccard_rows(docs).where("doc_id is not null")
    first = F.min(F.struct("doc_id", "h")).alias("first")
    firsts = rows.where("group is not null").groupBy("group").agg(first).select("first.*")
    firsts = firsts.union(rows.where("group is null").select("doc_id", "h")).distinct()
    name = [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h")]
    placed = docs.where("doc_id is not null").select("*", *name)
    kept = placed.join(written(firsts.toDF("_id", "_h"), "firsts"), ["_id", "_h"], "left_semi")
    again = written(kept.groupBy("_id", "_h").count().where("count > 1").select("_id", "_h"), "again")
    single = kept.join(again, ["_id", "_h"], "left_anti")
    repeated = kept.join(again, ["_id", "_h"], "left_semi").dropDuplicates(["_id", "_h"])
    nameless = docs.where("doc_id is null")
    return single.unionByName(repeated).select(*docs.columns).unionByName(nameless)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any occurrence of a benchmark window."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    hit = written(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "hit")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["_hash"]), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled towards tempered shares of sources, languages and forms."""
    return mixing.sample_to_targets(docs, rate=MIX_RATE, keep=docs.columns).where("sampled").select("row.*")


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the shard and the slot in it, in place of columns of those names."""
    docs = docs.drop("shard", "slot")
    return sharding.shard_rows(docs, SHARDS, docs.columns).select("row.*", "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

# Scoring, similarity joins and raking have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
