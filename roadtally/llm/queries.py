"""The registered queries of the text operators, over whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.llm import decontamination, mixing, passages, secrets, sharding, toxicity, warc, weighted_sampling
from roadtally.llm.common import table
from roadtally.llm.jaccard_join import jaccard_components
from roadtally.llm.link_graph import judge_urls
from roadtally.llm.periodic_runs import periodic_runs
from roadtally.llm.suffix_dedup import remove_repeats
from roadtally.llm.whitening import whiten

SHARDS = 24


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, lexicon, ["doc_id"]).select(
        "row.doc_id", (toxicity.fold_of(F.col("row.doc_id")) == 2).alias("held_out"), "score", "predicted", "n_matches"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.with_references(table(spark, sf_dir, "pages"))
    archives = warc.write_archives(rows, warc.archive_folder(spark))
    return warc.read_archives(archives, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op4_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_to_targets(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "source", "lang", "topic", "tokens", "probability", "sampled"
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS, ["doc_id"]).select(
        "row.doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_secrets": op3_secrets,
    "op4_weighted_sampling": op4_weighted_sampling,
    "op5_decontamination": op5_decontamination,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_passages": op7_passages,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_url_filter": op10_url_filter,
    "op11_whitening": op11_whitening,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Five hex digits of a SHA-1 are four base32 digits.
_DIGEST = " || ".join(
    f"substr('{_BASE32}', cast((cast('0x' || substr(sha, {5 * i + 1}, 5) as bigint) // {32 ** (3 - j)}) % 32 as integer) + 1, 1)"
    for i in range(8)
    for j in range(4)
)
_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLE: dict[str, str] = {
    "op2_warc": f"""
        with payloads as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as sha from pages),
        firsts as (select sha, min(page_id) as first from payloads group by sha)
        select page_id, cast(payload_bytes as bigint) as payload_bytes, {_DIGEST} as payload_digest,
          case when page_id <> first then 'revisit' else 'response' end as record_type,
          case when page_id <> first then first end as refers_to
        from payloads join firsts using (sha)""",
    "op5_decontamination": f"""
        with docs as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
        items as (select item_id, {_WORDS} as w from benchmark),
        windows as (
          select distinct item_id, least(len(w), 10) as n, list_slice(w, s, s + 9) as phrase
          from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from items where len(w) > 0)),
        sizes as (select distinct n from windows),
        runs as (select rid, n, s, list_slice(w, s, s + n - 1) as phrase
          from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as s from docs, sizes where len(w) >= n)),
        found as (select rid, item_id, s, windows.n as n from runs join windows using (phrase)),
        hits as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(s, s + n)) as p from found) group by rid),
        named as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as listed
          from (select distinct rid, cast(item_id as varchar) as item from found) group by rid)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
          sha256(coalesce(listed, '')) as items_sha256, n_hit is not null as contaminated
        from docs left join hits using (rid) left join named using (rid)""",
}
