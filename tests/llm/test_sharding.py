from collections import defaultdict
from zlib import crc32

import pytest

from roadtally.llm import sharding as S
from roadtally.llm.queries import op9_sharding
from tests.llm.cases import ROWS, documents, simple


def check(rows, texts, shards, slack):
    """Every row once, sizes and sums right, slots gapless, shards within the largest row plus the tolerance of each other."""
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 8, crc32((t or "").encode())) for i, t in texts if i is not None
    )
    assert len(rows) == len(texts)
    slots, sums = defaultdict(list), dict.fromkeys(range(shards), 0)
    for r in rows:
        slots[r.shard].append(r.slot)
        sums[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sums) == set(range(shards))
    largest = max((r["size"] for r in rows), default=0)
    assert max(sums.values()) - min(sums.values()) <= 2 * largest + slack


def test_query(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = op9_sharding(spark, sf_dir).collect()
    check(rows, texts, 24, 0.001 * sum(r["size"] for r in rows) / 24)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def flat(df):
    return df.select("row.doc_id", "size", "text_crc32", "shard", "slot").collect()


def test_hot_text_is_split_and_stays_together(spark):
    texts = ["same text"] * 3000 + [f"text {i} " + "x" * (i % 50) for i in range(3000)]
    rows = flat(S.shard_rows(simple(spark, texts), 7, ["doc_id"], rows_per_piece=200))
    check(rows, list(enumerate(texts)), 7, 100)
    hot = sorted({r.shard for r in rows if r.doc_id < 3000})
    assert hot == list(range(hot[0], hot[-1] + 1)) and len(hot) <= 4
    again = flat(S.shard_rows(simple(spark, texts), 7, ["doc_id"], rows_per_piece=10_000))
    assert sum(a.shard != b.shard for a, b in zip(sorted(rows), sorted(again), strict=True)) < 60


def test_odd_rows(spark):
    rows = S.shard_rows(documents(spark), 4, documents(spark).columns).select("row.*", "shard").collect()
    assert len(rows) == len(ROWS)
    nulls = [r for r in flat(S.shard_rows(documents(spark), 4, ["doc_id"])) if r.doc_id in (1, 2)]
    assert [r["size"] for r in nulls] == [8, 8] and [r.text_crc32 for r in nulls] == [0, 0]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_rows_than_shards(spark, n):
    rows = flat(S.shard_rows(simple(spark, [f"t{i}" for i in range(n)]) if n else documents(spark, []), 5, ["doc_id"]))
    assert len(rows) == n and len({(r.shard, r.slot) for r in rows}) == n
