"""Every stage on what its predecessor kept, against plain references."""

import corpus_pipeline as C
from roadtally.llm import mixing, toxicity
from roadtally.llm.common import written
from tests.llm.cases import components, documents, shingles
from tests.llm.test_decontamination import expected as contaminated
from tests.llm.test_sharding import check as check_shards

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in C.STAGES:
        out = written(stage(spark, docs, sf_dir), name)
        before, rows = {r.doc_id: r for r in docs.collect()}, out.collect()
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        assert all(tuple(r[c] for c in COLUMNS) == tuple(before[i]) for i, r in after.items())
        if name == "toxicity":
            lexicon = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            scored = toxicity.score_toxicity(docs, lexicon, ["doc_id"]).where("predicted = 0").select("row.doc_id")
            assert set(after) == {r.doc_id for r in scored.collect()}
        elif name == "jaccard_join":
            sets = [(i, shingles(r.text)) for i, r in before.items()]
            groups = components(sets)
            assert set(after) == {g if s else i for (i, s), g in zip(sets, groups, strict=True)}
        elif name == "decontamination":
            assert set(after) == {r[0] for r in contaminated([(i, r.text) for i, r in before.items()], items) if not r[5]}
        elif name == "mixing":
            drawn = mixing.sample_to_targets(docs, rate=C.MIX_RATE).where("sampled").select("row.doc_id")
            assert set(after) == {r.doc_id for r in drawn.collect()} and len(after) < len(before)
        else:
            assert set(after) == set(before) and out.columns == [*COLUMNS, "shard", "slot"]
            sizes = [dict(doc_id=r.doc_id, size=len(r.text.encode()) + 8, shard=r.shard, slot=r.slot) for r in rows]
            for r in sizes:
                r["text_crc32"] = __import__("zlib").crc32(after[r["doc_id"]].text.encode())
            check_shards([_Row(r) for r in sizes], [(i, r.text) for i, r in before.items()], 24, 100)
        docs = out


def test_near_copies_are_judged_by_text(spark, sf_dir):
    """One id with a copy of another document and with a text of its own: the copy goes, the other text stays, once."""
    words = " ".join(f"w{i}" for i in range(60))
    own = " ".join(f"y{i}" for i in range(20))
    rows = [(3, words), (7, words + " end"), (7, own), (7, own), (9, own), (None, words), (11, ""), (11, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = C.drop_near_copies(spark, docs, sf_dir)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, words), (3, words), (7, own), (11, "")]


class _Row(dict):
    __getattr__ = dict.__getitem__


def test_odd_rows(spark, sf_dir):
    """Null texts, ids, languages and sources, repeated rows and foreign columns pass all stages."""
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, documents(spark), sf_dir)
        assert docs.columns == documents(spark).columns
        assert stage(spark, documents(spark, []), sf_dir).count() == 0
        ids = sorted((r.doc_id or -1) for r in docs.collect())
        assert len(ids) == len(set(ids)) or name != "jaccard_join"
    shards = C.deal_shards(spark, documents(spark), sf_dir).collect()
    assert len(shards) == documents(spark).count()
