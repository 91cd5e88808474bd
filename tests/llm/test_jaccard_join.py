"""The parity-sketch join against a join of all sets that share a shingle."""

import random

import numpy as np
from pyspark.sql import functions as F

from roadtally.llm import jaccard_join as J
from roadtally.llm.queries import op6_jaccard_join
from tests.llm.cases import ROWS, components, documents, shingles, simple


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    return sorted(
        ((i, len(s), c if s else i) for (i, s), c in zip(sets, components(sets), strict=True)), key=repr
    )


def test_odd_rows(spark):
    assert result(J.jaccard_components(documents(spark))) == expected([(r[0], r[1]) for r in ROWS])


def test_empty_table(spark):
    assert J.jaccard_components(documents(spark, [])).count() == 0


def test_query_against_all_pairs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert result(op6_jaccard_join(spark, sf_dir)) == expected([tuple(r) for r in rows])


def test_groups_of_near_copies(spark):
    """Chains and stars of edits at many lengths, about the threshold."""
    rng, texts = random.Random(3), []
    for length in (5, 6, 9, 14, 15, 16, 17, 31, 33, 64, 120, 300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randrange(1 + length // 20 + 1)):
                words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words[: length - rng.randrange(2)]))
            base = words if rng.random() < 0.4 else base
    assert result(J.jaccard_components(simple(spark, texts))) == expected(list(enumerate(texts)))


def test_rows_without_an_id_link(spark):
    """A chain through a text that only rows without an id hold, several times; and a group without any id."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[i : i + 40]) for i in (0, 2, 4)]
    other = " ".join(f"x{i}" for i in range(30))
    rows = [(1, texts[0]), (None, texts[1]), (None, texts[1]), (2, texts[2]), (None, other), (None, other + " end")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = result(J.jaccard_components(docs))
    assert got == expected(rows)
    assert [g[2] for g in got if g[0] is not None] == [1, 1]


def test_one_id_with_several_texts(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(3, words), (7, words + " end"), (7, " ".join(f"y{i}" for i in range(20))), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_rows(docs).collect()) == [
        (3, 56, 3), (7, 0, 7), (7, 16, 7), (7, 57, 3),
    ]


def test_short_sketches_bound_from_below():
    """Folded by bytes as by bits; never further apart than the full ones."""
    draw = np.random.Generator(np.random.PCG64(2))
    for n in [*range(1, 70), 100, 300, 2000, 70_000]:
        a, b = (np.unique(draw.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(2))
        bits = [J.sketch_bits(s) for s in (a, b)]
        size = min(J.brief_bits(len(a)), J.brief_bits(len(b)))
        folded = [J.fold_packed(np.packbits(x), len(x), size) for x in bits]
        assert [f.tobytes() for f in folded] == [np.packbits(J._folded(x, size)).tobytes() for x in bits]
        if len(bits[0]) == len(bits[1]):
            assert np.bitwise_count(folded[0] ^ folded[1]).sum() <= np.count_nonzero(bits[0] != bits[1])


def test_rows_of_a_frequent_passage_follow_its_holders(spark, monkeypatch):
    """Otherwise different texts that share a passage: rows that are compared grow with the holders."""
    monkeypatch.setattr(J, "RUN_CELL", 1000)
    compared = []
    plain = J._crossing_pairs

    def counted(runs, parts, info, search):
        compared.append(runs.count())
        return plain(runs, parts, info, search)

    monkeypatch.setattr(J, "_crossing_pairs", counted)
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(14))
    for holders in (500, 1500):
        texts = [passage + " " + " ".join(f"w{rng.randrange(10**7)}" for _ in range(30)) for _ in range(holders)]
        assert {r.component_id for r in J.jaccard_components(simple(spark, texts)).collect()} == set(range(holders))
    assert compared[-1] <= 4 * compared[0]


def test_keys_of_linked_sets_meet():
    """The pigeonhole: sets at the threshold always publish a common key, whatever the hashes."""
    draw = np.random.Generator(np.random.PCG64(1))
    for n in [*range(1, 40), 63, 64, 65, 100, 127, 128, 255, 300, 1000]:
        for _ in range(30):
            common = draw.integers(0, 2**63, max(1, -(-n * 8 // 9)), dtype=np.uint64)
            total = len(common) * 100 // 80
            left = int(draw.integers(0, total - len(common) + 1))
            more = draw.integers(0, 2**63, total - len(common), dtype=np.uint64)
            a, b = np.unique(np.append(common, more[:left])), np.unique(np.append(common, more[left:]))
            assert np.intersect1d(J.published_keys(a), J.published_keys(b)).size
            sketches = [np.packbits(J.sketch_bits(s)).tobytes() for s in (a, b)]
            assert J.may_link(len(a), sketches[0], len(b), sketches[1])


def test_rounds_read_only_keys_of_holders_in_different_components(spark, monkeypatch):
    """Keys whose holders are joined already stay so; a round that reads them again shuffles them for nothing."""
    closed = []
    plain = J._crossing_pairs

    def checked(runs, parts, info, search):
        placed = runs.join(parts, F.col("entity") == F.col("node"), "left").select(
            "key", F.coalesce("component", "entity").alias("component")
        )
        closed.append(placed.groupBy("key").agg(F.countDistinct("component").alias("n")).where("n = 1").count())
        return plain(runs, parts, info, search)

    monkeypatch.setattr(J, "_crossing_pairs", checked)
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(14))
    copy = " ".join(f"c{i}" for i in range(60))
    texts = [copy] * 3 + [copy + " extra"] + [
        passage + " " + " ".join(f"w{rng.randrange(10**7)}" for _ in range(30)) for _ in range(20)
    ]
    got = result(J.jaccard_components(simple(spark, texts)))
    assert got == expected(list(enumerate(texts)))
    assert closed and not any(closed)
