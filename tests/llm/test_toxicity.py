from zlib import crc32

import pytest

from roadtally.llm import toxicity as T
from roadtally.llm.queries import op1_toxicity
from tests.llm.cases import LONG, ROWS, documents, simple

BAD = T.Lexicon({" idiot ": 5.0, " vequ": 4.0, " trash ": 3.0}, [" trash can "], cut=0.1)


def load(text, lexicon=BAD):
    return T.load_of(T.folded(text, T.Folding()), lexicon.automaton())


@pytest.mark.parametrize("text", ["IDIOT!", "1d10t", "іdіоt", "ídíöt.", "i​d­iot", "ＩＤＩＯＴ"])
def test_folding_catches_disguises(text):
    assert load(text) == (5.0 / 21, 1)


def test_matches_are_word_starts_outside_exceptions():
    assert load("antiidiot idiots")[1] == 0
    assert load("vequmo Vequ vequ vequ")[1] == 4
    assert load("a trash can, trash")[1] == 1
    assert load("")[0] == load(None)[0] == load("... 12 !")[0] == 0
    assert load("idiot " + LONG)[0] < 0.001 < load("idiot")[0]


def test_learned_from_labels(spark):
    """Toxic words are planted; one of them is harmless within a phrase."""
    clean, toxic = [f"sun moon star{i} paper bin{i}" for i in range(300)], [f"sun star{i} zorky bin" for i in range(100)]
    texts = clean + toxic + ["moon zorky cat box"] * 40
    docs = simple(spark, texts)
    labels = spark.createDataFrame([(i, int(300 <= i < 400)) for i in range(len(texts))] + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = T.fit(docs, labels)
    assert " zorky " in lexicon.terms and not any("star" in t or "sun" in t for t in lexicon.terms)
    rows = T.score_toxicity(docs, lexicon, ["doc_id"]).select("row.doc_id", "predicted").collect()
    assert {r.doc_id for r in rows if r.predicted} == set(range(300, 400))


def test_odd_rows_and_no_labels(spark):
    docs = documents(spark)
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (empty, spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, toxic int")):
        lexicon = T.fit(docs, labels)
        assert not lexicon.terms
        assert [r.score for r in T.score_toxicity(docs, lexicon, ["doc_id"]).collect()] == [0.0] * len(ROWS)
    kept = T.score_toxicity(docs, BAD, docs.columns).select("row.*")
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert T.score_toxicity(documents(spark, []), BAD, ["doc_id"]).count() == 0


def test_query_on_held_out_labels(spark):
    """Precision and recall on the quarter of the labels that nothing was learned from."""
    sf_dir = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in op1_toxicity(spark, sf_dir).collect()}
    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    assert all(r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if rows[r.doc_id].held_out]
    caught = sum(rows[i].predicted for i, toxic in labels if toxic)
    wrong = sum(rows[i].predicted for i, toxic in labels if not toxic)
    assert caught > 0.9 * sum(t for _, t in labels) and wrong < 0.02 * len(labels)
