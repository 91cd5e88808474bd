from collections import defaultdict

import pytest

from roadtally.llm import mixing as M
from roadtally.llm.queries import op8_mixing
from tests.llm.cases import ROWS, documents, simple


def marginal(rows, dimension):
    out = defaultdict(float)
    for r in rows:
        out[r[dimension]] += r.probability * r.tokens
    return {k: v / sum(out.values()) for k, v in out.items()}


def raked(cells, targets, rounds=200):
    """The plain loop over a dictionary."""
    w = dict(cells)
    for _ in range(rounds):
        for d, target in enumerate(targets):
            sums = defaultdict(float)
            for k, v in w.items():
                sums[k[d]] += v
            w = {k: v * target[k[d]] / sums[k[d]] for k, v in w.items()}
    return w


def test_query_against_plain_raking(spark, sf_dir):
    rows = op8_mixing(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.tokens for r in rows} == {i: len(t.split()) for i, t in texts.items()}
    cells = defaultdict(int)
    for r in rows:
        cells[tuple(r[d] for d in M.DIMENSIONS)] += r.tokens
    cells = {k: v for k, v in cells.items() if v}
    targets = []
    for i, d in enumerate(M.DIMENSIONS):
        sums = defaultdict(float)
        for k, v in cells.items():
            sums[k[i]] += v
        whole = sum(v ** M.TEMPER[d] for v in sums.values())
        targets.append({k: v ** M.TEMPER[d] / whole for k, v in sums.items()})
    w, factor = raked(cells, targets), 0.0
    wanted = M.RATE * sum(cells.values())
    for _ in range(100):
        full = {k for k in cells if cells[k] <= factor * w[k]}
        factor = (wanted - sum(cells[k] for k in full)) / sum(w[k] for k in w if k not in full)
    for r in rows:
        k = tuple(r[d] for d in M.DIMENSIONS)
        expected = min(1.0, factor * w[k] / cells[k]) if k in cells else M.RATE
        assert r.probability == pytest.approx(expected, rel=0.02)
    assert sum(r.probability * r.tokens for r in rows) == pytest.approx(wanted, rel=1e-3)


def test_targets_are_met_and_sampled(spark):
    draw = [("en", "a")] * 5 + [("en", "b")] * 2 + [("de", "a")] * 2 + [("de", "b")]
    rows = [(i, "w " * (5 + i % 9), *draw[i % 10], 0) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    targets = {"lang": {"en": 0.5, "de": 0.5, "xx": 3.0}, "source": {"a": 0.4, "b": 0.6}}
    from pyspark.sql import functions as F

    got = M.sample_to_targets(docs, targets, rate=0.3, topic=F.lit("t")).collect()
    assert marginal(got, "lang") == pytest.approx({"en": 1 / 2, "de": 1 / 2}, abs=1e-3)
    assert marginal(got, "source") == pytest.approx({"a": 0.4, "b": 0.6}, abs=1e-3)
    kept = [r for r in got if r.sampled]
    assert sum(r.tokens for r in kept) == pytest.approx(0.3 * sum(r.tokens for r in got), rel=0.05)
    german = sum(r.tokens for r in kept if r.lang == "de") / sum(r.tokens for r in kept)
    assert german == pytest.approx(0.5, abs=0.03)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = M.sample_to_targets(docs, keep=tuple(docs.columns)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.probability <= 1 for r in rows)
    assert {r.row.doc_id: r.source for r in rows}[3] == M.NONE
    twice = [r.sampled for r in rows if r.row.doc_id == 8]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert M.sample_to_targets(documents(spark, [])).count() == 0
    assert M.sample_to_targets(simple(spark, [None, ""])).count() == 2


def test_plan_is_native(spark, sf_dir):
    plan = op8_mixing(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
