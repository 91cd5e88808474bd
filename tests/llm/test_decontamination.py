"""Positional index and windows against a scan of every position."""

import hashlib
import re
from collections import defaultdict

from roadtally.llm import decontamination as D
from roadtally.llm.queries import op5_decontamination
from tests.llm.cases import ASCII_LOWER, LONG, ROWS, WORDS, documents, simple


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def expected(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[i : i + 10])].add(item)
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if (key := tuple(own[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        named = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc_id, len(own), len(hit), len(found), hashlib.sha256(named.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.drop("text_hash").collect()), key=repr)


def test_query_against_scan(spark, sf_dir):
    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(c, "text").collect()]
        for t, c in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    got = result(op5_decontamination(spark, sf_dir))
    assert got == expected(docs, items)
    assert any(r[5] for r in got)


def test_odd_rows(spark):
    items = [
        (1, None), (2, ""), (3, "..."), (4, "ONE two"), (5, "text"), (6, " ".join(WORDS.split()[10:21])),
        (6, "odd characters"), (7, " ".join(WORDS.split()[25:40])), (8, "a a a a a a a a a a a"), (9, LONG[:3000]),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r[0], r[1]) for r in ROWS] + [(20, "a " * 12), (21, "a " * 9), (22, "x word10 " + WORDS)]
    docs = documents(spark).select("doc_id", "text").union(spark.createDataFrame(rows[len(ROWS) :], "doc_id long, text string"))
    assert result(D.contamination(docs, benchmark)) == expected(rows, items)


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, WORDS)], "item_id long, text string")
    assert D.contamination(documents(spark, []), benchmark).count() == 0
    assert not any(r.contaminated for r in D.contamination(documents(spark), benchmark.where("false")).collect())


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = simple(spark, [item, "alpha x beta gamma", "alpha " + "x " * 30 + "beta", "nothing"])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = D.proximity_matches(D.build_index(docs, benchmark), slop=3).select("doc_id").distinct().collect()
    assert {r.doc_id for r in found} >= {0} and 2 not in {r.doc_id for r in found} and 3 not in {r.doc_id for r in found}


def test_plan_is_native(spark, sf_dir):
    plan = op5_decontamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
