"""Runs against a search over all periods, planted tails, and odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from roadtally.llm import periodic_runs
from roadtally.llm.queries import QUERIES
from tests.llm.cases import documents, simple

SEPARATORS = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in SEPARATORS:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def plain_runs(words, least=24):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b, q) for (a, b), q in found.items())


def plain_row(doc_id, text, planted):
    words = words_of(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = (None,) * 4
    if runs:
        best = None
        for a, b, q in runs:  # in order of start and period
            if best is None or (b - a) * best[2] > best[1] * q:
                best = (a, b - a, q, 1000 * (b - a) // q)
    return (doc_id, n, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least", [3, 6, 24])
def test_runs_equal_plain_search(monkeypatch, least):
    monkeypatch.setattr(periodic_runs, "LEAST_WORDS", least)
    rng = random.Random(least)
    for _ in range(300):
        letters, words = rng.choice([1, 2, 2, 3, 10]), []
        for _ in range(rng.randint(1, 6)):
            block = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
            words += (block * rng.randint(1, 8))[: rng.randint(1, 60)]
        expected = plain_runs(words, least)
        assert periodic_runs.runs_of(words) == expected
        zoned = []
        for a, b in periodic_runs.zones(np.array(words)):
            zoned += [(a + s, a + e, q) for s, e, q in periodic_runs.runs_of(words[a:b])]
        assert zoned == expected


def test_grammar_spells_the_words_and_shares_blocks():
    block = list(range(500))
    grammar = periodic_runs.Grammar(block * 16)

    def spelled(symbol):
        return sum((spelled(half) for half in grammar.rules[symbol]), []) if symbol in grammar.rules else [symbol]

    assert spelled(grammar.sequence[0]) == block * 16
    assert len(grammar.rules) < 1000
    places = grammar.places(grammar.rules)
    for symbol, at in places.items():
        for p in at:
            assert (block * 16)[p : p + grammar.length[symbol]] == spelled(symbol)


def test_query_equals_plain_rows(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(QUERIES["op13_periodic_runs"](spark, sf_dir))
    assert got == sorted((plain_row(i, t, True) for i, t in docs), key=repr)
    assert sum(r[2] for r in got) > 5


def test_odd_rows(spark):
    docs = documents(spark)
    expected = sorted((plain_row(r["doc_id"], r["text"], False) for r in docs.collect()), key=repr)
    assert rows(periodic_runs.periodic_runs(docs)) == expected


def test_long_monotonous_text_and_ties(spark):
    texts = ["a " * 30_000, "x y " * 20 + "end " + "x y " * 20, "one two three " * 8, None, ""]
    got = rows(periodic_runs.periodic_runs(simple(spark, texts)))
    assert got[0][:7] == (0, 30_000, 1, 0, 30_000, 1, 30_000_000)
    assert got[1][2:7] == (2, 0, 40, 2, 20_000)
    assert got[2][2:7] == (1, 0, 24, 3, 8000)
    assert got[3][1:7] == got[4][1:7] == (0, 0, None, None, None, None)


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(documents(spark, []), planted=True).collect() == []
