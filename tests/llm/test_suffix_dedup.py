"""Suffix arrays against sorting, and removed bytes against a set of all 50-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from roadtally.llm import induced_sorting, suffix_dedup
from roadtally.llm.queries import QUERIES
from tests.llm.cases import LONG, WORDS, documents, simple


def plain(rows):
    """Expected ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of ``[(doc_id, text)]``."""
    starts = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49) if doc_id is not None else ():
            key = data[i : i + 50]
            starts[key] = min(starts.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49) if doc_id is not None else ():
            if starts[data[i : i + 50]] < doc_id:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def compared(spark, texts):
    expected = plain(list(enumerate(texts)))
    assert rows(suffix_dedup.remove_repeats(simple(spark, texts))) == expected
    return expected


@pytest.mark.parametrize("alphabet", [1, 3, 1024])
def test_suffix_arrays_equal_sorting(monkeypatch, alphabet):
    monkeypatch.setattr(induced_sorting, "ALPHABET", alphabet)
    rng = random.Random(alphabet)
    for i in range(600):
        letters = rng.choice([1, 2, 3, 5, 20])
        s = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            s = s[: rng.randint(1, 8)] * 8
        order = induced_sorting.suffix_array(np.array(s, np.int16), 20)
        assert order.tolist() == sorted(range(len(s)), key=lambda k: s[k:])


def test_common_prefixes():
    rng = random.Random(5)
    data = bytes(rng.choice(b"ab") for _ in range(500)) * 2
    places, before = np.arange(900), np.array([rng.randrange(900) for _ in range(900)])
    got = induced_sorting.common_prefixes(data, places, before, 50)
    for i, j, n in zip(places, before, got, strict=True):
        equal = next((k for k in range(50) if data[i + k] != data[j + k]), 50)
        assert n == equal


def test_long_runs_of_one_symbol_are_laid_out_at_once():
    s = np.concatenate((np.full(300_000, 3), [1, 2], np.full(300_000, 3), [4]))
    order = induced_sorting.suffix_array(s.astype(np.int16), 5)
    assert order[0] == 300_000 and order[-1] == len(s) - 1 and sorted(order) == list(range(len(s)))


def test_query_equals_plain(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain(docs)
    assert rows(QUERIES["op12_suffix_dedup"](spark, sf_dir)) == expected
    assert sum(r[2] for r in expected) > 10_000


def test_odd_rows(spark):
    docs = documents(spark)
    assert rows(suffix_dedup.remove_repeats(docs)) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_windows_at_edges_overlaps_and_multibyte_characters(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    base = " ".join(word() for _ in range(40))
    accents = "é" * 60 + "ü" * 30
    texts = [
        base,
        base[10:59],  # 49 bytes: too short to repeat
        base[10:60],
        "x" + base[100:160] + "y" + base[130:200],
        base[50:] + base[:50],
        base[0:80] + base[60:140],
        accents,
        "è" + accents[1:],
        "z" * 49,
        "z" * 50,
        "z" * 300,
        "y" * 120 + "z" * 120,
        base,
    ]
    expected = compared(spark, texts)
    assert [r[2] for r in expected if r[0] in (1, 2, 12)] == [0, len(base), 50]  # in the order of their digits


def test_a_frequent_anchor_in_many_contexts_is_cut_into_windows(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1500)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    phrase = "this phrase stands in all the texts"
    texts = []
    for i in range(80):
        left, right = (" ".join(word() for _ in range(20)) for _ in range(2))
        if i % 4 == 3:  # part of the context of the text before it as well
            right = texts[-1].split(phrase)[1][:25] + right
        texts.append(left + phrase + right)
    assert sum(r[2] for r in compared(spark, texts)) > 500


def test_many_copies_and_a_shared_passage(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(suffix_dedup, "SLICE", 4000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 6000)
    passage = " ".join(f"{rng.randrange(10**6)}" for _ in range(30))
    texts = [" ".join(f"{rng.randrange(10**7)}" for _ in range(30)) for _ in range(60)]
    texts = [t[: i * 3] + passage[i : i + 120] + t[i * 3 :] for i, t in enumerate(texts)]
    texts += [texts[0]] * 40 + [texts[5] + " end"] * 20
    compared(spark, texts)


def test_equal_ids_and_missing_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    base, other = WORDS, LONG[:400]
    data = [(1, base), (1, base), (2, base), (2, other), (None, base), (None, base), (3, other + base), (3, other)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in data], schema)
    assert rows(suffix_dedup.remove_repeats(docs)) == plain(data)


def test_empty_tables(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).collect() == []
    assert len(suffix_dedup.remove_repeats(simple(spark, [None, "", "short"])).collect()) == 3
