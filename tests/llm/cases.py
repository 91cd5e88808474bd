"""Odd and ordinary rows that every text operator meets, and plain references for results."""

from __future__ import annotations

import re
from collections import defaultdict

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"lang{i % 977} Größe{i}" for i in range(15_000))

# doc_id, text, lang, source, n_chars and columns whose names clash with results of the operators.
ROWS = [
    (1, None, "en", "src0", 0),
    (2, "", "en", "src0", 0),
    (3, " \t\n ", "en", None, 4),
    (4, WORDS, "en", "src0", 1),
    (5, WORDS, "de", "src1", 1),
    (6, WORDS.replace("word30", "WORD30"), "en", "src1", 1),
    (7, WORDS.replace("word30", "other"), None, "src1", 1),
    (8, "one two", "en", "src2", 1),
    (8, "one two", "en", "src2", 1),
    (None, "a text without an id", "en", "src2", 1),
    (9, LONG, "de", "src0", 1),
    (10, LONG + " end", "de", "src0", 1),
    (11, "\x00\x0b\x1c odd   characters \U0001f600 ÀÉ", "fr", "src0", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "row", "score", "key", "entity", "shard", "hash", "size", "words", "probability", "position", "n", "term", "part"


def documents(spark, rows=None):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    return docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


def simple(spark, texts):
    """Documents numbered from 0."""
    return spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in enumerate(texts)], SCHEMA)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def components(sets):
    """Smallest id reachable by links, per position of ``[(id, set)]``."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, (_, a) in enumerate(sets):
        for j in {j for x in a for j in holders[x] if j < i}:
            b = sets[j][1]
            common = len(a & b)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    smallest = defaultdict(list)
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            smallest[find(i)].append(doc_id)
    return [min(smallest[find(i)], default=None) for i in range(len(sets))]
