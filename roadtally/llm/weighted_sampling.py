"""Document fingerprints by consistent weighted sampling.

A text's terms are its five-word shingles, each weighted by its count. For every sample a term with weight w draws
r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash, sets t = floor(ln w / r + b) and ln a = ln c - r (t - b + 1); the sample is
the term with the smallest a together with t. Two texts agree in a sample with a probability equal to their generalised
Jaccard similarity, the sum of the smaller over the sum of the larger weights. The draws of a term are rows of three
fixed random tables, chosen by three parts of its hash, so that no draw needs to be made again.

A fingerprint keeps 16 bits of each of ``SAMPLES`` samples, in hex; the likeness of two is their share of equal samples. Null texts
count as empty; an empty text, or one of white space, has an empty fingerprint, like only other empty ones. Texts
of fewer than five words are one term. Repeated rows are neighbours of each other in the order of ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import mix, shingle_hashes, slices, word_hashes, written

WIDTH = 5
SAMPLES = 64
TABLE_BITS = 13
SEED = 20_240_117
BLOCK = 2048

_PARTS = (
    "role string, part int, doc_id long, text string, n_chars long, edited_sha256 string, fingerprint binary,"
    " edited_fingerprint binary, near_edited double, near_next double"
)
_NAMES = [x.split()[0] for x in _PARTS.split(", ")]


class Sampler:
    """The random tables, and signatures from them."""

    def __init__(self, samples: int = SAMPLES, seed: int = SEED):
        draw = np.random.Generator(np.random.PCG64(seed))
        shape = (1 << TABLE_BITS, samples)
        self.r = draw.gamma(2.0, 1.0, shape).astype(np.float32)
        self.ln_c = np.log(draw.gamma(2.0, 1.0, shape)).astype(np.float32)
        self.b = draw.random(shape).astype(np.float32)
        self.samples = samples

    def signature(self, terms: np.ndarray, weights: np.ndarray) -> bytes:
        """Of distinct 64-bit terms and their weights above 0; empty without terms."""
        if not len(terms):
            return b""
        low = np.uint64((1 << TABLE_BITS) - 1)
        rows = [((terms >> np.uint64(TABLE_BITS * i)) & low).astype(np.int64) for i in range(3)]
        ln_w = np.log(weights.astype(np.float32))
        best = np.full(self.samples, np.inf, np.float32)
        term, level = np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.int64)
        column = np.arange(self.samples)
        for at in range(0, len(terms), BLOCK):
            part = slice(at, at + BLOCK)
            r, b = self.r[rows[0][part]], self.b[rows[2][part]]
            t = np.zeros(r.shape, np.float32)
            heavy = np.flatnonzero(ln_w[part])  # a weight of 1 has t = 0
            if len(heavy):
                t[heavy] = np.floor(ln_w[part][heavy, None] / r[heavy] + b[heavy])
            np.subtract(b, t, out=b)
            b -= 1
            b *= r
            b += self.ln_c[rows[1][part]]
            least = b.argmin(axis=0)
            value = b[least, column]
            better = value < best
            best[better] = value[better]
            term[better] = terms[part][least[better]]
            level[better] = t[least, column][better].astype(np.int64)
        return (mix(term + mix(level.view(np.uint64) + np.uint64(1))) & np.uint64(0xFFFF)).astype(">u2").tobytes()

    def of_texts(self, texts: list[str]) -> list[bytes]:
        words, offsets = word_hashes(pa.array(texts, pa.string()))
        out = []
        for i in range(len(texts)):
            terms = shingle_hashes(words[offsets[i] : offsets[i + 1]], WIDTH)
            out.append(self.signature(*np.unique(terms, return_counts=True)))
        return out


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal samples."""
    if not a or not b:
        return float(a == b)
    x, y = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    return float(np.count_nonzero(x == y)) / len(x)


def edited(text: str, following: str) -> str:
    """The last third (rounded down) replaced by as many first code points of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _finished(doc_id, text, fingerprint, other, following_fingerprint, changed, changed_fingerprint) -> tuple:
    return (
        "row", None, doc_id, None, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint,
        changed_fingerprint, likeness(fingerprint, changed_fingerprint), likeness(fingerprint, following_fingerprint),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [
        pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(),
        pa.float64(), pa.float64(),
    ]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order: results for all but the last, and the first and the last for the range's neighbours."""
    sampler, held, part = Sampler(), None, None
    for batch in slices(batches, "text"):
        part = batch.column("part")[0].as_py()
        ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        before = [held] if held else []
        chain = [t for _, t, _ in before] + texts
        changed = [edited(a, b) for a, b in zip(chain, chain[1:], strict=False)]
        prints = sampler.of_texts(texts + changed)
        own, of_changed = prints[: len(texts)], prints[len(texts) :]
        chain = before + list(zip(ids, texts, own, strict=True))
        rows = [
            _finished(*chain[i], chain[i + 1], chain[i + 1][2], changed[i], of_changed[i]) for i in range(len(chain) - 1)
        ]
        if not before:
            rows.append(("head", part, ids[0], texts[0], None, None, own[0], None, None, None))
        held = chain[-1]
        yield _batch(rows)
    if held:
        yield _batch([("last", part, held[0], held[1], None, None, held[2], None, None, None)])


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sampler = Sampler()
    for batch in batches:
        rows = []
        for x in batch.to_pylist():
            changed = edited(x["text"], x["next_text"])
            (print_,) = sampler.of_texts([changed])
            rows.append(_finished(x["doc_id"], x["text"], x["fingerprint"], None, x["next_fingerprint"], changed, print_))
        yield _batch(rows)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs(doc_id, text)``, of its edited text, and their likeness.

    The next document is the one with the next smaller id, after the last the first. Rows are range-partitioned by id and
    streamed in order with one row of look-ahead, so a text moves once; only the first and last row of each range, two per
    partition, are joined with their neighbours. Equal ids follow in the order of a hash of their text.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.desc("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions(F.desc("doc_id"), F.xxhash64("text"))
        .withColumn("part", F.spark_partition_id())
    )
    parts = written(ordered.mapInArrow(_in_order, _PARTS), "fingerprints")
    heads = parts.where("role = 'head'")
    # One narrow row per partition.
    order = Window.orderBy("part")
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select("part").select(
        "part", F.coalesce(F.lead("part").over(order), F.first("part").over(everything)).alias("next_part")
    )
    next_heads = heads.select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    ends = (
        parts.where("role = 'last'")
        .select("part", "doc_id", "text", "fingerprint")
        .join(following, "part")
        .join(next_heads, "next_part")
        .mapInArrow(_across, _PARTS)
    )
    shown = lambda c: F.lower(F.hex(F.coalesce(c, F.lit(b"")))).alias(c)
    return parts.where("role = 'row'").unionByName(ends).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown("fingerprint"),
        shown("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
