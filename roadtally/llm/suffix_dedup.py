"""Suffix-array dedup: every byte covered by a string of 50 bytes that also starts in a document with a smaller id goes.

Each 50-byte window of a text belongs to its anchor, the gram inside it with the smallest hash. Equal windows have equal
anchors, so only windows whose anchor occurs in two texts can repeat. The stretches of text that such an anchor owns are
collapsed to distinct ones with their smallest id; where an anchor has several, they are dealt into shards by anchor. Each
shard is one string whose suffix array is built by induced sorting (``induced_sorting``); common prefixes, computed in text
order, bound the groups of equal windows in it, and each group has the smallest id of its members. An occurrence in a
document with a larger id is removed. Spans are judged on the input text, and never cross documents.

Nothing grows with a hot passage: an anchor that several texts of one slice hold is sent on once; equal stretches collapse
before they are dealt; an anchor whose distinct stretches fill a shard is cut into its single windows, which are dealt by
content. Of equal texts only the one with the smallest id is looked at; the others go whole.

Null and empty texts, and those below 50 bytes, keep all they have. A row without an id neither removes nor loses anything.
Rows with equal ids do not remove each other's text; repeated rows get equal results. Other columns are ignored. Anchors are
48 bits of a hash and only choose what is compared; texts and stretches are named by 128 and 112 bits of hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import mix, released, slices, written
from roadtally.llm.induced_sorting import common_prefixes, suffix_array

WINDOW = 50
# Bytes of the grams that anchor a window; a multiple of 8.
GRAM = 24
# Text whose anchors one task compares, text handled at a time, and bytes of a shard that is sorted.
BUCKET_BYTES = 16 << 20
SLICE = 4 << 20
SHARD_BYTES = 2 << 20

_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
# Positions hashed at a time, so that the arrays stay in the processor's cache.
_BLOCK = 1 << 15


def _least_grams(data: bytes) -> np.ndarray:
    """The smallest gram hash inside each window of the bytes, by window start."""
    n = len(data) - WINDOW + 1
    out = np.empty(max(n, 0), np.uint64)
    for low in range(0, n, _BLOCK):
        high = min(n, low + _BLOCK)
        words = np.ndarray((high - low + WINDOW - 8,), "<u8", data, low, (1,))
        grams = len(words) - GRAM + 8
        hashes = words[:grams] * _FACTORS[0]
        for i in range(8, GRAM, 8):
            hashes ^= hashes >> np.uint64(29)
            hashes += words[i : i + grams]
            hashes *= _FACTORS[i // 8 % 4]
        hashes ^= hashes >> np.uint64(32)
        hashes *= _FACTORS[3]
        width, covered = WINDOW - GRAM + 1, 1
        while 2 * covered <= width:
            hashes = np.minimum(hashes[:-covered], hashes[covered:])
            covered *= 2
        rest = width - covered
        out[low:high] = np.minimum(hashes[: len(hashes) - rest], hashes[rest:]) if rest else hashes
    return out


def anchor_runs(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(text, start, length, anchor)`` of the runs of windows with one anchor, in texts that lie end to end in ``data``."""
    least = _least_grams(data)
    sizes = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    begins = np.zeros(len(least) + 1, bool)
    begins[1:-1] = least[1:] != least[:-1]
    begins[offsets[:-1][sizes > 0]] = True
    inside = np.zeros(len(least) + 1, np.int8)
    np.add.at(inside, offsets[:-1][sizes > 0], 1)
    np.add.at(inside, (offsets[:-1] + sizes)[sizes > 0], -1)
    valid = np.cumsum(inside[:-1]).astype(bool)
    starts = np.flatnonzero(begins[:-1] & valid)
    text = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.append(starts[1:], len(least))
    ends = np.minimum(ends, offsets[text] + sizes[text])
    return text, starts - offsets[text], ends - starts, mix(least[starts] ^ _FACTORS[1]) >> np.uint64(16)


def _joined(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    values = [v.as_py() or b"" for v in texts.cast(pa.binary())]
    return b"".join(values), np.append(0, np.cumsum([len(v) for v in values], dtype=np.int64))


def _packed(keys: np.ndarray, anchors: np.ndarray, texts: np.ndarray) -> bytes:
    """Sorted anchors with the index of their text, or -1 where they are known to be shared, and the texts' keys."""
    body = [np.array([len(keys), len(anchors)], np.int64).tobytes(), keys.tobytes(), texts.astype(np.int32).tobytes()]
    planes = np.diff(anchors, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(b"".join([*body, planes.tobytes()]), 1)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    body = zstandard.decompress(blob)
    n_keys, n = np.frombuffer(body, np.int64, 2)
    keys = np.frombuffer(body, np.int64, n_keys, 16)
    texts = np.frombuffer(body, np.int32, n, 16 + 8 * n_keys)
    planes = np.frombuffer(body, np.uint8, 8 * n, 16 + 8 * n_keys + 4 * n).reshape(8, n)
    return keys, np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64), texts


def _anchors(buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per slice and bucket the anchors of the slice; and at once the ones that several of its texts hold, with each text."""

    def run(batches):
        for batch in slices(iter(batches), "text", SLICE):
            keys, rows = np.unique(batch.column("h1").to_numpy(), return_index=True)
            data, offsets = _joined(batch.column("text").take(pa.array(rows)))
            text, _, _, anchor = anchor_runs(data, offsets)
            order = np.lexsort((text, anchor))
            text, anchor = text[order], anchor[order]
            new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))[: len(anchor)]
            text, anchor = text[new], anchor[new]
            first = np.append(True, anchor[1:] != anchor[:-1])[: len(anchor)]
            held = np.diff(np.append(np.flatnonzero(first), len(anchor)))
            several = np.repeat(held > 1, held)
            sent, sender = anchor[first], np.where(held > 1, -1, text[first])
            bucket = (sent * np.uint64(buckets)) >> np.uint64(48)
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
            parts = zip(cuts, np.append(cuts[1:], len(bucket)), strict=True)
            blobs = []
            for a, b in parts:
                used, index = np.unique(sender[a:b], return_inverse=True)
                names = np.where(used >= 0, keys[used], 0)
                blobs.append(_packed(names, sent[a:b], np.where(sender[a:b] < 0, -1, index)))
            yield _out(
                {"bucket": pa.array(bucket[cuts].astype(np.int32)), "data": pa.array(blobs, pa.binary())}, _SENT, len(cuts)
            )
            known = {"h1": pa.array(keys[text[several]]), "anchor": pa.array(anchor[several].astype(np.int64))}
            yield _out(known, _SENT, int(several.sum()))

    return run


_SENT = pa.schema([("bucket", pa.int32()), ("data", pa.binary()), ("h1", pa.int64()), ("anchor", pa.int64())])


def _out(columns: dict, schema: pa.Schema, rows: int) -> pa.RecordBatch:
    arrays = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _shared(group: pa.Table) -> pa.Table:
    """``(h1, anchor)`` of the texts in one bucket whose anchor another slice sent too, or several texts of one slice hold."""
    keys, anchors = [], []
    for blob in group.column("data").to_pylist():
        names, values, texts = _unpacked(blob)
        keys.append(np.where(texts >= 0, names[texts], 0))
        anchors.append(values | (np.uint64(1) << np.uint64(63)) * (texts < 0))
    key, anchor = np.concatenate(keys), np.concatenate(anchors)
    answered, anchor = anchor >> np.uint64(63) == 1, anchor & np.uint64((1 << 63) - 1)
    order = np.lexsort((key, anchor))
    key, anchor, answered = key[order], anchor[order], answered[order]
    starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])[: len(anchor)])
    counts = np.diff(np.append(starts, len(anchor)))
    # copies of one text have one key; an anchor that only they hold is not shared
    shared = np.logical_or.reduceat(answered, starts) | (key[starts] != key[starts + counts - 1])
    wanted = np.repeat(shared, counts) & ~answered
    return pa.table({"h1": key[wanted], "anchor": anchor[wanted].astype(np.int64)})


def _zipped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, for the way through a shuffle."""
    for batch in slices(iter(batches), "text", SLICE):
        at = batch.schema.names.index("text")
        data = pa.array([zstandard.compress(v.as_py() or b"", 3) for v in batch.column(at).cast(pa.binary())], pa.binary())
        yield batch.set_column(at, "text", data)


_RUNS = "anchor long, stretch binary, h1 long, h2 long, doc_id long, at int"


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of each text that its wanted anchors own."""
    for batch in slices(iter(batches), "text", SLICE // 8):
        for low in range(0, batch.num_rows, 1 << 15):  # anchors are 48 bits; the others tell the texts apart
            part = batch.slice(low, 1 << 15)
            texts = [zstandard.decompress(t) for t in part.column("text").to_pylist()]
            data, offsets = b"".join(texts), np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))
            asked = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("wanted")).to_numpy())
            asked = (asked << 48) | part.column("wanted").flatten().to_numpy()
            text, start, length, anchor = anchor_runs(data, offsets)
            kept = np.isin((text << 48) | anchor.astype(np.int64), asked)
            text, start, length, anchor = text[kept], start[kept], length[kept], anchor[kept]
            begins = offsets[text] + start
            ends = begins + length + WINDOW - 1
            stretches = [data[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            of = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.astype(np.int64)),
                    pa.array(stretches, pa.binary()),
                    *[part.column(c).take(of) for c in _NAME],
                    pa.array(start.astype(np.int32)),
                ],
                ["anchor", "stretch", *_NAME, "at"],
            )


_SHARED = "anchor long, tag long, low int, high int, first long"


def _induced(group: pa.Table) -> pa.Table:
    """For each stretch of a shard, runs of window starts with the smallest id among all stretches that hold the window."""
    stretches = group.column("stretch").to_pylist()
    joined = b"".join(stretches)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(s) for s in stretches], np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # Each stretch is followed by a 0, below all bytes; so byte i of the data is symbol i + owner[i] of the string.
    string = np.zeros(len(data) + len(sizes), np.int16)
    string[np.arange(len(data)) + owner] = data.astype(np.int16) + 1
    offset = np.arange(len(data)) - starts[owner]
    windows = np.flatnonzero(offset + WINDOW <= sizes[owner])
    rank = np.full(len(string), -1)
    rank[windows + owner[windows]] = windows
    order = rank[suffix_array(string, 257)]
    order = order[order >= 0]  # windows by content: those that are equal stand next to each other
    before = np.empty(len(data), np.int64)
    before[order[1:]], before[order[0]] = order[:-1], order[0]
    shared = np.empty(len(data), np.int64)
    shared[windows] = common_prefixes(joined, windows, before[windows], WINDOW)
    new = shared[order] < WINDOW
    new[0] = True
    heads = np.flatnonzero(new)
    ids = group.column("first").to_numpy()
    first = np.empty(len(data), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(ids[owner[order]], heads), np.diff(np.append(heads, len(order))))
    new = np.append(True, (first[windows[1:]] != first[windows[:-1]]) | (windows[1:] != windows[:-1] + 1))
    low, high = windows[new], windows[np.append(np.flatnonzero(new)[1:], len(windows)) - 1]
    of = pa.array(owner[low])
    return pa.table(
        {
            "anchor": group.column("anchor").take(of),
            "tag": group.column("tag").take(of),
            "low": offset[low].astype(np.int32),
            "high": offset[high].astype(np.int32),
            "first": first[low],
        }
    )


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the removed spans leave of each text."""
    for batch in slices(iter(batches), "text", SLICE // 8):
        removed, spans, digests = [], [], []
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks"), strict=True):
            data = np.frombuffer(zstandard.decompress(text), np.uint8)
            edges = np.zeros(len(data) + 1, np.int64)
            np.add.at(edges, marks.values.field("start").to_numpy(), 1)
            np.add.at(edges, marks.values.field("stop").to_numpy(), -1)
            gone = np.cumsum(edges[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0]))
            digests.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in _NAME], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)],
            [*_NAME, "n_removed", "n_spans", "kept_sha256"],
        )


_NAME = ["h1", "h2", "doc_id"]


def _single_windows(stretches: DataFrame, at: Column | None = None) -> DataFrame:
    """Stretches cut into their windows, each its own anchor."""
    starts = F.explode(F.sequence(F.lit(0), F.octet_length("stretch") - WINDOW)).alias("_i")
    cut = stretches.select("*", starts).withColumn("stretch", F.expr(f"substring(stretch, _i + 1, {WINDOW})"))
    cut = cut.withColumn("anchor", F.xxhash64("stretch"))
    return (cut if at is None else cut.withColumn("at", at + F.col("_i"))).drop("_i")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row; see the module's text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    long_enough = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW))
    classes = written(
        long_enough.select(*_NAME, F.octet_length("text").cast("long").alias("bytes"))
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first_id"), F.max("bytes").alias("bytes")),
        "classes",
    )
    total = classes.agg(F.sum("bytes")).first()[0] or 0
    marked = _marked(long_enough, classes, total)
    facts = rows.select(*_NAME, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    copy = F.col("first_id") < F.col("doc_id")
    return (
        facts.join(classes.select("h1", "h2", "first_id"), ["h1", "h2"], "left")
        .join(marked, _NAME, "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        )
    )


def _marked(rows: DataFrame, classes: DataFrame, total: int) -> DataFrame:
    """What is left of the texts that are first of their kind and lose something."""
    buckets = math.ceil(total / BUCKET_BYTES) or 1
    ddl = "bucket int, data binary, h1 long, anchor long"
    sent = written(rows.select("h1", "text").mapInArrow(_anchors(buckets), ddl), "anchors")
    pairs = sent.where("data is null").select("h1", "anchor")
    asked = sent.where("data is not null").select("bucket", "data")
    pairs = pairs.unionByName(asked.groupBy("bucket").applyInArrow(_shared, "h1 long, anchor long"))
    wanted = pairs.groupBy("h1").agg(F.collect_set("anchor").alias("wanted")).join(classes, "h1")
    wanted = written(wanted.select("h1", "h2", F.col("first_id").alias("doc_id"), "wanted"), "wanted")
    released(rows.sparkSession, sent)
    packed = rows.select(*_NAME, "text").mapInArrow(_zipped, "h1 long, h2 long, doc_id long, text binary")
    runs = written(packed.join(wanted, _NAME).mapInArrow(_stretches, _RUNS), "runs")
    released(rows.sparkSession, wanted)
    shards = written(runs.groupBy("anchor", "stretch").agg(F.min("doc_id").alias("first")), "stretches")
    released(rows.sparkSession)
    sums = shards.groupBy("anchor").agg(F.sum(F.octet_length("stretch")).alias("bytes"), F.count("*").alias("n"))
    sums = written(sums.where("n > 1").select("anchor", (F.col("bytes") > SHARD_BYTES).alias("full")), "compared")
    full = sums.where("full").select("anchor")
    compared = shards.join(sums.where("not full").select("anchor"), "anchor", "left_semi")
    alone = shards.join(sums.select("anchor"), "anchor", "left_anti")
    if full.limit(1).count():
        cut = _single_windows(shards.join(full, "anchor")).groupBy("anchor", "stretch").agg(F.min("first").alias("first"))
        compared = compared.unionByName(cut)
        cut = _single_windows(runs.join(full, "anchor"), F.col("at"))
        runs = written(runs.join(full, "anchor", "left_anti").unionByName(cut), "runs")
    compared = written(compared.withColumn("tag", F.xxhash64("stretch")), "compared")
    size = compared.agg(F.sum(F.octet_length("stretch"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(math.ceil(size / SHARD_BYTES) or 1)).cast("int").alias("shard")
    found = compared.select(shard, "anchor", "tag", "stretch", "first").groupBy("shard").applyInArrow(_induced, _SHARED)
    # A stretch that is the only one of its anchor has no window in common with another: it needs no array.
    last = (F.octet_length("stretch") - WINDOW).alias("high")
    known = alone.select("anchor", F.xxhash64("stretch").alias("tag"), F.lit(0).alias("low"), last, "first")
    found = written(found.unionByName(known), "shared")
    released(rows.sparkSession, shards, compared)
    occurrences = runs.select("anchor", F.xxhash64("stretch").alias("tag"), *_NAME, "at")
    spans = occurrences.join(found, ["anchor", "tag"]).where("first < doc_id")
    span = F.struct((F.col("at") + F.col("low")).alias("start"), (F.col("at") + F.col("high") + WINDOW).alias("stop"))
    marks = written(spans.groupBy(*_NAME).agg(F.collect_list(span).alias("marks")), "marks")
    released(rows.sparkSession, runs, found)
    left = packed.join(marks, _NAME)
    left = left.mapInArrow(_kept, "h1 long, h2 long, doc_id long, n_removed long, n_spans long, kept_sha256 string")
    out = written(left.dropDuplicates(_NAME), "marked")
    released(rows.sparkSession, marks)
    return out
