"""Histogram sort: shards of near equal bytes, found by counting below candidate boundaries, then one exchange.

Rows are ordered by a hash of their text and by id, so equal texts stand together and the order is otherwise random. For
each boundary the exact bytes below a few candidate keys are counted in one pass over the narrow key table; the interval that
holds the wanted byte count shrinks to the smallest and largest key seen in it and is probed again, until a candidate
is within tolerance or only one key is left. Only counts per interval reach the driver: pieces times ``PROBES``.

A shard is a run of pieces of about ``ROWS_PER_PIECE`` rows, so that one task never sorts a whole shard; the rows move once, to
their piece, and a row's slot is its place in the piece plus the rows of the shard's earlier pieces.

Null texts have no bytes and stand together; every row has 8 bytes beside its text. Rows with equal id and text are not
told apart by the order and stay in one piece. Fewer rows than shards leave shards empty. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import written

ROW_BYTES = 8
ROWS_PER_PIECE = 100_000
# Candidates per boundary and round; tolerances as shares of a shard and of a piece.
PROBES = 15
SHARD_TOLERANCE, PIECE_TOLERANCE = 0.0005, 0.02
_HALF = 1 << 63


def packed(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Keys as 16 bytes that compare like ``(hash, id)``."""
    flip = np.uint64(_HALF)
    both = np.stack([hashes.astype(np.int64).view(np.uint64) ^ flip, ids.astype(np.int64).view(np.uint64) ^ flip], axis=1)
    return np.ascontiguousarray(both.astype(">u8")).view("S16").ravel()


def _bytes(key: int) -> bytes:
    return key.to_bytes(16, "big")


def _probe_array(keys: list[int]) -> np.ndarray:
    return np.frombuffer(b"".join(map(_bytes, keys)), "S16") if keys else np.empty(0, "S16")


def histogram(keys: DataFrame, probes: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Of ``keys(hash, id, size)``: bytes, rows, smallest and largest key between neighbouring sorted probes."""
    at = _probe_array(probes)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids, sizes = (c.to_numpy() for c in batch.columns)
            if not len(hashes):
                continue
            key = packed(hashes, ids)
            order = np.argsort(key)
            key, sizes = key[order], sizes[order]
            between = np.searchsorted(at, key, side="right")
            first = np.flatnonzero(np.append(True, between[1:] != between[:-1]))
            end = np.append(first[1:], len(key))
            low, high = (key[x].tobytes() for x in (first, end - 1))
            cut = lambda b: [b[i : i + 16] for i in range(0, len(b), 16)]
            yield pa.RecordBatch.from_pydict(
                {
                    "between": between[first],
                    "bytes": np.add.reduceat(sizes, first),
                    "n": end - first,
                    "low": cut(low),
                    "high": cut(high),
                }
            )

    rows = (
        keys.select("hash", "id", "size")
        .mapInArrow(counted, "between long, bytes long, n long, low binary, high binary")
        .groupBy("between")
        .agg(F.sum("bytes"), F.sum("n"), F.min("low"), F.max("high"))
        .collect()
    )
    return {r[0]: (r[1], r[2], int.from_bytes(r[3], "big"), int.from_bytes(r[4], "big")) for r in rows}


def splitters(keys: DataFrame, shards: int, rows_per_piece: int = ROWS_PER_PIECE) -> tuple[list[int], int]:
    """Boundary keys of all pieces, and the number of pieces per shard; a row is at or above its piece's lower boundary."""
    whole = histogram(keys, []).get(0)
    if whole is None:
        return [], 1
    total, rows, low, high = whole
    per_shard = max(1, -(-rows // (shards * rows_per_piece)))
    pieces = shards * per_shard
    # Per boundary: lower key and bytes below it, upper key and bytes below it.
    state = {i: (low, 0, high + 1, total) for i in range(1, pieces)}
    done: dict[int, int] = {}
    while state:
        for i in list(state):
            lo, below_lo, hi, below_hi = state[i]
            wanted = total * i / pieces
            near, key = min((abs(below_lo - wanted), lo), (abs(below_hi - wanted), hi))
            share = SHARD_TOLERANCE / shards if i % per_shard == 0 else PIECE_TOLERANCE / pieces
            if near <= share * total or hi - lo <= 1:
                done[i] = key
                del state[i]
        probes = sorted({lo + (hi - lo) * j // (PROBES + 1) for lo, _, hi, _ in state.values() for j in range(PROBES + 2)})
        if not probes:
            break
        seen = histogram(keys, probes)
        below = [0, *accumulate(seen.get(b, (0,))[0] for b in range(len(probes) + 1))]
        for i in state:
            wanted = total * i / pieces
            # below[b] is the number of bytes in the intervals before b; interval b lies below probe b.
            b = bisect_right(below, wanted) - 1
            _, _, low, high = seen[b]
            state[i] = (low, below[b], high + 1, below[b + 1]) if low < high else _single(low, below[b], below[b + 1], wanted)
    return [done[i] for i in sorted(done)], per_shard


def _single(key: int, below: int, after: int, wanted: float) -> tuple[int, int, int, int]:
    """One key is left: the boundary goes before or behind it."""
    return (key, below, key, below) if wanted - below <= after - wanted else (key + 1, after, key + 1, after)


def shard_rows(docs: DataFrame, shards: int, keep: Iterable[str], rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """``(row, size, text_crc32, shard, slot)`` for every row of ``docs``; ``row`` holds the columns ``keep``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.xxhash64("text").alias("hash"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-_HALF)).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    keys = written(rows.select("hash", "id", "size"), "keys")
    bounds, per_shard = splitters(keys, shards, rows_per_piece)
    at = _probe_array(bounds)

    @F.pandas_udf("int")
    def piece_of(hashes: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(at, packed(hashes.to_numpy(), ids.to_numpy()), side="right").astype(np.int32))

    placed = rows.withColumn("piece", piece_of("hash", "id"))
    placed = placed.withColumn("place", F.row_number().over(Window.partitionBy("piece").orderBy("hash", "id")))
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        keys.select(piece_of("hash", "id").alias("piece"))
        .groupBy("piece")
        .count()
        .withColumn("shard", F.floor(F.col("piece") / per_shard).cast("int"))
        .select("piece", "shard", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    )
    # A row per piece, so the broadcast is bounded by the number of pieces.
    return placed.join(F.broadcast(sizes), "piece").select(
        "row", "size", "text_crc32", "shard", (F.col("before") + F.col("place") - 1).alias("slot")
    )
