"""Helpers shared by the text operators: written tables, Arrow slices, word and shingle hashes, ASCII folding."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Text handled at a time inside a task; bounds what numpy holds beside the Arrow batch.
SLICE_BYTES = 1 << 20

_ODD_1 = np.uint64(0x9E3779B97F4A7C15)
_ODD_2 = np.uint64(0xBF58476D1CE4E5B9)
_ODD_3 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, and still there if an executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def deleted(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again: everything made from them must be written itself."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables, as ``deleted``, and the files of the shuffles behind them.

    The collection lets Spark's cleaner see that the shuffles behind them are unreachable and delete their files too.
    """
    deleted(*tables)
    gc.collect()
    spark._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; plain ASCII takes the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that one text column, or field of a struct column, holds about ``limit`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        name, _, field = column.partition(".")
        texts = batch.column(name).field(field) if field else batch.column(name)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])
        pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _ODD_2
    x = x ^ (x >> np.uint64(27))
    x = x * _ODD_3
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and the offsets of each text's words.

    A word is a run of characters other than space and U+0009 to U+000D, with A-Z lower-cased. Null has none.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = words.dictionary_encode()
    hashed = np.fromiter(
        (xxhash.xxh3_64_intdigest(w.as_py()) for w in coded.dictionary), np.uint64, len(coded.dictionary)
    )
    codes = coded.indices.to_numpy(zero_copy_only=False)
    values = hashed[codes] if len(codes) else np.empty(0, np.uint64)
    kept = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0 if len(words) else np.empty(0, bool)
    before = np.concatenate(([0], np.cumsum(kept, dtype=np.int64)))
    return values[kept], before[offsets]


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """One 64-bit hash for every run of ``length`` consecutive words (runs may cross texts; callers cut them)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for i in range(1, length):
        out *= _ODD_1
        out += words[i : i + n]
    return mix(out)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles of one text in order; fewer words than ``width`` count as one shingle."""
    return run_hashes(words, min(width, len(words))) if len(words) else np.empty(0, np.uint64)


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
