"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.session import scratch_path

# A side is broadcast only when Catalyst's size estimate is at most this many bytes.
BROADCAST_BYTES = 10 * 1024 * 1024
# Rows of one heavy key that one join cell may hold.
ROWS_PER_CELL = 1_000_000


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, or None where the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def heavy_keys(df: DataFrame, key: str, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``(key, cells)`` of every key with more rows than one join cell may hold, counted exactly.

    Only the key column is read; counts are summed in the scan tasks before the shuffle. There are at most
    rows / ``rows_per_cell`` such keys.
    """
    counts = df.select(key).where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > rows_per_cell).select(
        key, F.ceil(F.col("n") / rows_per_cell).cast("int").alias("cells")
    )


def _cells(df: DataFrame, key: str, heavy: DataFrame, own: str, other: str, spread_by: Sequence[str]) -> DataFrame:
    """Give every row one own cell number and a copy per cell of the other side.

    The own cell comes from the partition number and row content, both the same when a task is rerun, so a lost
    executor cannot move rows between cells; copies of one row spread because their partitions differ.
    """
    content = [F.col(c) for c in spread_by]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.coalesce(F.col(f"{own}_cells"), F.lit(1)))
    return (
        df.where(F.col(key).isNotNull())
        .join(heavy, key, "left")
        .withColumn(f"{own}_cell", spread.cast("int"))
        .withColumn(f"{other}_cell", F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}_cells", F.lit(1)) - 1)))
        .drop("left_cells", "right_cells")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    rows_per_cell: int = ROWS_PER_CELL,
    spread_left: Sequence[str] | None = None,
    spread_right: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join on ``key`` with bag semantics; a heavy key is spread over a grid of join cells.

    A key with ``l`` left and ``r`` right rows gets ``ceil(l/R) x ceil(r/R)`` cells, each a different hash
    partition key. Every pair meets in exactly one cell, and the copies made are at most ``1/R`` of the output.
    ``spread_*`` name the columns that help choosing a cell (default all; fewer let the scan read less).
    """
    path = scratch_path(left.sparkSession, "heavy-keys")
    (
        heavy_keys(left, key, rows_per_cell)
        .withColumnRenamed("cells", "left_cells")
        .join(heavy_keys(right, key, rows_per_cell).withColumnRenamed("cells", "right_cells"), key, "full")
        .write.parquet(path)
    )
    # A written table has a known size, so Catalyst broadcasts it only where it is small.
    heavy = left.sparkSession.read.parquet(path)
    cells = ["left_cell", "right_cell"]
    left_rows = _cells(left, key, heavy, "left", "right", left.columns if spread_left is None else spread_left)
    right_rows = _cells(right, key, heavy, "right", "left", right.columns if spread_right is None else spread_right)
    return left_rows.join(right_rows, [key, *cells]).drop(*cells)


def lookup_join(facts: DataFrame, dimension: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join to a dimension: broadcast behind a size check, otherwise the salted join."""
    if fits_broadcast(dimension, limit):
        return facts.join(F.broadcast(dimension), key)
    return salted_join(facts, dimension, key, spread_left=(), spread_right=())


def counted_rows(rows: DataFrame, key: str) -> DataFrame:
    """Distinct rows with a key, and how often each occurs (``n``)."""
    return rows.where(F.col(key).isNotNull()).groupBy(*rows.columns).agg(F.count("*").alias("n"))


def join_pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counted rows joined on ``key``: multiplicities multiply. Returns both sides' other columns and ``n``."""
    other = right.withColumnRenamed("n", "_other_n")
    return left.join(other, key).withColumn("n", F.col("n") * F.col("_other_n")).drop("_other_n", key)


def joined_rows(children: DataFrame, parents: DataFrame, key: str, hint: str | None = None) -> DataFrame:
    """The bag join as distinct pairs of rows with a count ``n``.

    Both sides collapse to distinct rows with a count first (map-side, so a hot key or a mass of copies
    shrinks before any shuffle).
    """
    sides = [counted_rows(side, key) for side in (children, parents)]
    return join_pairs(*(side.hint(hint) if hint else side for side in sides), key)


def join_counts(children: DataFrame, parents: DataFrame, key: str, hint: str | None = None) -> DataFrame:
    """Group counts of the bag join ``children x parents`` without forming its pairs: the non-key columns and ``n``."""
    columns = [c for c in (*children.columns, *parents.columns) if c != key]
    return joined_rows(children, parents, key, hint).groupBy(*columns).agg(F.sum("n").alias("n"))
