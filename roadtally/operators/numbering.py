"""Contiguous numbering and total ordering without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORIGIN = "_origin"
# Rows sampled per range, from which the ranges' borders are chosen.
SAMPLED_PER_RANGE = 32
# Rows of one range that a task may sort as they are; beyond it copies of a row are counted first.
ROWS_PER_RANGE = 5_000_000


def total_order(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``order_by``, then all other columns.

    The remaining columns split a hot sort key over many ranges, and the origin partition splits copies of
    one row; both are equal when a task is rerun.
    """
    rest = [c for c in df.columns if c not in order_by]
    order = [*order_by, *rest, _ORIGIN]
    return (
        df.withColumn(_ORIGIN, F.spark_partition_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(_ORIGIN)
    )


def splitters(df: DataFrame, order: Sequence[str], ranges: int) -> list[T.Row]:
    """At most ``ranges`` - 1 different rows, in order, that cut the rows into ranges of about one size.

    They are quantiles of the rows with the smallest hashes, a sample that every execution draws alike; its size depends
    on the number of ranges alone. Columns that hashing does not take cannot be ordered either.
    """
    sample = df.select(*order).orderBy(F.xxhash64(*order)).limit(SAMPLED_PER_RANGE * ranges)
    placed = Window.orderBy(*order)  # over the sample
    ranked = sample.distinct().withColumn("_place", F.percent_rank().over(placed))
    cut = F.floor(F.col("_place") * ranges)
    firsts = ranked.withColumn("_cut", cut).groupBy("_cut").agg(F.min(F.struct(*order)).alias("row")).where("_cut > 0")
    return [r["row"] for r in firsts.orderBy("_cut").collect()]


def range_of(df: DataFrame, order: Sequence[str], bounds: Sequence[T.Row]) -> Column:
    """The number of bounds that a row reaches, found by halving: rows compare with a logarithm of the bounds."""
    row = F.struct(*order)

    def literal(bound: T.Row) -> Column:
        return F.struct(*[F.lit(bound[c]).cast(df.schema[c].dataType).alias(c) for c in order])

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(row < literal(bounds[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(bounds))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "seq",
    ranges: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """0-based contiguous position in the order by ``order_by``, then all other columns.

    Borders of ranges are found once and are literals from then on, so a range holds the same rows whenever it is
    computed; the rows of each are counted exactly, which gives its offset, and are numbered within it. Nothing is stored.
    Equal rows may take each other's numbers. Where a range is too large for a task because a row occurs too often,
    rows are counted before they are moved, and each row's numbers are generated at the end.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*order_by, *[c for c in df.columns if c not in order_by]]
    bounds = splitters(df, order, ranges)
    within = range_of(df, order, bounds).alias("_range")
    sizes = {r["_range"]: r["n"] for r in df.select(within).groupBy("_range").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for i in range(len(bounds) + 1):
        offsets.append(total)
        total += sizes.get(i, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_range") + 1)
    own = Window.partitionBy("_range").orderBy(*order)
    if max(sizes.values(), default=0) <= rows_per_range:
        numbered = df.select("*", within).withColumn(name, offset + F.row_number().over(own) - 1)
        return numbered.select(*df.columns, name)
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies")).select("*", within)
    before = F.coalesce(F.sum("_copies").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = copies.withColumn("_first", offset + before)
    last = F.col("_first") + F.col("_copies") - 1
    # In two steps, so that no array is longer than a range may be.
    blocks = F.explode(F.sequence(F.col("_first"), last, F.lit(rows_per_range).cast("bigint"))).alias("_block")
    placed = placed.select(*df.columns, last.alias("_last"), blocks)
    numbers = F.sequence(F.col("_block"), F.least(F.col("_block") + rows_per_range - 1, F.col("_last")))
    return placed.select(*df.columns, F.explode(numbers).alias(name))
