"""Additive merging of rollup pieces, key lookups against a table, and replay suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.operators.rollups import STAMP, RollupSpec


def merge(spec: RollupSpec, pieces: DataFrame) -> DataFrame:
    """All pieces of a table as one, a row per key."""
    return spec.merged(pieces)


def slice_deltas(spec: RollupSpec, events: DataFrame, slice_column: str, stamp: Column) -> DataFrame:
    """Deltas of many micro-batches in one pass: one row per slice and key, stamped per slice."""
    return spec.aggregate(events, by=[slice_column]).withColumn(STAMP, stamp)


def rows_touched(spec: RollupSpec, table: DataFrame, delta: DataFrame) -> DataFrame:
    """Rows of the table whose key occurs in the delta."""
    return table.join(delta.select(*spec.keys), list(spec.keys), "left_semi")


def drop_replays(events: DataFrame, delivery: Sequence[str] = ("kafka_ts", "processing_time")) -> DataFrame:
    """One row per event: copies agree in all columns but the delivery facts, of which the earliest stay.

    Grouping by all other columns hashes, and copies collapse in the scan tasks before the shuffle.
    """
    own = [c for c in events.columns if c not in delivery]
    kept = [F.min(c).alias(c) for c in events.columns if c in delivery]
    return (events.groupBy(*own).agg(*kept) if kept else events.distinct()).select(*events.columns)
