"""Composite outputs: the snapshot document, the batch recompute and the choice of batch or stream tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.operators.merge import drop_replays
from roadtally.operators.reports import (
    SNAPSHOT_CELLS,
    SNAPSHOT_WEATHER,
    TOP_ROWS,
    drivers_by_age_band,
    latest,
    render,
    top_districts,
    top_weather,
    totals,
)
from roadtally.operators.rollups import CONDITIONS, GEO, HOTSPOTS, PROFILE, ROLLUPS, STAMP, RollupSpec


def snapshot_parts(geo: DataFrame, pieces: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The result sets of one snapshot, over tables pinned to one state.

    Only the newest cells need the merged ``geo`` table. All other parts are sums, which come out the same over
    unmerged ``pieces`` and so skip the shuffle of the merge.
    """
    cells = latest(geo, list(GEO.keys), SNAPSHOT_CELLS)
    return {
        "stats": totals(pieces[GEO.name], with_update=True),
        "recent_geo": cells.select("event_date", "lat_grid", "lon_grid", "accident_count", "fatal_count", STAMP),
        "top_districts": top_districts(pieces[HOTSPOTS.name], TOP_ROWS),
        "top_weather": top_weather(pieces[CONDITIONS.name], SNAPSHOT_WEATHER).withColumnRenamed(
            "weather_conditions", "weather"
        ),
        "age_bands": drivers_by_age_band(pieces[PROFILE.name], limit=None),
    }


def _listed(part: DataFrame, order: list[Column], columns: list[str] | None = None) -> Column:
    """A bounded result set as one array value, in report order."""
    shown = render(part)
    row = F.struct(*order, F.struct(*(columns or shown.columns)).alias("row"))
    return shown.agg(F.transform(F.sort_array(F.collect_list(row)), lambda r: r["row"])).scalar()


def snapshot(geo: DataFrame, pieces: Mapping[str, DataFrame], taken_at: Column | None = None) -> DataFrame:
    """One row with the whole snapshot as a JSON document."""
    parts = snapshot_parts(geo, pieces)
    taken_at = F.current_timestamp() if taken_at is None else taken_at
    cells = parts["recent_geo"].withColumn("age", -F.unix_micros(F.col(STAMP).cast("timestamp"))).drop(STAMP)
    shown_cells = [c for c in cells.columns if c != "age"]
    document = F.struct(
        F.lit("snapshot").alias("type"),
        F.date_format(taken_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        render(parts["stats"]).select(F.struct("*")).scalar().alias("stats"),
        _listed(cells, [F.col("age"), *GEO.keys], shown_cells).alias("recent_geo"),
        _listed(parts["top_districts"], [-F.col("weighted"), F.col("district")]).alias("top_districts"),
        _listed(parts["top_weather"], [-F.col("accidents"), F.col("weather")]).alias("top_weather"),
        _listed(parts["age_bands"], [-F.col("vehicles"), F.col("age_band")]).alias("age_bands"),
    )
    return geo.sparkSession.range(1).select(F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))


def batch_recompute(events: DataFrame, spec: RollupSpec, stamp: Column) -> DataFrame:
    """A rollup table computed anew from raw events, each event counted once however often it was delivered.

    Events are reduced to their typed contributions before copies meet, which keeps the shuffled rows narrow.
    """
    identity = ["stream", "seq"]
    return spec.total(drop_replays(spec.contributions(events, by=identity))).withColumn(STAMP, stamp)


def recompute_all(events: Mapping[str, DataFrame], stamp: Column) -> dict[str, DataFrame]:
    return {name: batch_recompute(events[spec.stream], spec, stamp) for name, spec in ROLLUPS.items()}


def store(table: DataFrame, path: str, period: str) -> None:
    """Write a batch table below ``path``; the periods (say days) that it holds replace those stored before.

    Rows are rebalanced by period: small periods share a task, and a large one is split over several, with a file from each.
    """
    placed = table.withColumn("_period", F.col(period).cast("string")).hint("rebalance", F.col("_period"))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_period").parquet(path)


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with the columns of ``schema``: a plain scan, without the join or rollup behind it."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def serve(batch: DataFrame, stream: DataFrame, period: str, cut_over: Column) -> DataFrame:
    """Batch rows before the cut-over, stream rows from it on: a union of two filtered scans, no join.

    The cut-over lies on a period boundary, so no key can be in both parts.
    """
    history = batch.where(F.col(period) < cut_over).withColumn("layer", F.lit("batch"))
    recent = stream.where(F.col(period) >= cut_over).withColumn("layer", F.lit("stream"))
    return history.unionByName(recent)
