"""Bounded reads over the rollup tables: totals, leaderboards, newest rows, exact averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.functions.casts import exact_average
from roadtally.operators.rollups import STAMP

# Row limits of the reports, and the band a report leaves out.
LATEST_ROWS = 50
TOP_ROWS = 10
SNAPSHOT_CELLS = 100
SNAPSHOT_WEATHER = 8
MISSING_BAND = "Data missing or out of range"

# Total name -> measure of the geo rollup.
TOTALS = {
    "total_accidents": "accident_count",
    "total_fatal": "fatal_count",
    "total_serious": "serious_count",
    "total_slight": "slight_count",
    "total_casualties": "total_casualties",
    "total_vehicles": "total_vehicles",
}


def _total(measure: str) -> Column:
    return F.coalesce(F.sum(measure), F.lit(0)).cast("bigint")


def totals(geo: DataFrame, with_update: bool = False) -> DataFrame:
    """One row of grand totals, 0 for an empty table; optionally the newest stamp."""
    columns = [_total(measure).alias(name) for name, measure in TOTALS.items()]
    if with_update:
        columns.append(F.max(STAMP).alias("last_update"))
    return geo.agg(*columns)


def table_stats(
    geo: DataFrame, conditions: DataFrame, hotspots: DataFrame, profile: DataFrame, demographics: DataFrame
) -> DataFrame:
    """Grand totals, the row count of each table and the newest update, as one row."""
    counted = {
        "rows_conditions": conditions,
        "rows_hotspots": hotspots,
        "rows_vehicle_profile": profile,
        "rows_demographics": demographics,
    }
    geo_columns = [_total(measure).alias(name) for name, measure in TOTALS.items()]
    head = geo.agg(*geo_columns, F.count("*").alias("rows_kpi_geo"), F.max(STAMP).alias("last_update"))
    return head.select("*", *[df.agg(F.count("*")).scalar().alias(name) for name, df in counted.items()])


def top_weather(conditions: DataFrame, limit: int | None = TOP_ROWS) -> DataFrame:
    grouped = (
        conditions.where(F.col("weather_conditions").isNotNull())
        .groupBy("weather_conditions")
        .agg(_total("accident_count").alias("accidents"), _total("fatal_count").alias("fatal"))
    )
    return _first(grouped.orderBy(F.desc("accidents"), "weather_conditions"), limit)


def top_districts(hotspots: DataFrame, limit: int | None = TOP_ROWS) -> DataFrame:
    grouped = (
        hotspots.where(F.col("local_authority_district").isNotNull())
        .groupBy(F.col("local_authority_district").alias("district"))
        .agg(_total("weighted_count").alias("weighted"), _total("accident_count").alias("accidents"))
    )
    return _first(grouped.orderBy(F.desc("weighted"), "district"), limit)


def drivers_by_age_band(profile: DataFrame, limit: int | None = TOP_ROWS) -> DataFrame:
    grouped = (
        profile.where(F.col("age_band_of_driver").isNotNull() & (F.col("age_band_of_driver") != MISSING_BAND))
        .groupBy(F.col("age_band_of_driver").alias("age_band"))
        .agg(_total("vehicle_count").alias("vehicles"))
    )
    return _first(grouped.orderBy(F.desc("vehicles"), "age_band"), limit)


def leaderboard(hotspots: DataFrame, limit: int = TOP_ROWS) -> DataFrame:
    """Top districts with their place; the window sees only the limited rows."""
    ranked = Window.orderBy(F.desc("weighted"), "district")
    return top_districts(hotspots, limit).select(F.row_number().over(ranked).alias("place"), "*")


def latest(table: DataFrame, keys: Sequence[str], limit: int = LATEST_ROWS, stamp: str = STAMP) -> DataFrame:
    """The newest rows, the full key breaking ties."""
    return table.orderBy(F.desc(stamp), *keys).limit(limit)


def with_average_severity(conditions: DataFrame) -> DataFrame:
    return conditions.withColumn("avg_severity", exact_average("severity_sum", "accident_count", 3))


def with_average_age(profile: DataFrame) -> DataFrame:
    return profile.withColumn("avg_age", exact_average("age_of_vehicle_sum", "age_of_vehicle_count", 2))


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    return ordered if limit is None else ordered.limit(limit)


def _iso(c: Column) -> Column:
    """ISO text of a timestamp, with microseconds only where there are any."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def render(df: DataFrame) -> DataFrame:
    """Columns as a reader of the reports gets them: dates as ISO text, decimals as numbers."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = _iso(c)
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        columns.append(c.alias(field.name))
    return df.select(*columns)
