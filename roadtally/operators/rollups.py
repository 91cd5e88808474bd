"""The rollups, each described once for batch, streaming, merging and compaction."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.functions.casts import to_day, to_grid, to_int, to_long
from roadtally.functions.events import FATAL, SERIOUS, SLIGHT, indicator, severity_score, severity_weight
from roadtally.operators.joins import join_counts

STAMP = "inserted_at"


@dataclass(frozen=True)
class RollupSpec:
    """An additive rollup: typed keys, bigint measures and what one event adds to them.

    ``period`` groups keys for storage: stored rows are rewritten by whole periods.
    """

    name: str
    stream: str
    inputs: tuple[str, ...]
    keys: dict[str, str]
    measures: tuple[str, ...]
    period: str
    contribution: Callable[[], list[Column]]

    @property
    def table_schema(self) -> str:
        """Columns of the stored table as DDL; the stamp is UTC without a zone."""
        fields = [f"{k} {t}" for k, t in self.keys.items()] + [f"{m} bigint" for m in self.measures]
        return ", ".join([*fields, f"{STAMP} timestamp_ntz"])

    def lacks_key(self) -> Column:
        """Whether a contribution lacks a key and so counts in no cell."""
        return F.exists(F.array(*[F.col(k).isNull() for k in self.keys]), lambda m: m)

    def rejected(self, events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """The events that lack a key and so count in no cell."""
        return events.select(*by, *self.contribution()).where(self.lacks_key())

    def contributions(self, events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Typed keys and measures of every event, narrow enough to shuffle; ``by`` columns are carried along."""
        return events.select(*by, *self.contribution())

    def total(self, contributions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Sum contributions per key: one partial pass in the scan tasks, one shuffle of the groups.

        Groups lacking a key are dropped by an aggregated flag. A plain filter on the keys would be pushed below
        the projection and make every row parse its text a second time.
        """
        complete = F.expr("min(" + " and ".join(f"{k} is not null" for k in self.keys) + ")")
        grouped = contributions.groupBy(*by, *self.keys).agg(*self.sums(), complete.alias("complete"))
        return grouped.where("complete").drop("complete")

    def aggregate(self, events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        return self.total(self.contributions(events, by), by)

    def sums(self) -> list[Column]:
        return [F.sum(m).cast("bigint").alias(m) for m in self.measures]

    def merged(self, pieces: DataFrame) -> DataFrame:
        """Sum all pieces of a table per key; the stamp of a key is that of the newest piece touching it.

        Sums commute, so pieces may come in any order and any number: a table is the merge of its deltas.
        """
        return pieces.groupBy(*self.keys).agg(*self.sums(), F.max(STAMP).alias(STAMP))


def _severity_is(label: str) -> Column:
    return indicator(f"accident_severity = '{label}'")


def _count() -> Column:
    return F.lit(1)


def _geo() -> list[Column]:
    return [
        to_day("date").alias("event_date"),
        to_grid("latitude").alias("lat_grid"),
        to_grid("longitude").alias("lon_grid"),
        _count().alias("accident_count"),
        _severity_is(FATAL).alias("fatal_count"),
        _severity_is(SERIOUS).alias("serious_count"),
        _severity_is(SLIGHT).alias("slight_count"),
        F.coalesce(to_long("number_of_casualties"), F.lit(0)).alias("total_casualties"),
        F.coalesce(to_long("number_of_vehicles"), F.lit(0)).alias("total_vehicles"),
    ]


def _conditions() -> list[Column]:
    return [
        to_day("date").alias("event_date"),
        F.col("weather_conditions"),
        F.col("light_conditions"),
        F.col("road_surface_conditions"),
        to_int("speed_limit").alias("speed_limit"),
        _count().alias("accident_count"),
        severity_score().alias("severity_sum"),
        _severity_is(FATAL).alias("fatal_count"),
    ]


def _hotspots() -> list[Column]:
    return [
        to_day("date").alias("event_date"),
        F.col("local_authority_district"),
        F.col("road_type"),
        F.col("urban_or_rural_area"),
        severity_weight().alias("weighted_count"),
        _count().alias("accident_count"),
    ]


def _profile() -> list[Column]:
    age = to_long("age_of_vehicle")
    return [
        to_int("year").alias("year"),
        F.col("age_band_of_driver"),
        F.col("sex_of_driver"),
        F.col("vehicle_type"),
        _count().alias("vehicle_count"),
        F.coalesce(age, F.lit(0)).alias("age_of_vehicle_sum"),
        age.isNotNull().cast("int").alias("age_of_vehicle_count"),
    ]


GEO = RollupSpec(
    name="accident_kpi_geo",
    stream="accidents",
    inputs=("date", "latitude", "longitude", "accident_severity", "number_of_casualties", "number_of_vehicles"),
    keys={"event_date": "date", "lat_grid": "decimal(5,2)", "lon_grid": "decimal(5,2)"},
    measures=("accident_count", "fatal_count", "serious_count", "slight_count", "total_casualties", "total_vehicles"),
    period="date_format(event_date, 'yyyy-MM')",
    contribution=_geo,
)
CONDITIONS = RollupSpec(
    name="accident_conditions",
    stream="accidents",
    inputs=(
        "date",
        "weather_conditions",
        "light_conditions",
        "road_surface_conditions",
        "speed_limit",
        "accident_severity",
    ),
    keys={
        "event_date": "date",
        "weather_conditions": "string",
        "light_conditions": "string",
        "road_surface_conditions": "string",
        "speed_limit": "int",
    },
    measures=("accident_count", "severity_sum", "fatal_count"),
    period="date_format(event_date, 'yyyy-MM')",
    contribution=_conditions,
)
HOTSPOTS = RollupSpec(
    name="accident_hotspots",
    stream="accidents",
    inputs=("date", "local_authority_district", "road_type", "urban_or_rural_area", "accident_severity"),
    keys={
        "event_date": "date",
        "local_authority_district": "string",
        "road_type": "string",
        "urban_or_rural_area": "string",
    },
    measures=("weighted_count", "accident_count"),
    period="date_format(event_date, 'yyyy-MM')",
    contribution=_hotspots,
)
PROFILE = RollupSpec(
    name="vehicle_profile",
    stream="vehicles",
    inputs=("year", "age_band_of_driver", "sex_of_driver", "vehicle_type", "age_of_vehicle"),
    keys={"year": "int", "age_band_of_driver": "string", "sex_of_driver": "string", "vehicle_type": "string"},
    measures=("vehicle_count", "age_of_vehicle_sum", "age_of_vehicle_count"),
    period="cast(year as string)",
    contribution=_profile,
)
ROLLUPS = {spec.name: spec for spec in (GEO, CONDITIONS, HOTSPOTS, PROFILE)}

DEMOGRAPHIC_KEYS = ("processing_date", "age_band_of_driver", "sex_of_driver", "vehicle_type", "accident_severity")


def demographics(vehicles: DataFrame, accidents: DataFrame, processing_date: Column) -> DataFrame:
    """Joined vehicles per processing day, driver, vehicle and severity class; the pairs are never formed.

    ``processing_date`` is a constant or is derived from the vehicle row.
    """
    counts = join_counts(
        vehicles.select(
            "accident_index",
            processing_date.cast("date").alias("processing_date"),
            "age_band_of_driver",
            "sex_of_driver",
            "vehicle_type",
        ),
        accidents.select("accident_index", "accident_severity"),
        "accident_index",
    )
    return counts.dropna(how="any", subset=list(DEMOGRAPHIC_KEYS)).withColumnRenamed("n", "joined_count")
