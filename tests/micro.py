"""Hand-computed rows: accidents, vehicles and what the rollups make of them."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

ACCIDENTS = [
    ("A1", "Fatal", "2005-01-04", "51.12", "-0.14", "2", "1", "Fine", "30"),
    ("A2", "Slight", "2005-01-04", "51.08", "-0.11", "1", "2", "Fine", "30.0"),
    ("A3", "", "2005-01-04", "51.10", "-0.10", "1", "1", "Fine", ""),
    ("A4", "Serious", "", "51.10", "-0.10", "1", "1", "Fine", "30"),
    ("A5", "Serious", "2005-01-05", "", "-0.10", "1", "1", "", "60"),
    ("A6", "Slight", "2005-01-05", "51.15", "-0.15", "", "", "Rain", "60"),
]
ACCIDENT_COLUMNS = (
    "accident_index accident_severity date latitude longitude number_of_casualties number_of_vehicles"
    " weather_conditions speed_limit"
).split()
CONSTANT = {
    "time": "17:42",
    "light_conditions": "Daylight",
    "road_surface_conditions": "Dry",
    "local_authority_district": "D",
    "road_type": "Single carriageway",
    "urban_or_rural_area": "Urban",
}
VEHICLES = [
    ("A1", "2005", "26 - 35", "Male", "Car", "5"),
    ("A2", "2005", "26 - 35", "Male", "Car", "2.0"),
    ("A2", "2005", "26 - 35", "Male", "Car", ""),
    ("A2", "", "26 - 35", "Male", "Car", "9"),
    ("A9", "2005", "Data missing or out of range", "Male", "Car", "1"),
]
VEHICLE_COLUMNS = "accident_index year age_band_of_driver sex_of_driver vehicle_type age_of_vehicle".split()


def accidents(spark, *indexes):
    rows = [r + tuple(CONSTANT.values()) for r in ACCIDENTS if not indexes or r[0] in indexes]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*ACCIDENT_COLUMNS, *CONSTANT]))


def vehicles(spark):
    return spark.createDataFrame(VEHICLES, ", ".join(f"{c} string" for c in VEHICLE_COLUMNS))


JAN4, JAN5 = date(2005, 1, 4), date(2005, 1, 5)
GEO = {
    (JAN4, Decimal("51.10"), Decimal("-0.10"), 3, 1, 0, 1, 4, 4),
    (JAN5, Decimal("51.20"), Decimal("-0.20"), 1, 0, 0, 1, 0, 0),
}
CONDITIONS = {
    (JAN4, "Fine", "Daylight", "Dry", 30, 2, 4, 1),
    (JAN5, "", "Daylight", "Dry", 60, 1, 2, 0),
    (JAN5, "Rain", "Daylight", "Dry", 60, 1, 1, 0),
}
HOTSPOTS = {
    (JAN4, "D", "Single carriageway", "Urban", 7, 3),
    (JAN5, "D", "Single carriageway", "Urban", 4, 2),
}
PROFILE = {
    (2005, "26 - 35", "Male", "Car", 3, 7, 2),
    (2005, "Data missing or out of range", "Male", "Car", 1, 1, 1),
}
