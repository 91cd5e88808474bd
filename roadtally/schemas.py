"""Wire names, event schemas and column naming."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Payload field names on the wire and in the CSV headers, in file order.
ACCIDENT_FIELDS = (
    "Accident_Index",
    "1st_Road_Class",
    "1st_Road_Number",
    "2nd_Road_Class",
    "2nd_Road_Number",
    "Accident_Severity",
    "Carriageway_Hazards",
    "Date",
    "Day_of_Week",
    "Did_Police_Officer_Attend_Scene_of_Accident",
    "Junction_Control",
    "Junction_Detail",
    "Latitude",
    "Light_Conditions",
    "Local_Authority_(District)",
    "Local_Authority_(Highway)",
    "Location_Easting_OSGR",
    "Location_Northing_OSGR",
    "Longitude",
    "LSOA_of_Accident_Location",
    "Number_of_Casualties",
    "Number_of_Vehicles",
    "Pedestrian_Crossing-Human_Control",
    "Pedestrian_Crossing-Physical_Facilities",
    "Police_Force",
    "Road_Surface_Conditions",
    "Road_Type",
    "Special_Conditions_at_Site",
    "Speed_limit",
    "Time",
    "Urban_or_Rural_Area",
    "Weather_Conditions",
    "Year",
    "InScotland",
)
VEHICLE_FIELDS = (
    "Accident_Index",
    "Age_Band_of_Driver",
    "Age_of_Vehicle",
    "Driver_Home_Area_Type",
    "Driver_IMD_Decile",
    "Engine_Capacity_.CC.",
    "Hit_Object_in_Carriageway",
    "Hit_Object_off_Carriageway",
    "Journey_Purpose_of_Driver",
    "Junction_Location",
    "make",
    "model",
    "Propulsion_Code",
    "Sex_of_Driver",
    "Skidding_and_Overturning",
    "Towing_and_Articulation",
    "Vehicle_Leaving_Carriageway",
    "Vehicle_Location.Restricted_Lane",
    "Vehicle_Manoeuvre",
    "Vehicle_Reference",
    "Vehicle_Type",
    "Was_Vehicle_Left_Hand_Drive",
    "X1st_Point_of_Impact",
    "Year",
)

WIRE_FIELDS = {"accidents": ACCIDENT_FIELDS, "vehicles": VEHICLE_FIELDS}
# Columns joined into the display time of an event; vehicles carry none.
TIME_COLUMNS = {"accidents": ("date", "time"), "vehicles": ()}
KEY_COLUMN = "accident_index"


def column_name(wire_name: str) -> str:
    """Snake-case column for a wire name: ``Local_Authority_(District)`` -> ``local_authority_district``."""
    return re.sub(r"[^0-9a-z]+", "_", wire_name.lower()).strip("_")


def wire_names(stream: str) -> dict[str, str]:
    """Column name -> wire name of a stream's payload."""
    return {column_name(field): field for field in WIRE_FIELDS[stream]}


def strings(names) -> T.StructType:
    """Every payload field is text, so a blank never voids a record."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def envelope_schema(payload: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("seq", T.LongType()),
            T.StructField("stream", T.StringType()),
            T.StructField("event_time", T.StringType()),
            T.StructField("ingest_time", T.StringType()),
            T.StructField("payload", payload),
        ]
    )


# Message shape shared by the Kafka source, the replay files and the encoder.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

ACCIDENT_EXTRACT = ("accident_index", "accident_severity")
VEHICLE_EXTRACT = ("accident_index", "age_band_of_driver", "sex_of_driver", "vehicle_type")
EXTRACT_SCHEMAS = {"accidents": strings(ACCIDENT_EXTRACT), "vehicles": strings(VEHICLE_EXTRACT)}
