"""Accident-shaped views over the order tables, blanks and ``'30.0'``-style numbers included.

Orders play the accidents, line items their vehicles. Only the district and the area come from the customer,
so the customer join is made on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.operators.joins import lookup_join

ACCIDENT_COLUMNS = """
    cast(o_orderkey as string) as accident_index
    case o_orderpriority when '1-URGENT' then 'Fatal' when '2-HIGH' then 'Serious' else 'Slight' end as accident_severity
    case when o_orderkey % 53 = 0 then '' else cast(cast(o_orderdate as date) as string) end as date
    case when o_orderkey % 11 = 0 then '' else concat(lpad(cast(o_custkey % 24 as string), 2, '0'), ':', lpad(cast(o_orderkey % 60 as string), 2, '0')) end as time
    case when o_orderkey % 97 = 0 then '' else cast(cast(51 + (o_custkey % 25)/100.0 as decimal(5,2)) as string) end as latitude
    cast(cast(-0.30 + (o_orderkey % 30)/100.0 as decimal(5,2)) as string) as longitude
    cast(1 + o_custkey % 4 as string) as number_of_casualties
    cast(1 + o_orderkey % 3 as string) as number_of_vehicles
    case o_orderstatus when 'F' then 'Fine no high winds' when 'O' then 'Raining no high winds' else '' end as weather_conditions
    case when o_orderkey % 2 = 0 then 'Daylight' else 'Darkness - lights lit' end as light_conditions
    case o_custkey % 3 when 0 then 'Dry' when 1 then 'Wet or damp' else 'Frost or ice' end as road_surface_conditions
    case when o_orderkey % 101 = 0 then '' when o_orderkey % 2 = 0 then cast(20 + 10*(o_custkey % 6) as string) else concat(cast(20 + 10*(o_custkey % 6) as string), '.0') end as speed_limit
    case when o_totalprice < 100000 then 'Single carriageway' when o_totalprice < 200000 then 'Dual carriageway' else 'Roundabout' end as road_type
"""

VEHICLE_COLUMNS = """
    cast(l_orderkey as string) as accident_index
    case when l_quantity < 10 then '16 - 20' when l_quantity < 20 then '21 - 25' when l_quantity < 30 then '26 - 35' when l_quantity < 40 then '36 - 45' else 'Data missing or out of range' end as age_band_of_driver
    case l_returnflag when 'A' then 'Male' when 'R' then 'Female' else 'Not known' end as sex_of_driver
    case when l_linenumber = 7 then '' when l_linenumber = 6 then cast(l_partkey % 20 as string) else concat(cast(l_partkey % 20 as string), '.0') end as age_of_vehicle
    cast(extract(year from l_shipdate) as string) as year
"""


def _expressions(block: str) -> list[str]:
    return [line.strip() for line in block.strip().splitlines()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def accidents(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    """All accidents; ``place`` adds district and area from the customer and nation tables."""
    orders = table(spark, sf_dir, "orders")
    if not place:
        return orders.selectExpr(*_expressions(ACCIDENT_COLUMNS))
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_name as local_authority_district")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as o_custkey",
        "c_nationkey as n_nationkey",
        "case when c_acctbal < 0 then 'Rural' else 'Urban' end as urban_or_rural_area",
    )
    placed = lookup_join(lookup_join(orders, customers, "o_custkey"), nations, "n_nationkey")
    return placed.selectExpr(
        *_expressions(ACCIDENT_COLUMNS), "local_authority_district", "urban_or_rural_area"
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vehicles; the vehicle type comes from the part table."""
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("vehicle_type"))
    expressions = [e.replace("l_partkey", "p_partkey") for e in _expressions(VEHICLE_COLUMNS)]
    return lookup_join(items, parts, "p_partkey").selectExpr(*expressions, "vehicle_type")
