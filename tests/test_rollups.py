import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roadtally.functions.casts import exact_average, to_day, to_grid, to_int, to_long
from roadtally.functions.events import event_time_text
from roadtally.operators import reports
from roadtally.operators.rollups import CONDITIONS, GEO, HOTSPOTS, PROFILE, demographics
from tests import micro


def rows(df):
    return {tuple(r) for r in df.collect()}


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression.alias("y")).first()[0]


@pytest.mark.parametrize(
    "spec, expected",
    [(GEO, micro.GEO), (CONDITIONS, micro.CONDITIONS), (HOTSPOTS, micro.HOTSPOTS), (PROFILE, micro.PROFILE)],
)
def test_micro_rows(spark, spec, expected):
    events = micro.vehicles(spark) if spec.stream == "vehicles" else micro.accidents(spark)
    result = spec.aggregate(events)
    assert rows(result) == expected
    types = dict(result.dtypes)
    assert {k: types[k] for k in spec.keys} == spec.keys
    assert {types[m] for m in spec.measures} == {"bigint"}


def test_averages(spark):
    conditions = reports.with_average_severity(CONDITIONS.aggregate(micro.accidents(spark)))
    assert {r["weather_conditions"]: r["avg_severity"] for r in conditions.collect()} == {"Fine": 2.0, "": 2.0, "Rain": 1.0}
    profile = reports.with_average_age(PROFILE.aggregate(micro.vehicles(spark)))
    assert {r["age_band_of_driver"]: r["avg_age"] for r in profile.collect()} == {
        "26 - 35": 3.5,
        "Data missing or out of range": 1.0,
    }


def test_demographics(spark):
    result = demographics(micro.vehicles(spark), micro.accidents(spark), F.lit("2024-01-01"))
    day = datetime.date(2024, 1, 1)
    assert rows(result) == {
        (day, "26 - 35", "Male", "Car", "Fatal", 1),
        (day, "26 - 35", "Male", "Car", "Slight", 3),
    }


@pytest.mark.parametrize(
    "text, expected",
    [("30", 30), ("30.0", 30), ("30.7", 30), ("-1", -1), ("", None), (None, None), ("x", None), ("NaN", None), ("1e99", None)],
)
def test_tolerant_numbers(spark, text, expected):
    assert one(spark, text, to_int("x")) == expected
    assert one(spark, text, to_long("x")) == expected


DAY_TEXTS = (
    "2005-01-04|2005-13-40|2005-02-30|2004-02-29|2005-1-4|2005-01-4 |2005-01-4T|2005-1-04 | 2005-1-04|04/01/2005|2005|2005-01"
    "|2005-01-04T00:00:00|2005-01-04 10:00|02005-01-4|+205-01-04|-205-01-04|2005-01- 4|2005-01-0a||0001-01-01|9999-12-31"
    "|2005-00-01|2005/01/04|20050104|2005-01-041|epoch|today|now|2005-01-04Z|-2005-1-04"
)


def test_day_takes_the_one_pattern(spark):
    texts = spark.createDataFrame([(t,) for t in DAY_TEXTS.split("|")], "x string")
    wrong = texts.where(~to_day("x").eqNullSafe(F.expr("try_to_date(x, 'yyyy-MM-dd')")))
    assert wrong.collect() == []


@pytest.mark.parametrize(
    "text, cell",
    [("51.05", "51.1"), ("51.049999", "51.0"), ("-0.05", "-0.1"), ("-0.15", "-0.2"), ("51", "51.0"), ("", None), ("n/a", None), ("1000", None)],
)
def test_grid(spark, text, cell):
    assert one(spark, text, to_grid("x")) == (None if cell is None else Decimal(cell))


@pytest.mark.parametrize(
    "total, count, places, expected",
    [(686, 80, 2, 8.58), (7, 2, 2, 3.5), (1, 3, 3, 0.333), (-7, 8, 2, -0.88), (5, 0, 2, None), (0, 4, 2, 0.0)],
)
def test_exact_average(spark, total, count, places, expected):
    df = spark.createDataFrame([(total, count)], "s bigint, c bigint")
    assert df.select(exact_average("s", "c", places)).first()[0] == expected


@pytest.mark.parametrize(
    "day, time, expected",
    [("2005-01-04", "17:42", "2005-01-04 17:42"), ("2005-01-04", " ", "2005-01-04"), ("", "17:42", "17:42"), ("", None, None)],
)
def test_event_time(spark, day, time, expected):
    df = spark.createDataFrame([(day, time)], "date string, time string")
    assert df.select(event_time_text("date", "time")).first()[0] == expected


def test_null_and_blank_dimensions(spark):
    """A blank is a group of its own, a null drops the row; a rollup and its rejects cover all events."""
    events = micro.accidents(spark).withColumn("road_type", F.when(F.col("accident_index") != "A1", F.lit("")))
    result = HOTSPOTS.aggregate(events)
    assert {r["road_type"] for r in result.collect()} == {""}
    assert result.agg(F.sum("accident_count")).first()[0] == 4
    assert {r[0] for r in HOTSPOTS.rejected(events, by=["accident_index"]).collect()} == {"A1", "A4"}


def test_sums_are_never_null(spark):
    events = micro.accidents(spark).withColumn("number_of_casualties", F.lit(None).cast("string"))
    assert {r["total_casualties"] for r in GEO.aggregate(events).collect()} == {0}
    assert reports.totals(GEO.aggregate(events.limit(0))).first()["total_accidents"] == 0


def test_report_limits_and_ties(spark):
    table = spark.createDataFrame([(f"D{i:02d}", 5, 1) for i in range(20)], "local_authority_district string, weighted_count bigint, accident_count bigint")
    top = reports.leaderboard(table, 3).collect()
    assert [(r["place"], r["district"]) for r in top] == [(1, "D00"), (2, "D01"), (3, "D02")]


def test_render(spark):
    df = spark.sql(
        "select date'2005-01-04' d, cast(51.1 as decimal(5,2)) x, timestamp_ntz'2024-01-01 01:02:03' a,"
        " timestamp_ntz'2024-01-01 01:02:03.5' b"
    )
    assert tuple(reports.render(df).first()) == ("2005-01-04", 51.1, "2024-01-01T01:02:03", "2024-01-01T01:02:03.500000")
