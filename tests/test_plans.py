"""Plans: narrow scans, no products, no global windows over data, consistent documents."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from roadtally.operators.rollups import GEO, ROLLUPS, STAMP
from roadtally.plans.serving import serve, snapshot, snapshot_parts
from roadtally.operators.reports import render
from roadtally.schemas import MESSAGE_SCHEMA
from roadtally.sources import fixtures
from roadtally.sources.envelope import decode
from roadtally.sources.files import extract

# Queries that run jobs while they are built (streams, fits, numbering) are judged by their parts.
LAZY = [
    "accident_kpi_geo",
    "accident_conditions",
    "accident_hotspots",
    "vehicle_profile",
    "vehicle_demographics",
    "kpi_totals",
    "table_stats",
    "top_weather",
    "top_districts",
    "drivers_by_age_band",
    "latest_kpi_geo",
    "accident_vehicle_join",
    "additive_merge",
    "state_rows_touched",
    "dedup_events",
    "clean_training_rows",
    "training_groups",
    "class_weights",
    "serve_batch_or_stream",
    "prep_filter_sort",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_python(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_rollup_scans_read_only_their_columns(spark, sf_dir):
    geo = plan(queries()["accident_kpi_geo"](spark, sf_dir))
    assert geo.count("FileScan") == 1 and "Join" not in geo
    assert "o_totalprice" not in geo and "o_orderstatus" not in geo
    assert geo.count("Exchange hashpartitioning") == 1 and geo.count("HashAggregate") == 2
    profile = plan(queries()["vehicle_profile"](spark, sf_dir))
    assert "l_extendedprice" not in profile and "p_name" not in profile


def test_a_message_is_parsed_once(spark):
    """However many columns and filters a job has, its plan holds one parse."""
    messages = spark.createDataFrame([], MESSAGE_SCHEMA)
    for spec in ROLLUPS.values():
        assert plan(spec.aggregate(decode(messages, spec.stream, spec.inputs))).count("from_json(") == 1
    assert plan(extract(decode(messages, "vehicles"), "vehicles")).count("from_json(") == 1


def test_top_k_needs_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(queries()["top_districts"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan(queries()["latest_kpi_geo"](spark, sf_dir))


def test_fixture_joins_keep_every_row(spark, sf_dir):
    assert fixtures.accidents(spark, sf_dir, place=True).count() == fixtures.table(spark, sf_dir, "orders").count()
    assert fixtures.vehicles(spark, sf_dir).count() == fixtures.table(spark, sf_dir, "lineitem").count()


def tables(spark, sf_dir):
    stamp = F.lit("2024-01-01 05:00:00").cast("timestamp_ntz")
    accidents, vehicles = fixtures.accidents(spark, sf_dir, place=True), fixtures.vehicles(spark, sf_dir)
    return {
        s.name: s.aggregate(vehicles if s.stream == "vehicles" else accidents).withColumn(STAMP, stamp)
        for s in ROLLUPS.values()
    }


def test_snapshot_lists_its_parts_in_order(spark, sf_dir):
    pinned = tables(spark, sf_dir)
    document = json.loads(snapshot(pinned[GEO.name], pinned).first()[0])
    assert document["type"] == "snapshot" and len(document["recent_geo"]) == 100
    for name, part in snapshot_parts(pinned[GEO.name], pinned).items():
        rows = [r.asDict() for r in render(part.drop(STAMP)).collect()]
        assert document[name] == (rows[0] if name == "stats" else rows)


def test_snapshot_of_empty_tables(spark, sf_dir):
    empty = {k: v.limit(0) for k, v in tables(spark, sf_dir).items()}
    document = json.loads(snapshot(empty[GEO.name], empty).first()[0])
    assert document["stats"]["total_accidents"] == 0 and document["stats"]["last_update"] is None
    assert document["recent_geo"] == document["age_bands"] == []


def test_serve_takes_each_side_of_the_cut(spark, sf_dir):
    table = tables(spark, sf_dir)[GEO.name]
    stream = table.withColumn("accident_count", F.lit(0).cast("bigint"))
    served = serve(table, stream, "event_date", F.lit("1998-07-01").cast("date"))
    assert served.count() == table.count()
    assert served.where("(layer = 'stream') != (accident_count = 0)").isEmpty()


@pytest.mark.parametrize("name", ["dedup_events", "batch_recompute", "batch_recompute_profile"])
def test_copies_are_hashed_away(spark, sf_dir, name):
    assert "SortAggregate" not in plan(queries()[name](spark, sf_dir))


def test_reads_of_stored_tables_have_no_join(spark, sf_dir):
    for name in ("latest_demographics", "serve_batch_or_stream"):
        assert "Join" not in plan(queries()[name](spark, sf_dir))


def test_a_query_runs_first_in_a_session_without_settings():
    code = (
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from __spark_entry__ import queries\n"
        "print('ROWS', queries()['onehot_features'](spark, '/root/testdata/sf0.001').count())\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
