import pytest
from pyspark.sql import functions as F

from roadtally.schemas import ACCIDENT_FIELDS, VEHICLE_FIELDS, column_name, wire_names
from roadtally.session import scratch_path, shared_dir
from roadtally.sources.envelope import by_key, decode, encode, first_records, only_stream
from roadtally.sources.files import (
    extract,
    lower_names,
    prepare_accidents,
    prepare_vehicles,
    read_csv,
    read_extract,
    read_extract_skipping,
    write_csv,
)
from roadtally.sources.kafka import read_stream, source_options
from roadtally.operators.numbering import number_rows
from tests import micro


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wire_names():
    assert len(ACCIDENT_FIELDS) == 34 and len(VEHICLE_FIELDS) == 24
    for fields in (ACCIDENT_FIELDS, VEHICLE_FIELDS):
        assert len({column_name(f) for f in fields}) == len(fields)
    assert column_name("Local_Authority_(District)") == "local_authority_district"
    assert wire_names("vehicles")["engine_capacity_cc"] == "Engine_Capacity_.CC."


def csv_file(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_by_header_with_blanks(spark, tmp_path):
    """Columns are found by header in any order; blanks are '', numbers stay text."""
    path = csv_file(tmp_path / "v.csv", "Year,Accident_Index,Engine_Capacity_.CC.,make\n2005,A1,,\"Fo,rd\"\n2005.0,A2,1000,\n")
    df = read_csv(spark, path, "vehicles")
    assert df.columns == ["accident_index", "engine_capacity_cc", "make", "year"]
    assert [tuple(r) for r in df.orderBy("accident_index").collect()] == [("A1", "", "Fo,rd", "2005"), ("A2", "1000", "", "2005.0")]
    narrow = read_csv(spark, path, "vehicles", ["accident_index"])
    assert "ReadSchema: struct<Accident_Index:string>" in plan(narrow)


def test_reencode_and_prepare(spark, tmp_path):
    path = csv_file(tmp_path / "v.csv", "Accident_Index,make\n200502,b\n200401,x\n200501,Citroën\n", "latin-1")
    write_csv(prepare_vehicles(read_csv(spark, path, "vehicles", encoding="ISO-8859-1")), f"{tmp_path}/out")
    text = "".join(p.read_text("utf-8") for p in sorted((tmp_path / "out").glob("*.csv")))
    assert [line for line in text.splitlines() if line[0] == "2"] == ["200501,Citroën", "200502,b"]
    assert prepare_accidents(micro.accidents(spark)).count() == 6


def test_lower_names(spark):
    assert lower_names(spark.sql("select 1 as Accident_Index, 2 as B")).columns == ["accident_index", "b"]


def test_envelope_round_trip(spark):
    numbered = number_rows(micro.accidents(spark), ["accident_index"])
    messages = encode(numbered, "accidents")
    assert messages.columns == ["key", "value", "timestamp"]
    events = decode(messages, "accidents")
    shown = micro.accidents(spark).columns
    assert events.select(shown).exceptAll(micro.accidents(spark)).count() == 0
    times = {r["accident_index"]: r["event_time_str"] for r in events.collect()}
    assert times["A1"] == "2005-01-04 17:42" and times["A4"] == "17:42"
    assert {"kafka_ts", "processing_time"} <= set(events.columns)
    assert {r["seq"] for r in first_records(events, 2).collect()} == {0, 1}
    assert first_records(events).count() == 6
    assert only_stream(events, "vehicles").count() == 0 and only_stream(events).count() == 6


def test_vehicle_events_have_no_time(spark):
    events = decode(encode(number_rows(micro.vehicles(spark), ["accident_index"]), "vehicles"), "vehicles")
    assert {r["event_time_str"] for r in events.collect()} == {None}
    assert events.count() == 5


def test_bytes_and_bad_messages(spark):
    df = spark.sql("select cast('{\"seq\": 3, \"payload\": {\"Accident_Index\": \"A1\"}}' as binary) as value, now() as timestamp union all select cast('{oops' as binary), now()")
    none = spark.sql("select cast(null as binary) as value, now() as timestamp")
    events = decode(df.unionByName(none), "vehicles", ["accident_index"])
    assert sorted(((r["seq"], r["accident_index"]) for r in events.collect()), key=repr) == [(3, "A1"), (None, None), (None, None)]
    assert extract(decode(df.unionByName(none), "vehicles"), "vehicles").count() == 1


def test_messages_of_a_key_stay_together(spark):
    messages = encode(number_rows(micro.vehicles(spark), ["accident_index"]), "vehicles")
    placed = by_key(messages, 4).select("key", F.spark_partition_id().alias("p")).distinct()
    assert placed.count() == 3


def test_extract_folder(spark, tmp_path):
    vehicles = micro.vehicles(spark)
    extract(vehicles, "vehicles").coalesce(1).write.parquet(f"{tmp_path}/x/day=1")
    extract(vehicles, "vehicles").coalesce(1).write.parquet(f"{tmp_path}/x/day=2/hour=3")
    (tmp_path / "x" / "broken.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        read_extract(spark, f"{tmp_path}/x", "vehicles").collect()
    rows, unread = read_extract_skipping(spark, f"{tmp_path}/x", "vehicles")
    assert rows.count() == 10 and [r["path"].rsplit("/", 1)[1] for r in unread.collect()] == ["broken.parquet"]
    (tmp_path / "empty").mkdir()
    empty = read_extract(spark, f"{tmp_path}/empty", "accidents")
    assert empty.isEmpty() and empty.columns == ["accident_index", "accident_severity"]


def test_kafka(spark):
    options = source_options("host:9093", "accidents", {"kafka.security.protocol": "SASL_SSL"})
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "true"
    assert "maxOffsetsPerTrigger" not in options and source_options("h", "t", max_offsets_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not installed here
        read_stream(spark, "host:9092", "accidents")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
