"""Streams give the tables a batch gives; failures and replays do not change them."""

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roadtally.operators.merge import drop_replays
from roadtally.operators.rollups import CONDITIONS, GEO, HOTSPOTS, PROFILE, STAMP
from roadtally.plans import catalog
from roadtally.plans.serving import batch_recompute, recompute_all
from roadtally.schemas import MESSAGE_SCHEMA
from roadtally.sources import fixtures
from roadtally.sources.envelope import decode, encode
from roadtally.sources.files import read_extract
from roadtally.streaming.jobs import (
    replay_files,
    rollup_handler,
    run_until_any_ends,
    start_extract,
    start_rollups,
    stream_join,
)
from roadtally.streaming.replays import SeenEvents
from roadtally.streaming.state import RollupTable
from tests import micro

T0 = datetime.datetime(2024, 1, 1)


def messages(rows, stream, hour=0):
    numbered = rows.withColumn("seq", F.monotonically_increasing_id())
    return encode(numbered, stream, F.lit(T0 + datetime.timedelta(hours=hour)).cast("timestamp"))


def accident_files(spark, path):
    for hour, indexes in enumerate([("A1",), ("A2", "A3"), ("A6", "A4", "A5")]):
        messages(micro.accidents(spark, *indexes), "accidents", hour).coalesce(1).write.mode("append").parquet(path)
    return replay_files(spark, path)


def measures(df):
    return {tuple(r) for r in df.drop(STAMP).collect()}


def test_one_query_many_rollups(spark, tmp_path):
    stream = accident_files(spark, f"{tmp_path}/in")
    query = start_rollups(stream, [GEO, CONDITIONS, HOTSPOTS], f"{tmp_path}/t", f"{tmp_path}/c", True, compact_every=2)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    for spec, expected in ((GEO, micro.GEO), (CONDITIONS, micro.CONDITIONS), (HOTSPOTS, micro.HOTSPOTS)):
        assert measures(RollupTable(spark, f"{tmp_path}/t", spec).read()) == expected


def test_rollups_of_two_streams_need_two_queries(spark, tmp_path):
    with pytest.raises(ValueError):
        start_rollups(accident_files(spark, f"{tmp_path}/in"), [GEO, PROFILE], f"{tmp_path}/t", f"{tmp_path}/c")


def test_failure_between_write_and_commit(spark, tmp_path, monkeypatch):
    """The handler dies after the delta of the second batch is stored; the restart repeats the batch."""
    stream, original = accident_files(spark, f"{tmp_path}/in"), RollupTable.add

    def failing(self, delta, query_id, batch_id, stamp):
        original(self, delta, query_id, batch_id, stamp)
        if batch_id == 1:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(RollupTable, "add", failing)
    args = ([GEO], f"{tmp_path}/t", f"{tmp_path}/c", True)
    with pytest.raises(StreamingQueryException):
        start_rollups(stream, *args).awaitTermination()
    monkeypatch.setattr(RollupTable, "add", original)
    start_rollups(stream, *args).awaitTermination()
    assert measures(RollupTable(spark, f"{tmp_path}/t", GEO).read()) == micro.GEO


def test_empty_batch_writes_nothing(spark, tmp_path):
    table = RollupTable(spark, str(tmp_path), GEO)
    rollup_handler([table])(micro.accidents(spark).limit(0), 0)
    assert not (tmp_path / GEO.name).exists()


def test_extracts_run_side_by_side(spark, tmp_path):
    accidents = accident_files(spark, f"{tmp_path}/a")
    messages(micro.vehicles(spark), "vehicles").write.parquet(f"{tmp_path}/v")
    broken = spark.createDataFrame([("k", "{not json", T0)], "key string, value string, timestamp timestamp")
    broken.write.mode("append").parquet(f"{tmp_path}/v")
    queries = [
        start_extract(accidents, "accidents", f"{tmp_path}/out/a", f"{tmp_path}/ca", True),
        start_extract(replay_files(spark, f"{tmp_path}/v"), "vehicles", f"{tmp_path}/out/v", f"{tmp_path}/cv", True),
    ]
    for query in queries:
        query.processAllAvailable()
    run_until_any_ends(spark, queries, timeout=60)
    assert not any(q.isActive for q in queries)
    assert read_extract(spark, f"{tmp_path}/out/a", "accidents").count() == 6
    assert read_extract(spark, f"{tmp_path}/out/v", "vehicles").count() == 5


def test_replays_are_dropped(spark, tmp_path):
    """All files delivered twice: batch and stream both count every event once."""
    once = messages(micro.accidents(spark).coalesce(1), "accidents")
    events = decode(once.unionByName(once), "accidents", GEO.inputs)
    assert drop_replays(events).count() == 6
    assert measures(batch_recompute(events, GEO, F.lit(T0))) == micro.GEO
    for _ in range(2):
        once.write.mode("append").parquet(f"{tmp_path}/in")
    start_rollups(
        replay_files(spark, f"{tmp_path}/in", 10),
        [GEO],
        f"{tmp_path}/t",
        f"{tmp_path}/c",
        True,
        seen=SeenEvents(spark, f"{tmp_path}/seen", bucket=4),
    ).awaitTermination()
    assert measures(RollupTable(spark, f"{tmp_path}/t", GEO).read()) == micro.GEO


def test_late_events_that_were_never_seen_count(spark, tmp_path):
    """Old time stamps after new ones, each message twice, a stop in between and a batch repeated by hand."""
    rows = messages(micro.accidents(spark).coalesce(1), "accidents").collect()
    late = F.col("timestamp") - F.expr("interval 3 hours")
    seen = SeenEvents(spark, f"{tmp_path}/seen")
    for part in (rows[:3], rows, rows):
        sent = spark.createDataFrame(part, MESSAGE_SCHEMA)
        (sent.withColumn("timestamp", late) if part is rows else sent).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        start_rollups(
            replay_files(spark, f"{tmp_path}/in"), [GEO], f"{tmp_path}/t", f"{tmp_path}/c", True, compact_every=2, seen=seen
        ).awaitTermination()
    assert measures(RollupTable(spark, f"{tmp_path}/t", GEO).read()) == micro.GEO
    events = decode(spark.createDataFrame(rows, MESSAGE_SCHEMA), "accidents", GEO.inputs)
    other = SeenEvents(spark, f"{tmp_path}/again")
    for _ in range(2):
        fresh = other.unseen(events, "q", 0)
        assert fresh.count() == 6
        other.store(fresh, "q", 0)
    assert other.unseen(events, "q", 1).count() == 0


def test_extract_without_replays(spark, tmp_path):
    once = messages(micro.vehicles(spark).coalesce(1), "vehicles")
    for _ in range(2):
        once.write.mode("append").parquet(f"{tmp_path}/in")
    start_extract(
        replay_files(spark, f"{tmp_path}/in", 10),
        "vehicles",
        f"{tmp_path}/out",
        f"{tmp_path}/c",
        True,
        seen=SeenEvents(spark, f"{tmp_path}/seen"),
    ).awaitTermination()
    assert read_extract(spark, f"{tmp_path}/out", "vehicles").count() == 5


def test_recompute_all(spark):
    events = {
        "accidents": decode(messages(micro.accidents(spark).coalesce(1), "accidents"), "accidents"),
        "vehicles": decode(messages(micro.vehicles(spark).coalesce(1), "vehicles"), "vehicles"),
    }
    tables = recompute_all(events, F.lit(T0))
    assert measures(tables[GEO.name]) == micro.GEO and measures(tables[PROFILE.name]) == micro.PROFILE


def test_stream_join_within_the_bound(spark, tmp_path):
    """A pair arriving together joins; a pair hours apart is lost, as the bound says."""
    accident_files(spark, f"{tmp_path}/a")
    messages(micro.vehicles(spark), "vehicles", 0).coalesce(1).write.parquet(f"{tmp_path}/v")
    accidents = decode(replay_files(spark, f"{tmp_path}/a", 10), "accidents", ["accident_index", "accident_severity"])
    vehicles = decode(replay_files(spark, f"{tmp_path}/v", 10), "vehicles", ["accident_index", "vehicle_type"])
    accidents, vehicles = (e.select("accident_index", e.columns[3], "kafka_ts") for e in (accidents, vehicles))
    joined = stream_join(accidents, vehicles, "10 minutes")
    out, chk = f"{tmp_path}/out", f"{tmp_path}/c"
    query = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", chk).trigger(availableNow=True)
    query.start().awaitTermination()
    assert [r["accident_index"] for r in spark.read.parquet(out).collect()] == ["A1"]


def test_daily_windows_equal_day_keys(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    windows = events.groupBy(F.window("ts", "1 day")).count().select(F.col("window.start").cast("date"), "count")
    days = events.groupBy(F.col("ts").cast("date")).count()
    assert {tuple(r) for r in windows.collect()} == {tuple(r) for r in days.collect()}


def test_messages_sent_twice_lie_in_as_many_files_as_there_are_partitions(spark, sf_dir, monkeypatch):
    """Files, and so tasks and micro-batches, do not grow with the input where the partitions do."""
    sent = []
    monkeypatch.setattr(catalog, "replay_files", lambda spark, path, files_per_trigger: sent.append((path, files_per_trigger)))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        catalog._replayed(spark, sf_dir, "vehicles")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = spark.read.parquet(sent[0][0])
    assert len(rows.inputFiles()) > 8 and sent[0][1] == 4
    counts = rows.groupBy("key", "value").agg(F.count("*").alias("n"), F.count_distinct("timestamp").alias("stamps"))
    assert {r["n"] for r in counts.select("n").distinct().collect()} == {2}
    assert {r["stamps"] for r in counts.select("stamps").distinct().collect()} == {1, 2}
    assert counts.count() == fixtures.vehicles(spark, sf_dir).count()
