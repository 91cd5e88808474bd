"""Streamed demographics equal the batch join, whatever arrives when; replays and crashes change nothing."""

import itertools

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roadtally.operators.rollups import STAMP, demographics
from roadtally.streaming.joined import StreamedDemographics, start_demographics
from roadtally.streaming.jobs import replay_files
from roadtally.streaming.replays import SeenEvents
from roadtally.streaming.state import RollupTable
from tests import micro
from tests.test_streaming import messages



def day():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def rows(df):
    return {tuple(r) for r in df.drop(STAMP).collect()}


def expected(spark):
    return rows(demographics(micro.vehicles(spark), micro.accidents(spark), F.lit("2024-01-01")))


@pytest.fixture
def joined(spark, tmp_path):
    return StreamedDemographics(spark, str(tmp_path), buckets=3)


def reopened(joined, spark, tmp_path):
    return StreamedDemographics(spark, str(tmp_path), buckets=3)


def part(df, i, of=2):
    return df.where(F.crc32(F.concat_ws("|", *df.columns).cast("binary")) % of == i)


@pytest.mark.parametrize("order", list(itertools.permutations(range(4)))[::5])
def test_sides_in_any_order(spark, tmp_path, joined, order):
    vehicles, accidents = micro.vehicles(spark), micro.accidents(spark)
    none = {"vehicles": vehicles.limit(0), "accidents": accidents.limit(0)}
    batches = [{"vehicles": part(vehicles, i)} for i in range(2)] + [{"accidents": part(accidents, i)} for i in range(2)]
    for batch_id, at in enumerate(order):
        events = {**none, **batches[at]}
        joined.add(events, "q", batch_id, day())
        reopened(joined, spark, tmp_path).add(events, "q", batch_id, day())  # delivered again
        if batch_id == 1:
            joined.compact()
    assert rows(joined.table.read()) == expected(spark)


def test_both_sides_in_one_batch(spark, joined):
    joined.add({"vehicles": micro.vehicles(spark), "accidents": micro.accidents(spark)}, "q", 0, day())
    assert rows(joined.table.read()) == expected(spark)


def test_only_touched_buckets_are_read(spark, tmp_path):
    joined = StreamedDemographics(spark, str(tmp_path), buckets=64)
    vehicles, accidents = micro.vehicles(spark), micro.accidents(spark)
    joined.add({"vehicles": vehicles, "accidents": accidents.limit(0)}, "q", 0, day())
    joined.compact()
    side = joined.sides["vehicles"]
    one = micro.accidents(spark, "A1").select("accident_index").dropna()
    assert len(side.periods_of(one)) == 1
    assert {f.split("period=")[1].split("/")[0] for f in side.pieces(side.periods_of(one)).inputFiles()} <= set(side.periods_of(one))


def test_a_crash_after_the_counts_were_stored(spark, tmp_path, monkeypatch):
    """The table has the batch, the sides have not; the restart repeats it."""
    messages(micro.vehicles(spark), "vehicles").coalesce(1).write.parquet(f"{tmp_path}/v")
    messages(micro.accidents(spark), "accidents", 9).coalesce(1).write.parquet(f"{tmp_path}/a")
    original = RollupTable.add

    def failing(self, delta, query_id, batch_id, stamp):
        if self.spec.name == "accidents_by_key":
            raise RuntimeError("executor lost")
        return original(self, delta, query_id, batch_id, stamp)

    def started():
        sides = [replay_files(spark, f"{tmp_path}/{side}", 1) for side in ("a", "v")]
        return start_demographics(*sides, f"{tmp_path}/t", f"{tmp_path}/c", True, stamp=lambda _: day(), compact_every=1)

    monkeypatch.setattr(RollupTable, "add", failing)
    with pytest.raises(StreamingQueryException):
        started().awaitTermination()
    monkeypatch.setattr(RollupTable, "add", original)
    started().awaitTermination()
    assert rows(StreamedDemographics(spark, f"{tmp_path}/t").table.read()) == expected(spark)


def test_replayed_messages_count_once(spark, tmp_path):
    sides = {"a": messages(micro.accidents(spark).coalesce(1), "accidents"), "v": messages(micro.vehicles(spark).coalesce(1), "vehicles")}
    seen = {s: SeenEvents(spark, f"{tmp_path}/seen-{s}", bucket=2, compact_every=1) for s in ("accidents", "vehicles")}
    for _ in range(2):
        for side, rows_ in sides.items():
            rows_.write.mode("append").parquet(f"{tmp_path}/{side}")
        streams = [replay_files(spark, f"{tmp_path}/{side}", 1) for side in ("a", "v")]
        start_demographics(*streams, f"{tmp_path}/t", f"{tmp_path}/c", True, stamp=lambda _: day(), seen=seen).awaitTermination()
    assert rows(StreamedDemographics(spark, f"{tmp_path}/t").table.read()) == expected(spark)


def test_texts_of_messages_are_not_kept(spark, tmp_path, monkeypatch):
    """A micro-batch's messages are many times as large as the columns that are counted."""
    messages(micro.vehicles(spark), "vehicles").coalesce(1).write.parquet(f"{tmp_path}/v")
    messages(micro.accidents(spark), "accidents").coalesce(1).write.parquet(f"{tmp_path}/a")
    frame, kept = type(spark.range(1)), []
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *level: (kept.append(self.columns), persist(self, *level))[1])
    sides = [replay_files(spark, f"{tmp_path}/{side}", 1) for side in ("a", "v")]
    start_demographics(*sides, f"{tmp_path}/t", f"{tmp_path}/c", True, stamp=lambda _: day()).awaitTermination()
    assert kept and not any("value" in columns for columns in kept)
    assert rows(StreamedDemographics(spark, f"{tmp_path}/t").table.read()) == expected(spark)
