"""Counts over the join of two streams, kept current however far apart the two sides of a pair arrive.

A micro-batch brings new rows of both sides. Its pairs are the new vehicles with all accidents so far, and the stored vehicles with
the new accidents: every pair is counted by the batch that completes it, and by no other. Both sides are stored as counted
rows in tables of their own, in buckets of the join key, so a batch reads only the buckets that its new rows fall
into. Three tables follow one ledger rule: a repeated batch finds its own rows left out of what is stored, gives the same
counts again, and is recognised by each table that has it already.

Copies of a row collapse before they are joined; a key with many rows on both sides gives as many pairs as it has different
rows, of which there are few. Rows that lack the key or a counted column are in no pair and are not stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadtally.operators.joins import join_pairs
from roadtally.operators.rollups import DEMOGRAPHIC_KEYS, STAMP, RollupSpec
from roadtally.schemas import KEY_COLUMN
from roadtally.session import release_shuffles
from roadtally.sources.envelope import decode
from roadtally.streaming.jobs import COMPACT_EVERY, start, utc_now
from roadtally.streaming.replays import SeenEvents
from roadtally.streaming.state import RollupTable

# Buckets of the join key in which stored rows lie.
BUCKETS = 64
SIDES = {
    "vehicles": ("age_band_of_driver", "sex_of_driver", "vehicle_type"),
    "accidents": ("accident_severity",),
}
DEMOGRAPHICS = RollupSpec(
    name="demographics",
    stream="vehicles",
    inputs=(),
    keys={"processing_date": "date", **{c: "string" for c in DEMOGRAPHIC_KEYS[1:]}},
    measures=("joined_count",),
    period="cast(processing_date as string)",
    contribution=list,
)


def side_spec(stream: str, buckets: int = BUCKETS) -> RollupSpec:
    """The stored rows of one side: the key, the counted columns and how often they occur."""
    return RollupSpec(
        name=f"{stream}_by_key",
        stream=stream,
        inputs=(KEY_COLUMN, *SIDES[stream]),
        keys={KEY_COLUMN: "string", **{c: "string" for c in SIDES[stream]}},
        measures=("n",),
        period=f"cast(pmod(xxhash64({KEY_COLUMN}), {buckets}) as string)",
        contribution=lambda: [F.lit(1).cast("bigint").alias("n")],
    )


class StreamedDemographics:
    """The demographics table and the two sides behind it, below one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.sides = {stream: RollupTable(spark, root, side_spec(stream, buckets)) for stream in SIDES}
        self.table = RollupTable(spark, root, DEMOGRAPHICS)

    def add(self, events: Mapping[str, DataFrame], query_id: str, batch_id: int, stamp: Column) -> None:
        """Count the pairs that these events complete, and store them. Repeating a batch changes nothing."""
        new = {}
        for stream, columns in SIDES.items():
            known = events[stream].select(KEY_COLUMN, *columns).dropna(how="any")
            new[stream] = known.groupBy(KEY_COLUMN, *columns).agg(F.count("*").alias("n")).persist()
        try:
            if not self.table.has(query_id, batch_id):
                self.table.add(self._completed(new, (query_id, batch_id), stamp), query_id, batch_id, stamp)
            for stream, table in self.sides.items():
                table.add(new[stream], query_id, batch_id, stamp)
        finally:
            for rows in new.values():
                rows.unpersist()

    def _completed(self, new: Mapping[str, DataFrame], batch: tuple[str, int], stamp: Column) -> DataFrame:
        stored = {}
        for stream, other in (("vehicles", "accidents"), ("accidents", "vehicles")):
            touched = self.sides[stream].periods_of(new[other])
            stored[stream] = self.sides[stream].pieces(touched, without=batch).drop(STAMP)
        pairs = join_pairs(new["vehicles"], new["accidents"].unionByName(stored["accidents"]), KEY_COLUMN)
        pairs = pairs.unionByName(join_pairs(stored["vehicles"], new["accidents"], KEY_COLUMN))
        day = stamp.cast("date").alias("processing_date")
        return pairs.groupBy(day, *DEMOGRAPHIC_KEYS[1:]).agg(F.sum("n").alias("joined_count"))

    def compact(self, open_deltas: int = 1) -> None:
        """Fold the deltas of each table that has this many."""
        for table in (*self.sides.values(), self.table):
            if table.open_deltas() >= open_deltas:
                table.compact()


def start_demographics(
    accidents: DataFrame,
    vehicles: DataFrame,
    root: str,
    checkpoint: str,
    available_now: bool = False,
    stamp: Callable[[int], Column] = utc_now,
    compact_every: int = COMPACT_EVERY,
    seen: Mapping[str, SeenEvents] | None = None,
) -> StreamingQuery:
    """One query over the messages of both streams; ``seen`` (one per stream) leaves out events delivered before.

    A batch is compacted away at the start of the next one, when it cannot be repeated any more.
    """
    joined = StreamedDemographics(accidents.sparkSession, root)
    sides = {"accidents": accidents, "vehicles": vehicles}
    tagged = [rows.select("value", "timestamp", F.lit(stream).alias("side")) for stream, rows in sides.items()]

    def handle(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if compact_every and not joined.table.has(query_id, batch_id):
            joined.compact(compact_every)
        # Each side reads the batch anew and parses its own messages alone: their texts are by far too large to be kept.
        events = {s: decode(batch.where(F.col("side") == s), s, (KEY_COLUMN, *c)) for s, c in SIDES.items()}
        if seen:
            events = {s: seen[s].unseen(rows, query_id, batch_id).persist() for s, rows in events.items()}
        joined.add(events, query_id, batch_id, stamp(batch_id))
        for s in seen or ():
            seen[s].store(events[s], query_id, batch_id)
            events[s].unpersist()
        release_shuffles(batch.sparkSession)

    writer = tagged[0].unionByName(tagged[1]).writeStream.outputMode("append").foreachBatch(handle)
    return start(writer.option("checkpointLocation", checkpoint), available_now)
