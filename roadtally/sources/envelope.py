"""Typed event envelope: encoding rows into keyed messages and decoding messages into events."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.functions.events import event_time_text
from roadtally.schemas import KEY_COLUMN, TIME_COLUMNS, envelope_schema, strings, wire_names


def encode(rows: DataFrame, stream: str, ingest_time: Column | None = None, seq: str = "seq") -> DataFrame:
    """Numbered rows as ``(key, value, timestamp)`` messages; the payload keeps the wire names."""
    names = wire_names(stream)
    ingest = F.current_timestamp() if ingest_time is None else ingest_time
    present = [c for c in rows.columns if c in names]
    time_columns = TIME_COLUMNS[stream] if set(TIME_COLUMNS[stream]) <= set(rows.columns) else ()
    body = F.struct(
        F.col(seq).cast("bigint").alias("seq"),
        F.lit(stream).alias("stream"),
        event_time_text(*time_columns).alias("event_time"),
        F.date_format(ingest, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("ingest_time"),
        F.struct(*[F.col(c).alias(names[c]) for c in present]).alias("payload"),
    )
    return rows.select(F.col(KEY_COLUMN).alias("key"), F.to_json(body).alias("value"), ingest.alias("timestamp"))


def decode(messages: DataFrame, stream: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Messages as events with snake-case payload columns.

    ``columns`` narrows the parsed payload to what a job needs. Undecodable text yields null columns. The parse
    sits in a generator, so that later filters are not pushed below it and no message is parsed twice.
    """
    names = wire_names(stream)
    wanted = {c: names[c] for c in (names if columns is None else columns)}
    event = F.from_json(F.col("value").cast("string"), envelope_schema(strings(wanted.values())))
    return messages.select(F.inline(F.array(event)), F.col("timestamp").alias("kafka_ts")).select(
        "seq",
        "stream",
        *[F.col("payload").getField(wire).alias(column) for column, wire in wanted.items()],
        F.col("event_time").alias("event_time_str"),
        "kafka_ts",
        F.current_timestamp().alias("processing_time"),
    )


def by_key(messages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Messages of one key in one partition, as a keyed topic keeps them."""
    return messages.repartition(partitions, "key") if partitions else messages.repartition("key")


def first_records(events: DataFrame, max_records: int = 0) -> DataFrame:
    """The first N records of a numbered stream; 0 keeps all."""
    return events.where(F.col("seq") < max_records) if max_records else events


def only_stream(events: DataFrame, stream: str | None = None) -> DataFrame:
    return events.where(F.col("stream") == stream) if stream else events
