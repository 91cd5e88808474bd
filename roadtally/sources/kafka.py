"""Kafka source and sink; the connector package must be on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession



def source_options(
    servers: str,
    topic: str,
    security: dict[str, str] | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options that lose nothing: from the topic's start, at the cluster's rate, failing on lost offsets.

    ``security`` holds ``kafka.``-prefixed client settings from the caller's secret store. A reader that may miss what
    is already in the topic, or must spare the broker, says so.
    """
    rate = {"maxOffsetsPerTrigger": str(max_offsets_per_trigger)} if max_offsets_per_trigger else {}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
        **rate,
        **(security or {}),
    }


def read_stream(spark: SparkSession, servers: str, topic: str, **overrides: str) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .options(**{**source_options(servers, topic), **overrides})
        .load()
        .selectExpr("cast(key as string) as key", "cast(value as string) as value", "timestamp")
    )


def write_batch(messages: DataFrame, servers: str, topic: str, security: dict[str, str] | None = None) -> None:
    """Send encoded messages; the key column routes all messages of one accident to one partition."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", **(security or {})}
    messages.select("key", "value").write.format("kafka").options(**options).save()
