"""Kafka topics. Needs Spark's Kafka connector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def records(rows: DataFrame, value: Column | None = None, key: Column | None = None) -> DataFrame:
    """`value` (by default the row as JSON) and optional `key`, both strings."""
    value = F.to_json(F.struct("*")) if value is None else value
    columns = [value.cast("string").alias("value")]
    if key is not None:
        columns.insert(0, key.cast("string").alias("key"))
    return rows.select(*columns)


def write_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def write_batch(rows: DataFrame, servers: str, topic: str) -> None:
    """Send records; delivery is at least once."""
    rows.write.format("kafka").options(**write_options(servers, topic)).save()


def stream_writer(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """A writer ready to start; delivery is at least once."""
    options = write_options(servers, topic) | {"checkpointLocation": checkpoint}
    return rows.writeStream.format("kafka").options(**options)
