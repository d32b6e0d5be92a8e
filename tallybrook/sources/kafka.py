"""Kafka topics, as batches or streams. Needs Spark's Kafka connector."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import constants as C

Offsets = str | dict[str, dict[int, int]]


def offsets_json(offsets: Offsets) -> str:
    """`earliest`, `latest`, or offsets per topic and partition."""
    if isinstance(offsets, str):
        if offsets not in ("earliest", "latest"):
            raise ValueError("offsets are earliest, latest, or given per topic and partition")
        return offsets
    return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in offsets.items()})


def offsets_per_trigger(
    partitions: int,
    interval_seconds: float,
    records_per_second: int = C.KAFKA_RECORDS_PER_SECOND,
) -> int:
    """The cap per micro-batch that equals a rate per partition and second."""
    return int(partitions * interval_seconds * records_per_second)


def read_options(
    servers: str,
    topics: list[str],
    starting: Offsets = "latest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options.

    The starting point applies to a new query; a restarted one goes on from its
    checkpoint. Failing on lost offsets stands in for a consumer without a
    reset policy.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": offsets_json(starting),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_stream(spark: SparkSession, servers: str, topics: list[str], **kwargs) -> DataFrame:
    options = read_options(servers, topics, **kwargs)
    return messages(spark.readStream.format("kafka").options(**options).load())


def read_batch(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting: Offsets = "earliest",
    ending: Offsets = "latest",
) -> DataFrame:
    options = read_options(servers, topics, starting) | {"endingOffsets": offsets_json(ending)}
    return messages(spark.read.format("kafka").options(**options).load())


def messages(records: DataFrame) -> DataFrame:
    """Kafka records with the value as a string."""
    return records.select(
        "topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value")
    )
