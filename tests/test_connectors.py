"""Option building; no broker or database is started."""

import json

import pytest

from tallybrook.sinks import jdbc as jdbc_sink
from tallybrook.sinks import kafka as kafka_sink
from tallybrook.sources import jdbc, kafka

PLACE = jdbc.Connection("jdbc:x://host/db", "a.Driver", "me", "secret")


def test_password_is_not_shown():
    assert "secret" not in repr(PLACE)


def test_table_options():
    options = jdbc.table_options(PLACE, table="dict", slices=jdbc.Slices("id", 0, 900, 9))
    assert options == {
        "url": "jdbc:x://host/db",
        "driver": "a.Driver",
        "user": "me",
        "password": "secret",
        "dbtable": "dict",
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "900",
        "numPartitions": "9",
    }


def test_query_options():
    query = "SELECT id FROM dict"
    assert jdbc.table_options(PLACE, query=query)["query"] == query
    sliced = jdbc.table_options(PLACE, query=query, slices=jdbc.Slices("id", 0, 9, 3))
    assert sliced["dbtable"] == f"({query}) sliced_query" and "query" not in sliced
    with pytest.raises(ValueError):
        jdbc.table_options(PLACE)


def test_append_options():
    options = jdbc_sink.write_options(PLACE, "dict", connections=4)
    assert options["dbtable"] == "dict" and options["numPartitions"] == "4"


def test_offsets():
    assert kafka.offsets_json("earliest") == "earliest"
    assert json.loads(kafka.offsets_json({"t": {0: 0, 1: 10, 2: 330}})) == {
        "t": {"0": 0, "1": 10, "2": 330}
    }
    with pytest.raises(ValueError):
        kafka.offsets_json("none")


def test_kafka_options():
    options = kafka.read_options("h:1,h:2", ["a", "b"], max_per_trigger=7, min_partitions=3)
    assert options == {
        "kafka.bootstrap.servers": "h:1,h:2",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "7",
        "minPartitions": "3",
    }
    assert kafka.offsets_per_trigger(partitions=3, interval_seconds=2) == 12_000
    assert kafka_sink.write_options("h:1", "t")["topic"] == "t"


def test_kafka_rows(spark):
    raw = spark.sql(
        "SELECT 't' topic, 0 partition, 5L offset, timestamp'2024-01-01' timestamp, "
        "cast('月' AS binary) value, cast(null AS binary) key"
    )
    assert kafka.messages(raw).first().value == "月"
    rows = spark.createDataFrame([("k", 1)], "k string, n int")
    assert kafka_sink.records(rows).first().value == '{"k":"k","n":1}'
    assert tuple(kafka_sink.records(rows, rows.n, rows.k).first()) == ("k", "1")


def test_newest_rows_are_picked_by_the_database():
    options = jdbc.table_options(PLACE, query=jdbc.newest_query("dict", 10))
    assert options["query"] == "SELECT * FROM dict ORDER BY id DESC LIMIT 10"
