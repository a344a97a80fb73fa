"""Trip messages: a key and a JSON value, as a message broker carries them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evenhand import schemas


def encode(trips: DataFrame, key: str = "tpep_pickup_datetime") -> DataFrame:
    """``key, value``: the key field as text and the whole row as JSON, nulls included."""
    body = F.to_json(F.struct(*trips.columns), {"ignoreNullFields": "false"})
    return trips.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def decode(messages: DataFrame, fields: Sequence[str] | None = None, schema: StructType = schemas.MESSAGE) -> DataFrame:
    """Fields of the JSON value by a fixed schema; a malformed value gives null fields.

    Naming the ``fields`` that are needed lets the parser skip all others.
    """
    wanted = schema if fields is None else StructType([schema[f] for f in fields])
    return messages.select(F.from_json(F.col("value").cast("string"), wanted).alias("m")).select("m.*")


def kafka_options(servers: str, topic: str, group: str | None = None, from_start: bool = True) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_start else "latest",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **choices) -> DataFrame:
    """Messages of a topic as a stream; offsets live in the checkpoint of the query that reads it.

    Needs the Kafka connector on the class path.
    """
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **choices)).load()


def write_kafka(messages: DataFrame, servers: str, topic: str, limit: int | None = None) -> None:
    """Send ``key, value`` rows to a topic, all of them or the first ``limit``."""
    rows = messages if limit is None else messages.limit(limit)
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option(
        "topic", topic
    ).save()
