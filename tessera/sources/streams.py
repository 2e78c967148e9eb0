"""Streaming sources and the parser of their JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka(spark: SparkSession, servers: str, topic: str, group: str, **options: str) -> DataFrame:
    """JSON topic with a consumer group."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.group.id", group)
        .options(**options)
        .load()
    )


def eventhub_options(namespace: str, hub: str, group: str) -> dict[str, str]:
    """Kafka options of an event hub, which speaks the Kafka protocol on port 9093."""
    return {
        "kafka.bootstrap.servers": f"{namespace}:9093",
        "subscribe": hub,
        "kafka.group.id": group,
        "kafka.security.protocol": "SASL_SSL",
    }


def eventhub(spark: SparkSession, namespace: str, hub: str, group: str, **options: str) -> DataFrame:
    settings = {**eventhub_options(namespace, hub, group), **options}
    return spark.readStream.format("kafka").options(**settings).load()


def files(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options) -> DataFrame:
    """Files as they land in a folder."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def records(messages: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Columns of the JSON in the binary or text ``value`` of each message."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(parsed.alias("record")).select("record.*")
