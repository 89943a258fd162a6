"""Broker source. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_source_options(
    servers: str, topic: str, starting: str = "latest", fail_on_data_loss: bool = False
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def kafka_records(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """Records of one topic as a stream with a binary ``value`` column."""
    settings = {**kafka_source_options(servers, topic, starting), **options}
    return spark.readStream.format("kafka").options(**settings).load()
