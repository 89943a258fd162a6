"""Broker sink. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    # Delivery settings of the producer.
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "5",
    }


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Send encoded records, each to the partition its ``partition`` column names."""
    records.select("key", "value", "partition").write.format("kafka").options(
        **kafka_sink_options(servers, topic)
    ).save()
