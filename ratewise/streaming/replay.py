"""Chronological replay of ratings as files a stream can follow."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.session import scratch_path
from ratewise.streaming.events import encode_events


def replay_slices(ratings: DataFrame, slices: int) -> Iterator[DataFrame]:
    """Encoded events of ``slices`` equal time ranges, oldest range first.

    The ratings are read once and staged by slice in the shared folder, and
    each slice reads only its own directory. Ratings without a time have no
    place in the order and are left out.
    """
    spark = ratings.sparkSession
    ratings = ratings.filter("timestamp is not null")
    staged = scratch_path(spark, "replay")
    bounds = ratings.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    if bounds["lo"] is None:
        return
    width = (bounds["hi"] - bounds["lo"]) // slices + 1
    number = F.floor((F.col("timestamp") - bounds["lo"]) / width).cast("int")
    numbered = ratings.withColumn("slice", number)
    numbered.write.partitionBy("slice").parquet(staged)
    table = spark.read.schema(numbered.schema).parquet(staged)
    for i in range(slices):
        yield encode_events(table.filter(F.col("slice") == i))


def write_replay(ratings: DataFrame, path: str, slices: int) -> None:
    """Write the slices one after the other into one folder.

    A file stream takes files by their modification time, so a slice is only
    written once the one before is complete; no event is then older than one
    of an earlier slice.
    """
    for events in replay_slices(ratings, slices):
        events.write.mode("append").parquet(path)
