"""Rating events as JSON records, both ways."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions import epoch_to_iso, iso_to_time
from ratewise.operators.cleaning import complete
from ratewise.schemas import EVENTS
from ratewise.settings import DEFAULTS


def parse_events(records: DataFrame, value: str = "value") -> DataFrame:
    """Events with all four fields, and their ``event_time``.

    Broken JSON and wrong-typed fields read as null and are left out. The time
    text only has to be there: text that isn't a time gives a null
    ``event_time``, which windows skip and the recommendation query keeps.
    """
    # Generated columns: a filter on the fields of a plain struct column would
    # be moved below it and parse the text once more for each field.
    event = F.from_json(F.col(value).cast("string"), EVENTS)
    fields = records.select(F.inline(F.array(event)))
    return complete(fields, EVENTS.names).withColumn(
        "event_time", iso_to_time(F.col("timestamp"))
    )


def encode_events(
    ratings: DataFrame, partitions: int = DEFAULTS.topic_partitions, item_col: str = "movie_id"
) -> DataFrame:
    """Ratings as records in time order: key and partition by item, value as JSON.

    The row number as last sort key lets the range partitioner split a run of
    equal rows.
    """
    partition = F.pmod(F.col(item_col), F.lit(partitions)).cast("int")
    event = F.struct(
        "user_id",
        F.col(item_col).alias("item_id"),
        "rating",
        epoch_to_iso(F.col("timestamp")).alias("timestamp"),
    )
    return ratings.orderBy(
        "timestamp", "user_id", item_col, F.monotonically_increasing_id()
    ).select(
        partition.cast("string").cast("binary").alias("key"),
        F.to_json(event).cast("binary").alias("value"),
        partition.alias("partition"),
    )
