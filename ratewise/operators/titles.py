"""Title lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"  # Fixed value: title of an item without metadata.


def numbered_title(id_col: str) -> Column:
    """Fallback title ``Movie <id>``."""
    return F.concat(F.lit("Movie "), F.col(id_col).cast("string"))


def with_title(
    df: DataFrame,
    items: DataFrame,
    id_col: str,
    default: str | Column = UNKNOWN,
    max_len: int | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Add ``title`` by a left join; ``items`` must hold each id once.

    No hint: Spark broadcasts ``items`` only if its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and else joins by shuffle, where
    AQE splits the partition of a hot item. That size is the one of the files: titles
    that compress well are many times as large in a broadcast, and every micro-batch
    would send them through the driver again. ``shuffled`` never broadcasts.
    """
    lookup = items.select(F.col("movie_id").alias(id_col), "title")
    if shuffled:
        lookup = lookup.hint("merge")
    title = F.coalesce("title", default if isinstance(default, Column) else F.lit(default))
    if max_len:
        title = F.substring(title, 1, max_len)
    return df.join(lookup, id_col, "left").withColumn("title", title)
