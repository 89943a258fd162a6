"""Ratings, items and users taken from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.cleaning import clean_ratings, complete
from ratewise.schemas import EVENTS
from ratewise.session import pin_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_ratings(spark: SparkSession, sf_dir: str, *others: str) -> DataFrame:
    """One rating per event: item from ``props``, no rating for errors.

    ``others`` are columns of the events to keep as they are.
    """
    value_class = (F.floor(F.col("value") / 25) + 1).cast("float")
    event_time = F.col("ts").cast("timestamp")
    # Generated, so that filters on it stay above and the text is parsed once.
    item = F.explode(F.array(F.get_json_object("props", "$.k").cast("int")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("int").alias("user_id"),
        item.alias("movie_id"),
        F.when(F.col("event_type") != "error", value_class).alias("rating"),
        F.unix_timestamp(event_time).alias("timestamp"),
        event_time.alias("event_time"),
        *others,
    )


def clean_event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ratings(event_ratings(spark, sf_dir), tiebreak=("event_id",))


def rated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ratings as the event parser would leave them: nulls out, item as ``item_id``."""
    events = event_ratings(spark, sf_dir).withColumnRenamed("movie_id", "item_id")
    return complete(events, EVENTS.names)


def order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per order line: customer, part, and a rating from the quantity."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("movie_id"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("float").alias("rating"),
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        "l_orderkey",
        "l_linenumber",
    )


def clean_order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ratings(
        order_ratings(spark, sf_dir), tiebreak=("l_orderkey", "l_linenumber")
    ).drop("l_orderkey", "l_linenumber")


def _as_items(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.col("p_partkey").cast("int").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genres"),
    )


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items; the part key is unique."""
    return _as_items(table(spark, sf_dir, "part"))


def moved_part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts under ids higher by 50, so that the lowest rated ids have no title."""
    return part_items(spark, sf_dir).withColumn("movie_id", F.col("movie_id") + 50)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id")
    )
