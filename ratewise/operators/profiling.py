"""Counts and shape of a rating matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.cleaning import valid_rating


def profile(ratings: DataFrame) -> DataFrame:
    """One row: sizes, rating range and mean, and the share of empty cells."""
    stats = ratings.agg(
        F.count("*").alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("movie_id").alias("n_items"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.avg("rating").alias("avg_rating"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_items")
    return stats.withColumn("sparsity", 1 - F.try_divide("n_ratings", cells))


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """Number of ratings per value, by value."""
    return ratings.groupBy("rating").agg(F.count("*").alias("n_ratings")).orderBy("rating")


#: Size of a day's sketch, as a power of two, and what its estimates are within in all
#: but three of a thousand cases: three standard errors.
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def daily_profiles(ratings: DataFrame, time: str = "event_time") -> DataFrame:
    """One row per day: what ``profile_of_days`` adds up, with sketches of the users and
    items of 2 ** ``SKETCH_BITS`` registers each. Days without rows have none."""
    return ratings.groupBy(F.to_date(time).alias("day")).agg(
        F.count("*").alias("n_ratings"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.sum(F.col("rating").cast("double")).alias("total"),
        F.hll_sketch_agg("user_id", SKETCH_BITS).alias("users"),
        F.hll_sketch_agg("movie_id", SKETCH_BITS).alias("items"),
    )


def profile_of_days(days: DataFrame) -> DataFrame:
    """``profile`` of all days together, from their rows alone. The numbers of users and
    items are estimates within ``SKETCH_ERROR``; the rest is exact."""
    stats = days.agg(
        F.coalesce(F.sum("n_ratings"), F.lit(0)).alias("n_ratings"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n_users"),
        F.hll_sketch_estimate(F.hll_union_agg("items")).alias("n_items"),
        F.min("min_rating").alias("min_rating"),
        F.max("max_rating").alias("max_rating"),
        F.try_divide(F.sum("total"), F.sum("n_ratings")).alias("avg_rating"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_items")
    return stats.withColumn("sparsity", 1 - F.try_divide("n_ratings", cells))


def cleaning_counts(raw: DataFrame) -> DataFrame:
    """Rows before cleaning, valid ones and those that cleaning keeps, a row each.

    One scan and one aggregate: cleaning keeps one row per valid (user, item).
    """
    valid = valid_rating()
    pair = F.when(valid, F.struct("user_id", "movie_id"))
    counts = raw.agg(
        F.count("*").alias("raw"), F.count_if(valid).alias("valid"), F.count_distinct(pair).alias("clean")
    )
    rows = [
        F.struct(F.lit(c).alias("frame"), F.col(c).alias("n_rows")) for c in ("raw", "valid", "clean")
    ]
    return counts.select(F.inline(F.array(*rows)))


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row per named frame with its number of rows, e.g. before and after cleaning."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("frame"), "n_rows")
        for name, df in frames.items()
    ]
    total = counts[0]
    for other in counts[1:]:
        total = total.unionByName(other)
    return total
