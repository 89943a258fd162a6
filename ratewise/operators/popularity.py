"""Popular items, the answer for users the model doesn't know."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions import exact_round, score_text
from ratewise.operators.titles import with_title
from ratewise.settings import DEFAULTS

POPULAR_NOTE = "cold-start fallback (popular movies)"  # Fixed value.


def item_popularity(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movie_id").agg(
        F.count("*").alias("num_ratings"), F.avg("rating").alias("avg_rating")
    )


def popular_items(
    ratings: DataFrame,
    items: DataFrame,
    n: int = DEFAULTS.top_n,
    min_ratings: int = DEFAULTS.popular_min_ratings,
) -> DataFrame:
    """The n best rated items with enough ratings, ranked from 1.

    An item without metadata keeps its place under the fallback title. The
    ranking window has no partition, but sees only the n rows of the limit.
    """
    best_first = [F.desc("avg_rating"), F.desc("num_ratings"), F.asc("movie_id")]
    top = (
        item_popularity(ratings)
        .filter(F.col("num_ratings") >= min_ratings)
        .orderBy(*best_first)
        .limit(n)
        .withColumn("rank", F.row_number().over(Window.orderBy(*best_first)))
    )
    return with_title(top, items, "movie_id", shuffled=True).select(
        "rank",
        "movie_id",
        "title",
        exact_round(F.col("avg_rating"), 4).alias("avg_rating"),
        "num_ratings",
        F.lit(POPULAR_NOTE).alias("note"),
    )


def popular_list(popular: DataFrame) -> DataFrame:
    """The n popular items as one row, ready to be a scalar subquery.

    ``popular`` is a struct of the ranked array and its display text.
    """
    entry = F.struct("rank", "movie_id", "title", "avg_rating")
    listed = popular.agg(F.sort_array(F.collect_list(entry)).alias("listed"))
    return listed.select(
        F.struct(
            F.col("listed"),
            F.transform(
                "listed",
                lambda r: F.struct(
                    r["movie_id"].alias("movie_id"),
                    r["title"].alias("title"),
                    r["avg_rating"].alias("predicted_rating"),
                ),
            ).alias("recommendations"),
            score_text(F.col("listed"), "avg_rating").alias("display"),
        ).alias("popular")
    )


def pinned_list(popular: DataFrame) -> Column:
    """The popular list as a constant, for use by many micro-batches.

    Reads the n rows once; as a subquery they would be aggregated from all
    ratings again each time.
    """
    listed = popular_list(popular)
    text = listed.select(F.to_json("popular")).first()[0]
    return F.from_json(F.lit(text), listed.schema["popular"].dataType)
