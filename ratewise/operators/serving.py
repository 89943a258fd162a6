"""Lookup of precomputed recommendations and tables over what was served."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions import bucket_column, bucket_count, exact_round, score_text, user_bucket
from ratewise.operators.cleaning import keep_latest
from ratewise.operators.popularity import POPULAR_NOTE
from ratewise.operators.recommending import recommendation_rows
from ratewise.operators.titles import numbered_title, with_title
from ratewise.settings import DEFAULTS

PRECOMPUTED_SOURCE = "precomputed ALS recommendations"  # Fixed value.


def batch_users(events: DataFrame) -> DataFrame:
    return events.select("user_id").distinct()


@dataclass(frozen=True)
class UserCheck:
    """What is known of a micro-batch's users before they are looked up."""

    n_users: int  # counted up to limit + 1
    buckets: list[int] | None  # None stands for all
    limit: int
    ids: list[int] | None = None  # the users, where they are few enough to be named

    @property
    def few(self) -> bool:
        return self.n_users <= self.limit


def check_users(
    users: DataFrame,
    recs: DataFrame,
    limit: int = DEFAULTS.max_broadcast_users,
    named: int = DEFAULTS.max_pushed_users,
) -> UserCheck:
    """Fetch the distinct ``users``, as far as they are few, and the directories of
    ``recs`` they touch: one job, ``limit`` + 1 pairs of integers at most."""
    bucket = user_bucket(F.col("user_id"), bucket_count(recs.columns) or 1)
    rows = users.select("user_id", bucket.alias("bucket")).limit(limit + 1).collect()
    if len(rows) > limit:
        return UserCheck(len(rows), None, limit)
    ids = sorted(r["user_id"] for r in rows) if len(rows) <= named else None
    return UserCheck(len(rows), sorted({r["bucket"] for r in rows}), limit, ids)


def find_recommendations(
    users: DataFrame, recs: DataFrame, check: UserCheck | None = None
) -> DataFrame:
    """Rows of the precomputed table for the given users.

    Only the directories that ``check`` lists are read. Users that it names are a filter
    of the scan, which leaves out row groups without them; few users, as counted by it,
    are sent to the table; with more, Spark chooses the join by size.
    """
    n_buckets = bucket_count(recs.columns)
    if check is not None and n_buckets and check.buckets is not None:
        recs = recs.filter(F.col(bucket_column(n_buckets)).isin(check.buckets))
    if check is not None and check.ids is not None:
        return recs.filter(F.col("user_id").isin(check.ids))
    few = check is not None and check.few  # one integer a user
    return recs.join(F.broadcast(users) if few else users, "user_id", "left_semi")


def is_titled(recs: DataFrame) -> bool:
    return "title" in recs.schema["recommendations"].dataType.elementType.names


def titled_recommendations(recs: DataFrame, items: DataFrame) -> DataFrame:
    """The table with a title in every entry, best first.

    Done once when the table is written, serving a micro-batch is a lookup
    without a join to the items and without a regrouping.
    """
    rows = with_title(
        recommendation_rows(recs), items, "movie_id", default=numbered_title("movie_id"), shuffled=True
    )
    ordered = F.sort_array(F.collect_list(F.struct("rank", "movie_id", "title", "rating")))
    return rows.groupBy("user_id").agg(ordered.alias("ranked")).select(
        "user_id",
        F.transform(
            "ranked",
            lambda r: F.struct(
                r["movie_id"].alias("movie_id"), r["title"].alias("title"), r["rating"].alias("rating")
            ),
        ).alias("recommendations"),
    )


def serve(
    users: DataFrame,
    recs: DataFrame,
    items: DataFrame,
    fallback: Column,
    check: UserCheck | None = None,
) -> DataFrame:
    """One row per user: precomputed recommendations, or the popular list.

    The left side of a left join can't be broadcast, so the table is cut to
    the wanted users first and only that is joined back, by a join that Spark
    chooses by the bytes found.
    ``users`` that come with a ``check`` must be distinct.
    ``fallback`` is the popular list: ``popular_list(..).scalar()`` or
    ``pinned_list(..)``.
    """
    users = users.select("user_id")
    if check is None:  # checked ones are distinct
        users = users.distinct()
    found = find_recommendations(users, recs, check)
    if not is_titled(recs):
        found = titled_recommendations(found, items)
    found = found.select("user_id", "recommendations", F.lit(True).alias("is_found"))
    rounded = F.transform(
        "recommendations",
        lambda r: F.struct(
            r["movie_id"].alias("movie_id"),
            r["title"].alias("title"),
            exact_round(r["rating"], 4).alias("predicted_rating"),
        ),
    )
    return users.join(found, "user_id", "left").select(
        "user_id",
        F.when(F.col("is_found"), rounded)
        .otherwise(fallback["recommendations"])
        .alias("recommendations"),
        F.when(F.col("is_found"), PRECOMPUTED_SOURCE).otherwise(POPULAR_NOTE).alias("source"),
        F.when(F.col("is_found"), score_text(F.col("recommendations"), "rating"))
        .otherwise(fallback["display"])
        .alias("display"),
    )


def latest_served(served: DataFrame) -> DataFrame:
    """The newest record of each user."""
    return keep_latest(served, ["user_id"], "batch_id")


def serving_metrics(
    served: DataFrame, alerts: DataFrame, target_ms: float = DEFAULTS.latency_target_ms
) -> DataFrame:
    """One row: served records, mean latency, records not below the target, and alerts."""
    n_alerts = alerts.agg(F.count("*").alias("n_alerts"))
    return served.agg(
        F.count("*").alias("n_served"),
        exact_round(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
        F.count_if(F.col("latency_ms") >= target_ms).alias("n_over_target"),
    ).select("n_served", "avg_latency_ms", "n_over_target", n_alerts.scalar().alias("n_alerts"))
