"""A third of all rows on one user, one item, one pair or one window: results stay whole."""

import pytest
from pyspark.sql import functions as F

from plans_helper import plan_of
from ratewise.operators.cleaning import clean_ratings
from ratewise.operators.profiling import profile
from ratewise.operators.recommending import unseen
from ratewise.operators.titles import with_title
from ratewise.operators.windows import item_windows
from ratewise.streaming import encode_events, parse_events

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Every third row is the same pair at the same time; the rest is spread."""
    is_hot = F.col("id") % 3 == 0
    return spark.range(N).select(
        F.when(is_hot, 7).otherwise(F.col("id") % 101 + 8).cast("int").alias("user_id"),
        F.when(is_hot, 9).otherwise(F.col("id") % 53 + 10).cast("int").alias("movie_id"),
        F.when(is_hot, 4).otherwise(F.col("id") % 5 + 1).cast("float").alias("rating"),
        F.when(is_hot, 1_000_000).otherwise(F.col("id") + 1_000_000).cast("long").alias("timestamp"),
    ).persist()


def test_dedup(hot):
    clean = clean_ratings(hot)
    pairs = hot.select("user_id", "movie_id").distinct().count()
    assert clean.count() == pairs
    assert clean.filter("user_id = 7").count() == 1
    assert "partial_max" in plan_of(clean_ratings(hot))
    assert profile(hot).first()["n_ratings"] == N


def test_windows_hold_every_row(hot):
    events = hot.withColumnRenamed("movie_id", "item_id").withColumn(
        "event_time", F.timestamp_seconds("timestamp")
    )
    for panes in (True, False):
        total = item_windows(events, panes=panes).agg(F.sum("interaction_count")).first()[0]
        assert total == 3 * N


def test_anti_join_drops_copies_before_the_shuffle(spark, hot):
    candidates = hot.select("user_id", "movie_id").withColumn("movie_id", F.col("movie_id") + 1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = unseen(candidates, hot)
        plan = plan_of(rows)
        # Distinct and join share one exchange of the ratings.
        assert plan.count("Exchange hashpartitioning") == 2
        seen = {tuple(r) for r in hot.select("user_id", "movie_id").distinct().collect()}
        expected = sum(tuple(r) not in seen for r in candidates.collect())
        assert rows.count() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_titles_of_a_hot_item_without_broadcast(spark, hot):
    items = spark.range(5, 30).selectExpr("cast(id as int) movie_id", "concat('T', id) title")
    keys = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in zip(keys, ("-1", "-1", "1000", "1.0", "2000")):
        spark.conf.set(key, value)
    try:
        spread = hot.repartition(8)
        titled = with_title(spread, items, "movie_id")
        rows = titled.groupBy("title").count().collect()
        assert sum(r["count"] for r in rows) == N
        assert {r["title"]: r["count"] for r in rows}["T9"] == N / 3
        titled.collect()
        assert "skew=true" in plan_of(titled)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_copies_are_split_when_events_are_ordered(spark, hot):
    """The range partitioner can cut a run of equal rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records = encode_events(hot)
        sizes = records.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < N / 3
        assert parse_events(records).count() == N
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
