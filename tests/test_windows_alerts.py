from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plans_helper import plan_of
from ratewise.operators import alerts as al
from ratewise.operators.ranking import (
    ACTIVITY_ORDER,
    current_window,
    newest_events,
    top_k_per_window,
    top_trending,
    top_users,
)
from ratewise.operators.titles import numbered_title, with_title
from ratewise.operators.windows import item_windows, latest_version, user_windows


EPOCH = datetime(1970, 1, 1)


def events(spark, rows):
    """Rows of (seconds, user, item, rating)."""
    return spark.createDataFrame(
        rows, "s long, user_id int, item_id int, rating float"
    ).withColumn("event_time", F.timestamp_seconds("s"))


def windows(spark, rows):
    """Rows of (start second, item, avg, count, score), thirty seconds long."""
    df = spark.createDataFrame(
        rows, "s long, item_id int, avg_rating double, interaction_count long, trending_score double"
    )
    bounds = F.struct(
        F.timestamp_seconds("s").alias("start"), F.timestamp_seconds(F.col("s") + 30).alias("end")
    )
    return df.withColumn("window", bounds).drop("s")


def activity(spark, rows):
    df = spark.createDataFrame(
        rows, "s long, user_id int, user_interaction_count long, user_avg_rating double"
    )
    bounds = F.struct(
        F.timestamp_seconds("s").alias("start"), F.timestamp_seconds(F.col("s") + 30).alias("end")
    )
    return df.withColumn("window", bounds).drop("s")


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [(1, "One", "A"), (2, "A very long title that goes on and on and on", "B")],
        "movie_id int, title string, genres string",
    )


@pytest.mark.parametrize(
    "n, rating, score", [(50, 4.5, 225.0), (5, 5.0, 25.0), (2, 5.0, 10.0), (2, 4.5, 9.0)]
)
def test_trending_score(spark, n, rating, score):
    df = events(spark, [(100, i, 1, rating) for i in range(n)])
    rows = item_windows(df).collect()
    assert len(rows) == 3
    assert {(r["avg_rating"], r["interaction_count"], r["trending_score"]) for r in rows} == {
        (rating, n, score)
    }


def test_mean_is_rounded_before_the_score(spark):
    df = events(spark, [(100, 1, 1, 1.0), (100, 2, 1, 1.0), (100, 3, 1, 2.0)])
    row = item_windows(df, "10 seconds", "10 seconds").first()
    assert row["avg_rating"] == 1.3333
    assert row["trending_score"] == 4.0  # 3.9999 to two places


@pytest.mark.parametrize("build, key", [(item_windows, "item_id"), (user_windows, "user_id")])
@pytest.mark.parametrize("length, slide", [("30 seconds", "10 seconds"), ("25 seconds", "10 seconds"), ("1 minute", "5 seconds")])
def test_panes_give_the_same_windows(spark, build, key, length, slide):
    rows = [(i * 7 % 300, i % 5, i % 3, None if i % 11 == 0 else float(i % 5 + 1)) for i in range(400)]
    df = events(spark, [*rows, (None, 1, 1, 3.0)])
    plain = build(df, length, slide, panes=False)
    paned = build(df, length, slide, panes=True)
    assert plan_of(paned).count("Exchange") > plan_of(plain).count("Exchange")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, paned.collect()))


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 12))
def test_each_row_is_in_length_over_slide_windows(spark, second, slide, factor):
    length = slide * factor
    df = events(spark, [(second, 1, 1, 3.0)])
    rows = item_windows(df, f"{length} seconds", f"{slide} seconds").collect()
    at = EPOCH + timedelta(seconds=second)
    assert len(rows) == factor
    for row in rows:
        assert row["window"]["start"] <= at < row["window"]["end"]
        assert int((row["window"]["start"] - EPOCH).total_seconds()) % slide == 0


def test_user_windows(spark):
    df = events(spark, [(5, 1, 1, 4.0), (6, 1, 2, 5.0), (6, 2, 1, 1.0)])
    rows = user_windows(df, "10 seconds", "10 seconds").collect()
    got = {(r["user_id"], r["user_interaction_count"], r["user_avg_rating"]) for r in rows}
    assert got == {(1, 2, 4.5), (2, 1, 1.0)}


def test_windows_have_no_python_and_a_partial_aggregate(spark):
    text = plan_of(item_windows(events(spark, [(5, 1, 1, 4.0)])))
    assert "Python" not in text and "partial_sum" in text


def test_top_trending_breaks_ties_by_newest_window_then_item(spark):
    df = windows(
        spark, [(0, 3, 5.0, 2, 10.0), (10, 2, 5.0, 2, 10.0), (10, 1, 5.0, 2, 10.0), (0, 4, 4.5, 2, 9.0)]
    )
    top = top_trending(df, 3)
    assert [r["item_id"] for r in top.collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_top_users(spark):
    df = activity(spark, [(0, 1, 5, 3.0), (0, 2, 9, 3.0), (10, 3, 5, 3.0)])
    assert [r["user_id"] for r in top_users(df, 2).collect()] == [2, 3]


def test_top_k_per_window_limits_before_the_shuffle(spark):
    rows = [(s, i, 1.0, 1, float(i % 4)) for s in (0, 10) for i in range(1, 9)]
    top = top_k_per_window(windows(spark, rows), k=3)
    assert plan_of(top).count("WindowGroupLimit") == 2
    got = sorted((r["window"]["start"], r["rank"], r["item_id"]) for r in top.collect())
    assert [(r, i) for _, r, i in got] == [(1, 3), (2, 7), (3, 2)] * 2


def test_top_k_per_window_of_users(spark):
    df = activity(spark, [(0, 1, 5, 3.0), (0, 2, 9, 3.0), (0, 3, 9, 3.0)])
    top = top_k_per_window(df, ACTIVITY_ORDER, 2)
    assert [(r["rank"], r["user_id"]) for r in top.orderBy("rank").collect()] == [(1, 2), (2, 3)]


def test_newest_events_give_the_same_current_window(spark):
    rated = events(spark, [(s, 1, s % 3, 3.0) for s in (0, 4, 11, 19, 20, 27, 29, 31, 38, 39)])

    def current(df):
        return sorted(map(tuple, current_window(item_windows(df, "30 seconds", "10 seconds")).collect()))

    few = newest_events(rated, "10 seconds")
    assert 0 < few.count() < rated.count()
    assert current(few) == current(rated)
    assert newest_events(rated.limit(0), "10 seconds").count() == 0


def test_current_window(spark):
    df = windows(spark, [(0, 1, 5.0, 2, 10.0), (20, 2, 5.0, 2, 10.0), (20, 3, 1.0, 1, 1.0)])
    assert {r["item_id"] for r in current_window(df).collect()} == {2, 3}


def test_titles(spark, items):
    df = spark.createDataFrame([(1,), (2,), (3,)], "item_id int")
    got = {r["item_id"]: r["title"] for r in with_title(df, items, "item_id", max_len=35).collect()}
    assert got == {1: "One", 2: "A very long title that goes on and ", 3: "Unknown"}
    numbered = with_title(df, items, "item_id", numbered_title("item_id"))
    assert {r["item_id"]: r["title"] for r in numbered.collect()}[3] == "Movie 3"


def test_small_items_are_broadcast_and_big_ones_are_not(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.range(1000).selectExpr(
        "cast(id as int) movie_id", "cast(id as string) title", "'' genres"
    ).write.parquet(path)
    df = spark.range(10).selectExpr("cast(id as int) item_id")
    items = spark.read.parquet(path)
    assert "BroadcastHashJoin" in plan_of(with_title(df, items, "item_id"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "BroadcastHashJoin" not in plan_of(with_title(df, items, "item_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_item_alerts_fire_at_the_threshold(spark, items):
    df = windows(
        spark,
        [
            (0, 1, 4.5, 1, 4.5),
            (0, 2, 4.4999, 1, 4.5),
            (0, 3, 3.0, 10, 30.0),
            (0, 4, 3.0, 10, 29.99),
            (0, 5, 5.0, 20, 100.0),
        ],
    )
    rows = al.item_alerts(df, items).collect()
    assert sorted((r["alert_type"], r["entity_id"]) for r in rows) == [
        ("RATING SPIKE", 1),
        ("RATING SPIKE", 5),
        ("TRENDING", 3),
        ("TRENDING", 5),
    ]
    messages = {r["message"] for r in rows}
    assert "🔴 ALERT [RATING SPIKE] Item 1 (One) avg_rating=4.50 > 4.5" in messages
    assert "🔥 ALERT [TRENDING] Item 3 (Unknown) trending_score=30.00 > 30" in messages
    assert {r["threshold"] for r in rows} == {4.5, 30.0}


def test_alert_text_rounds_like_printf(spark, items):
    values = [4.625, 4.875, 4.525, 4.565, 5.0]
    df = windows(spark, [(i, 1, v, 1, 1.0) for i, v in enumerate(values)])
    got = {r["message"].split("=")[1] for r in al.item_alerts(df, items).collect()}
    assert got == {f"{v:.2f} > 4.5" for v in values}


def test_alert_options(spark, items):
    df = windows(spark, [(0, 1, 5.0, 1, 5.0), (0, 2, 5.0, 7, 35.0), (0, 3, 4.6, 2, 9.2)])
    few = al.item_alerts(df, items, min_count=2)
    assert sorted((r["alert_type"], r["entity_id"]) for r in few.collect()) == [
        ("RATING SPIKE", 2),
        ("RATING SPIKE", 3),
        ("TRENDING", 2),
    ]
    top = al.item_alerts(df, items, top_n=1)
    assert sorted((r["alert_type"], r["entity_id"]) for r in top.collect()) == [
        ("RATING SPIKE", 2),
        ("TRENDING", 2),
    ]


def test_user_alerts(spark):
    df = activity(spark, [(0, 1, 10, 3.0), (0, 2, 9, 3.0)])
    (row,) = al.user_alerts(df).collect()
    assert row["message"] == "⚡ ALERT [USER SPIKE] User 1 has 10 interactions in window (threshold=10)"
    assert (row["entity_id"], row["metric"], row["title"]) == (1, 10.0, None)


def test_alert_tables(spark, items):
    item = al.item_alerts(windows(spark, [(0, 1, 5.0, 20, 100.0), (10, 1, 5.0, 1, 5.0)]), items)
    counts = {r["alert_type"]: r["n_alerts"] for r in al.alert_counts(item).collect()}
    assert counts == {"TRENDING": 1, "RATING SPIKE": 2, "USER SPIKE": 0}
    empty = al.alert_counts(item.filter("false")).collect()
    assert {r["n_alerts"] for r in empty} == {0} and len(empty) == 3
    first = item.withColumn("batch_id", F.lit(3))
    again = item.withColumn("batch_id", F.lit(8)).withColumn("metric", F.col("metric") + 1)
    both = first.unionByName(again)
    kept = al.first_alerts(both).collect()
    assert len(kept) == 3 and {r["batch_id"] for r in kept} == {3}
    assert {tuple(r) for r in al.alerts_per_batch(both).collect()} == {(3, 3), (8, 3)}
    recent = al.recent_alerts(both.withColumn("alert_time", F.col("window_end")), 2).collect()
    assert [r["window_start"].second for r in recent] == [10, 10]


def test_latest_version(spark):
    df = spark.createDataFrame(
        [(1, "a", 0, 5), (1, "a", 2, 7), (1, "a", 1, 6), (2, "b", 0, 1)],
        "k int, l string, batch_id int, n int",
    )
    assert sorted(map(tuple, latest_version(df, ["k", "l"]).collect())) == [(1, "a", 7), (2, "b", 1)]
