import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewise.operators.cleaning import clean_ratings, complete, keep_latest, valid_ratings
from ratewise.operators.profiling import profile, rating_histogram, row_counts
from ratewise.schemas import RATINGS

# Published counts per rating of the one-million-rating data set.
COUNTS = {1.0: 56174, 2.0: 107557, 3.0: 261197, 4.0: 348971, 5.0: 226310}


def ratings(spark, rows):
    return spark.createDataFrame(rows, RATINGS)


def test_valid_ratings(spark):
    nan = float("nan")
    rows = [
        (1, 1, 1.0, 1),
        (1, 2, 5.0, 1),
        (1, 3, 0.99, 1),
        (1, 4, 5.01, 1),
        (0, 5, 3.0, 1),
        (1, -6, 3.0, 1),
        (None, 7, 3.0, 1),
        (1, None, 3.0, 1),
        (1, 8, None, 1),
        (1, 9, 3.0, None),
        (1, 10, nan, 1),
    ]
    kept = valid_ratings(ratings(spark, rows)).collect()
    assert sorted(r["movie_id"] for r in kept) == [1, 2]


def test_null_checks_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "r")
    ratings(spark, [(1, 1, 1.0, 1)]).write.parquet(path)
    plan = (
        complete(spark.read.parquet(path), ["user_id", "rating"])
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "IsNotNull(user_id), IsNotNull(rating)" in plan


def test_latest_wins_and_ties_go_by_rating_on_any_layout(spark):
    rows = [(1, 1, 3.0, 10), (1, 1, 4.0, 20), (1, 1, 2.0, 20), (2, 1, 1.0, 5)]
    for parts in (1, 2, 7):
        random.Random(parts).shuffle(rows)
        got = clean_ratings(ratings(spark, rows).repartition(parts)).collect()
        assert sorted(tuple(r)[:4] for r in got) == [(1, 1, 4.0, 20), (2, 1, 1.0, 5)]


def test_tiebreak_column_goes_before_rating(spark):
    df = spark.createDataFrame(
        [(1, 1, 3.0, 10, 7), (1, 1, 5.0, 10, 6)],
        "user_id int, movie_id int, rating float, timestamp long, event_id int",
    )
    row = clean_ratings(df, tiebreak=("event_id",)).first()
    assert (row["rating"], row["event_id"]) == (3.0, 7)
    assert clean_ratings(df, tiebreak=("event_id",)).columns == [*df.columns, "event_time"]


def test_event_time_is_utc(spark):
    row = clean_ratings(ratings(spark, [(1, 1, 3.0, 978300760)])).selectExpr(
        "cast(event_time as string) t"
    )
    assert row.first()["t"] == "2000-12-31 22:12:40"


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(1, 5), st.integers(0, 4)),
        max_size=40,
    )
)
def test_dedup_is_idempotent_and_keeps_the_maximum(spark, rows):
    df = ratings(spark, [(u, m, float(r), t) for u, m, r, t in rows])
    once = clean_ratings(df)
    expected = {}
    for u, m, r, t in rows:
        expected[u, m] = max(expected.get((u, m), (0, 0)), (t, r))
    got = {(r["user_id"], r["movie_id"]): (r["timestamp"], r["rating"]) for r in once.collect()}
    assert got == expected
    again = clean_ratings(once.drop("event_time"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_dedup_aggregates_before_the_shuffle(spark):
    df = ratings(spark, [(1, 1, 3.0, 10)] * 50)
    plan = keep_latest(df, ["user_id", "movie_id"], "timestamp")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in text and "Window" not in text


def test_profile_of_the_published_counts(spark):
    """Counts per rating and the sizes give the published mean and sparsity."""
    df = spark.createDataFrame(list(COUNTS.items()), "rating float, n int")
    rows = df.select("rating", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    rated = rows.select(
        (F.xxhash64("rating", "i") % 6040).alias("user_id"),
        (F.xxhash64("i", "rating") % 3706).alias("movie_id"),
        "rating",
    ).select(F.pmod("user_id", F.lit(6040)).alias("user_id"), F.pmod("movie_id", F.lit(3706)).alias("movie_id"), "rating")
    row = profile(rated).first()
    assert row["n_ratings"] == 1_000_209
    assert (row["n_users"], row["n_items"]) == (6040, 3706)
    assert (row["min_rating"], row["max_rating"]) == (1.0, 5.0)
    assert round(row["avg_rating"], 4) == 3.5816
    assert round(row["sparsity"] * 100, 2) == 95.53
    hist = [tuple(r) for r in rating_histogram(rated).collect()]
    assert hist == sorted(COUNTS.items())


def test_profile_of_nothing(spark):
    row = profile(ratings(spark, [])).first()
    assert row["n_ratings"] == 0 and row["sparsity"] is None


def test_row_counts(spark):
    df = ratings(spark, [(1, 1, 3.0, 10), (1, 1, 9.0, 10)])
    got = {r["frame"]: r["n_rows"] for r in row_counts(raw=df, valid=valid_ratings(df)).collect()}
    assert got == {"raw": 2, "valid": 1}


@pytest.mark.parametrize("parts", [1, 5])
def test_sparsity_is_a_share(spark, parts):
    df = ratings(spark, [(u, m, 1.0, 1) for u in range(1, 4) for m in range(1, u + 1)])
    assert profile(df.repartition(parts)).first()["sparsity"] == pytest.approx(1 - 6 / 9)
