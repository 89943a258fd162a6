from dataclasses import replace
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from plans_helper import plan_of
from ratewise.operators import factors
from ratewise.operators.popularity import (
    POPULAR_NOTE,
    item_popularity,
    pinned_list,
    popular_items,
    popular_list,
)
from ratewise.operators.recommending import (
    cold_users,
    known_users,
    recommend,
    recommend_all,
    recommend_subset,
    recommendation_rows,
)
from ratewise.operators.serving import (
    PRECOMPUTED_SOURCE,
    check_users,
    find_recommendations,
    latest_served,
    serve,
    serving_metrics,
    titled_recommendations,
)
from ratewise.plans.streams import start_from_files
from ratewise.plans.training import recommend_from_files, train_from_files, train_model
from ratewise.session import scratch_path
from ratewise.settings import Settings
from ratewise.sinks import write_recommendations
from ratewise.sources import read_recommendations, read_records, read_served
from ratewise.streaming import Outputs, encode_events, run_until_stopped

N_USERS, N_ITEMS = 30, 20


def all_ratings():
    """Even and odd users like opposite items; user u has rated u % 20 + 1 of them."""
    rows = []
    for user in range(1, N_USERS + 1):
        for item in range(1, N_ITEMS + 1):
            if item <= (user * 7) % N_ITEMS + 1:
                rows.append((user, item, 5.0 if (user + item) % 2 == 0 else 1.0, user * 100 + item))
    return rows


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(
        all_ratings(), "user_id int, movie_id int, rating float, timestamp long"
    )


@pytest.fixture(scope="module")
def model(ratings):
    return factors.fit_als(ratings, rank=4, max_iter=5, blocks=4)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(i, f"Item {i}", "G") for i in range(1, N_ITEMS)], "movie_id int, title string, genres string"
    )


@pytest.fixture(scope="module")
def popular(ratings, items):
    return popular_items(ratings, items, n=3, min_ratings=10).persist()


def scores(model):
    """Every user's score of every item, from the factors."""
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    parts = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    return {u: {i: float(f @ g) for i, g in parts.items()} for u, f in users.items()}


def test_popularity_and_popular_items(spark, items):
    rows = (
        [(1, 1, 5.0)] * 2
        + [(1, 2, 4.0)] * 3
        + [(1, 3, 4.0)] * 4
        + [(1, 20, 4.5)] * 3
        + [(1, 4, 1.0)] * 9
    )
    df = spark.createDataFrame(rows, "user_id int, movie_id int, rating float")
    assert {tuple(r) for r in item_popularity(df).collect()} == {
        (1, 2, 5.0),
        (2, 3, 4.0),
        (3, 4, 4.0),
        (20, 3, 4.5),
        (4, 9, 1.0),
    }
    got = [tuple(r) for r in popular_items(df, items, n=3, min_ratings=3).orderBy("rank").collect()]
    assert got == [
        (1, 20, "Unknown", 4.5, 3, POPULAR_NOTE),
        (2, 3, "Item 3", 4.0, 4, POPULAR_NOTE),
        (3, 2, "Item 2", 4.0, 3, POPULAR_NOTE),
    ]
    assert popular_items(df, items, min_ratings=100).count() == 0


def test_splits(spark, ratings):
    train, test = factors.hash_split(ratings)
    assert train.count() + test.count() == ratings.count()
    assert train.join(test, ["user_id", "movie_id"]).count() == 0
    other, _ = factors.hash_split(ratings.repartition(7))
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, train.collect()))
    assert "Exchange" not in plan_of(train)
    stored = factors.written_split(ratings, scratch_path(spark, "split"))
    keep = ("user_id", "movie_id", "rating")
    for got, want in zip(stored, (train, test)):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*keep).collect()))
    left, right = factors.random_split(ratings)
    assert left.count() + right.count() == ratings.count()


def test_rmse(spark):
    df = spark.createDataFrame([(5.0, 4.0), (1.0, 4.0)], "rating float, prediction float")
    assert factors.rmse(df).first()["rmse"] == pytest.approx(5**0.5)


def test_predictions_leave_out_unknown_ids(spark, model, ratings):
    extra = spark.createDataFrame(
        [(999, 1, 3.0, 1), (1, 999, 3.0, 1)], "user_id int, movie_id int, rating float, timestamp long"
    )
    predicted = factors.predict(model, ratings.unionByName(extra))
    assert predicted.count() == ratings.count()
    assert factors.evaluate(model, ratings) < 1.0


def test_tuning(spark, ratings):
    train, test = factors.hash_split(ratings)
    options = {"max_iter": 2, "blocks": 2}
    first = factors.train_and_score(train, test, rank=4, **options)
    assert factors.tune(first, train, test, threshold=100, **options) is first
    assert not first.tuned
    worse = factors.tune(first, train, test, grid=[(1, 50.0)], threshold=0.0, **options)
    assert worse.model is first.model and worse.tuned and len(worse.trials) == 2
    better = factors.tune(worse, train, test, grid=[(6, 0.01)], threshold=0.0, max_iter=8, blocks=2)
    assert better.rmse == min(r for _, _, r in better.trials)
    table = factors.trial_table(spark, better).orderBy("trial").collect()
    assert [(r["rank"], r["reg"]) for r in table] == [(4, 0.1), (1, 50.0), (6, 0.01)]


def test_recommend_all_keeps_seen_items_and_is_sorted(model):
    expected = scores(model)
    rows = recommendation_rows(recommend_all(model, 3)).collect()
    assert len(rows) == N_USERS * 3
    for user in range(1, N_USERS + 1):
        mine = sorted((r for r in rows if r["user_id"] == user), key=lambda r: r["rank"])
        best = sorted(expected[user].values(), reverse=True)[:3]
        assert [r["rank"] for r in mine] == [1, 2, 3]
        assert [r["rating"] for r in mine] == pytest.approx(best, rel=1e-5)


@pytest.mark.parametrize("n", [1, 5])
def test_subset_gives_the_best_unseen_items(spark, model, ratings, n):
    """Against brute force over all factors, for users who have seen 1 to 20 items."""
    expected = scores(model)
    seen = {}
    for user, item, *_ in all_ratings():
        seen.setdefault(user, set()).add(item)
    users = spark.createDataFrame([(u,) for u in [*range(1, 21), 1, 999]], "user_id int")
    doubled = ratings.unionByName(ratings)
    rows = recommend_subset(model, users, doubled, n).collect()
    for user in range(1, 21):
        mine = sorted((r for r in rows if r["user_id"] == user), key=lambda r: r["rank"])
        unseen = sorted((s for i, s in expected[user].items() if i not in seen[user]), reverse=True)
        assert [r["rating"] for r in mine] == pytest.approx(unseen[:n], rel=1e-5), user
        assert not seen[user] & {r["movie_id"] for r in mine}
    assert not [r for r in rows if r["user_id"] == 999]


@pytest.mark.parametrize("blocks", [(1, 1), (3, 4), (1000, 7)])
def test_subset_is_the_same_in_blocks_of_any_size(spark, model, ratings, blocks):
    users = spark.createDataFrame([(u,) for u in range(1, 31)], "user_id int")
    want = recommend_subset(model, users, ratings, 4).collect()
    got = recommend_subset(model, users, ratings, 4, *blocks).collect()
    assert {(r["user_id"], r["rank"], r["movie_id"]) for r in got} == {
        (r["user_id"], r["rank"], r["movie_id"]) for r in want
    }


def test_equal_scores_go_by_id(spark, model, ratings):
    """Items of equal factors, and a user without any: the lower ids win."""
    flat = SimpleNamespace(
        rank=2,
        userFactors=spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 2.0])], "id int, features array<float>"),
        itemFactors=spark.createDataFrame([(i, [1.0, 1.0]) for i in range(1, 40)], "id int, features array<float>"),
    )
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    rated = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (2, 99)], "user_id int, movie_id int")
    rows = recommend_subset(flat, users, rated, 3, 1, 5).orderBy("user_id", "rank").collect()
    assert [(r["user_id"], r["movie_id"], r["rating"]) for r in rows] == [
        (1, 1, 0.0), (1, 3, 0.0), (1, 4, 0.0), (2, 2, 3.0), (2, 4, 3.0), (2, 5, 3.0),
    ]


def test_factors_are_optimal_for_their_own_settings_only(spark, model, ratings):
    train = ratings
    fitted = factors.fit_als(train, rank=3, reg=0.1, max_iter=3, blocks=2)
    rows = factors.optimality(fitted, train, reg=0.1).collect()
    assert len(rows) == N_USERS and all(r["optimal"] for r in rows)
    assert sum(r["n_ratings"] for r in rows) == train.count()
    other = factors.optimality(fitted, train, reg=0.5).collect()
    assert sum(r["optimal"] for r in other) == 0
    less = factors.optimality(fitted, train.filter("movie_id > 3"), reg=0.1).collect()
    assert sum(r["optimal"] for r in less) < N_USERS / 2


def test_subset_of_unknown_users_is_empty(spark, model, ratings):
    users = spark.createDataFrame([(999,)], "user_id int")
    assert recommend_subset(model, users, ratings).count() == 0


def test_known_and_cold_users(spark, model):
    users = spark.createDataFrame([(1,), (1,), (999,), (5,)], "user_id int")
    known = known_users(users, model)
    assert sorted(r[0] for r in known.collect()) == [1, 5]
    assert [r[0] for r in cold_users(users, known).collect()] == [999]


def test_recommend_with_fallback(spark, model, ratings, items, popular):
    """Known, unknown, and one who has seen every item (user 17: 7 * 17 % 20 = 19)."""
    users = spark.createDataFrame([(1,), (17,), (999,), (1000,)], "user_id int")
    rows = recommend(model, users, ratings, items, popular, n=2).collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r["user_id"], []).append(r)
    assert set(by_user) == {1, 999, 1000}
    assert {r["note"] for r in by_user[1]} == {None}
    assert {u: {r["source"] for r in mine} for u, mine in by_user.items()} == {
        1: {"model"}, 999: {"popular"}, 1000: {"popular"},
    }
    assert all(r["predicted_rating"] is not None and r["avg_rating"] is None for r in by_user[1])
    best = [(r["rank"], r["movie_id"], r["avg_rating"]) for r in popular.orderBy("rank").collect()][:2]
    for user in (999, 1000):
        mine = sorted(by_user[user], key=lambda r: r["rank"])
        assert [(r["rank"], r["movie_id"], r["avg_rating"]) for r in mine] == best
        assert {r["note"] for r in mine} == {POPULAR_NOTE}
    assert "NestedLoop" not in plan_of(recommend(model, users, ratings, items, popular, 2))


@pytest.fixture(scope="module")
def table(spark, model, items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("recs") / "table")
    write_recommendations(titled_recommendations(recommend_all(model, 3), items), path, buckets=8)
    return read_recommendations(spark, path)


def test_serving_is_the_same_in_every_way(spark, model, items, popular, table):
    users = spark.createDataFrame([(u,) for u in (1, 2, 3, 3, 999)], "user_id int")
    plain = recommend_all(model, 3)
    subquery, pinned = popular_list(popular).scalar(), pinned_list(popular)
    distinct = users.distinct()
    results = [
        serve(users, plain, items, subquery),
        serve(users, table, items, subquery),
        serve(users, table, items, pinned),
        serve(distinct, table, items, pinned, check_users(distinct, table)),
        serve(distinct, table, items, pinned, check_users(distinct, table, limit=1)),
        serve(distinct, plain, items, pinned, check_users(distinct, plain)),
    ]
    rows = [sorted(map(tuple, r.collect())) for r in results]
    assert all(r == rows[0] for r in rows[1:])
    assert [(r[0], r[2]) for r in rows[0]] == [
        (1, PRECOMPUTED_SOURCE),
        (2, PRECOMPUTED_SOURCE),
        (3, PRECOMPUTED_SOURCE),
        (999, POPULAR_NOTE),
    ]
    names = popular.orderBy("rank").collect()
    assert rows[0][3][3] == " | ".join(f"{r['title']} ({r['avg_rating']:.2f})" for r in names)
    expected = scores(model)
    for user, recs, _, display in rows[0][:3]:
        best = sorted(expected[user].values(), reverse=True)[:3]
        assert [r["predicted_rating"] for r in recs] == pytest.approx(best, abs=1e-3)
        assert display == " | ".join(f"{r['title']} ({r['predicted_rating']:.2f})" for r in recs)
        for r in recs:
            title = f"Item {r['movie_id']}" if r["movie_id"] < N_ITEMS else f"Movie {r['movie_id']}"
            assert r["title"] == title


def test_few_users_read_only_their_directories(spark, table):
    users = spark.createDataFrame([(4,)], "user_id int")
    check = check_users(users, table)
    assert (check.n_users, len(check.buckets), check.few) == (1, 1, True)
    for found in (
        find_recommendations(users, table, check),
        find_recommendations(users, table, replace(check, ids=None)),
    ):
        text = plan_of(found)
        assert "Exchange hashpartitioning" not in text
        assert ("In(user_id, [4])" in text or "EqualTo(user_id,4)" in text) != ("BroadcastHashJoin" in text)
    assert "user_bucket_of_8" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert [r["user_id"] for r in found.collect()] == [4]


def scanned(df) -> int:
    """Rows that the file scans of a query that has run gave."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(
        leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
    )


def test_named_users_read_few_row_groups(spark, tmp_path):
    """Forty of 100,000 users, in row groups of some 170 rows: one such group each."""
    recs = spark.range(100_000).selectExpr(
        "cast(id as int) user_id",
        "array(named_struct('movie_id', 1, 'title', uuid(), 'rating', cast(1 as float))) recommendations",
    )
    path = str(tmp_path / "recs")
    write_recommendations(recs, path, buckets=2, row_group_bytes=4096)
    table = read_recommendations(spark, path)
    users = spark.range(0, 100_000, 2500).selectExpr("cast(id as int) user_id")
    check = check_users(users, table)
    assert len(check.ids) == 40
    found = find_recommendations(users, table, check)
    assert len(found.collect()) == 40
    assert scanned(found) < 100_000 / 10
    everything = find_recommendations(users, table, replace(check, ids=None))
    assert len(everything.collect()) == 40


def test_many_users_are_not_broadcast(spark, table):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        users = spark.range(100).selectExpr("cast(id as int) user_id")
        check = check_users(users, table, limit=99)
        assert not check.few
        assert "Broadcast" not in plan_of(find_recommendations(users, table, check))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_served_tables(spark):
    served = spark.createDataFrame(
        [(1, 10.0, 0), (1, 20.0, 3), (2, 30.25, 1)], "user_id int, latency_ms double, batch_id long"
    )
    assert sorted(map(tuple, latest_served(served).collect())) == [(1, 20.0, 3), (2, 30.25, 1)]
    row = serving_metrics(served, spark.range(4), target_ms=20).first()
    assert tuple(row) == (3, round(60.25 / 3, 1), 2, 4)


def test_train_model_tunes_only_above_the_threshold(spark, ratings, tmp_path):
    calm = train_model(ratings, str(tmp_path / "a"), Settings(rank=2, max_iter=2, rmse_threshold=9.0), 2)
    summary = calm.summary.first()
    assert not summary["tuned"]
    assert summary["n_train"] + summary["n_test"] == ratings.count()
    assert factors.load_model(str(tmp_path / "a")).rank == 2


def test_from_files_to_recommendations(spark, tmp_path):
    ratings, movies = tmp_path / "ratings.dat", tmp_path / "movies.dat"
    ratings.write_text("".join(f"{u}::{i}::{int(r)}::{t}\n" for u, i, r, t in all_ratings()) + "bad\n")
    movies.write_text("".join(f"{i}::Item {i}::G\n" for i in range(1, N_ITEMS + 1)))
    settings = Settings(rank=2, max_iter=2, popular_min_ratings=10, top_n=4, user_buckets=4)
    summary = train_from_files(
        spark, str(ratings), str(movies), str(tmp_path / "model"), str(tmp_path / "recs"), settings, 2
    ).first()
    assert summary["n_train"] + summary["n_test"] == len(all_ratings())
    stored = read_recommendations(spark, str(tmp_path / "recs"))
    first = stored.first()["recommendations"]
    assert len(first) == 4 and first[0]["title"] == f"Item {first[0]['movie_id']}"
    users = spark.createDataFrame([(1,), (9999,)], "user_id int")
    rows = recommend_from_files(users, str(tmp_path / "model"), str(ratings), str(movies), settings)
    assert {r["user_id"] for r in rows.filter(F.col("note").isNotNull()).collect()} == {9999}
    records, out = str(tmp_path / "records"), Outputs(str(tmp_path / "out"))
    encode_events(spark.createDataFrame(
        [(1, 1, 5.0, 1), (9999, 2, 4.0, 2)], "user_id int, movie_id int, rating float, timestamp long"
    )).write.parquet(records)
    run_until_stopped(
        start_from_files(
            read_records(spark, records), str(ratings), str(movies), str(tmp_path / "recs"), out,
            str(tmp_path / "checkpoint"), {"availableNow": True}, settings,
        )
    )
    served = {r["user_id"]: r["source"] for r in read_served(spark, out.served).collect()}
    assert served == {1: PRECOMPUTED_SOURCE, 9999: POPULAR_NOTE}
    assert spark.read.parquet(out.item_windows).count() == 6
