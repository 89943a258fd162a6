"""Separators, durations, splits, replays and stops that used to go wrong."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ratewise.operators import factors
from ratewise.operators.windows import item_windows
from ratewise.sources import read_items, read_rating_lines
from ratewise.streaming.replay import replay_slices
from ratewise.streaming.runner import stop_all


@pytest.mark.parametrize("sep", ["|", ".", "\t", "::", "$^"])
def test_separator_is_literal(spark, tmp_path, sep):
    lines = [sep.join(x) for x in (["1", "10", "4", "978300760"], ["2", "20", "3", "978300761"])]
    (tmp_path / "r.dat").write_text("\n".join(lines) + "\nbad\n")
    got = {tuple(r) for r in read_rating_lines(spark, str(tmp_path / "r.dat"), sep).collect()}
    assert got == {(1, 10, 4.0, 978300760), (2, 20, 3.0, 978300761)}
    (tmp_path / "i.dat").write_text(sep.join(["7", "A", "B"]) + "\n")
    items = read_items(spark, str(tmp_path / "i.dat"), sep, strict=True).collect()
    assert [tuple(r) for r in items] == [(7, "A", "B")]


@pytest.mark.parametrize("length", ["1 week", "interval 7 days", "7 days"])
def test_durations_as_spark_takes_them(spark, length):
    rows = [(1, 4.0, dt.datetime(2024, 1, d)) for d in (1, 2, 9)]
    df = spark.createDataFrame(rows, "item_id int, rating float, event_time timestamp")
    got = item_windows(df, length, "1 day")
    assert got.agg(F.sum("interaction_count")).first()[0] == 3 * 7


def test_split_keeps_its_fraction_and_both_sides(spark):
    assert factors.split_parts(0.8) == (80, 100)
    assert factors.split_parts(0.995) == (995, 1000)
    rows = spark.range(10).select(F.col("id").alias("user_id"), F.col("id").alias("movie_id"))
    with pytest.raises(ValueError, match="no test rows"):
        factors.tag_split(rows, 100, 100)


def test_no_prediction_is_the_worst_error(spark):
    schema = "user_id int, movie_id int, rating float"
    train = spark.createDataFrame([(u, i, 3.0) for u in (1, 2) for i in (1, 2)], schema)
    test = spark.createDataFrame([(9, 9, 3.0)], schema)
    first = factors.train_and_score(train, test, 2, 0.1, max_iter=1)
    assert first.rmse == math.inf
    best = factors.tune(first, train, test, grid=[(2, 0.2)], max_iter=1)
    assert len(best.trials) == 2


def test_model_is_the_same_on_other_cores(spark):
    """The blocks are a setting, so partitions and cores leave the factors as they are."""
    schema = "user_id int, movie_id int, rating float"
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(1, 9) for i in range(1, 9)]
    one = factors.fit_als(spark.createDataFrame(rows, schema).coalesce(1), 2, max_iter=2)
    many = factors.fit_als(spark.createDataFrame(rows, schema).repartition(7), 2, max_iter=2)

    def of(model):
        return {r.id: [round(x, 4) for x in r.features] for r in model.userFactors.collect()}

    assert of(one) == of(many)


def test_replay_leaves_out_ratings_without_time(spark):
    df = spark.createDataFrame(
        [(1, 1, 3.0, 10), (2, 1, 3.0, None), (3, 1, 3.0, 20)],
        "user_id int, movie_id int, rating float, timestamp bigint",
    )
    assert sum(s.count() for s in replay_slices(df, 2)) == 2


def test_all_queries_are_stopped_before_an_error_is_raised():
    class Query:
        def __init__(self, fails):
            self.fails, self.stopped = fails, False

        def stop(self):
            self.stopped = True
            if self.fails:
                raise RuntimeError("no")

    held = {"a": Query(True), "b": Query(False)}
    with pytest.raises(RuntimeError):
        stop_all(held)
    assert held["b"].stopped
