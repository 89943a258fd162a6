import json

import pytest
from pyspark.errors import AnalysisException

from plans_helper import plan_of
from ratewise.operators.cleaning import clean_ratings
from ratewise.sinks import alert_lines, kafka_sink_options, write_batch, write_kafka, write_served
from ratewise.sources import (
    distinct_items,
    kafka_records,
    kafka_source_options,
    newest_batches,
    read_alert_lines,
    read_items,
    read_rating_lines,
    read_ratings,
    read_newest,
    read_recommendations,
    read_served,
    read_served_files,
)


RATINGS = """1::1193::5::978300760
x::2::3::978300760
0::5::4::978300760
2::7::6::978300760
3::8::::978300760
4::9::3::1
4::9::2::2
4::9::1::2
5::1::4::7::8
6::1
"""


@pytest.fixture
def ratings_file(tmp_path):
    path = tmp_path / "ratings.dat"
    path.write_text(RATINGS)
    return str(path)


def test_read_ratings_gives_null_for_bad_fields(spark, ratings_file):
    rows = [tuple(r) for r in read_ratings(spark, ratings_file).collect()]
    assert rows[0] == (1, 1193, 5.0, 978300760)
    assert rows[1] == (None, 2, 3.0, 978300760)
    assert rows[4] == (3, 8, None, 978300760)
    assert rows[8] == (5, 1, 4.0, 7)
    assert rows[9] == (6, 1, None, None)


def test_clean_ratings_of_the_file(spark, ratings_file):
    rows = {tuple(r)[:4] for r in clean_ratings(read_ratings(spark, ratings_file)).collect()}
    assert rows == {(1, 1193, 5.0, 978300760), (4, 9, 2.0, 2), (5, 1, 4.0, 7)}


def test_rating_lines_need_four_fields_that_parse(spark, ratings_file):
    rows = sorted(tuple(r) for r in read_rating_lines(spark, ratings_file).collect())
    assert rows == [
        (0, 5, 4.0, 978300760),
        (1, 1193, 5.0, 978300760),
        (2, 7, 6.0, 978300760),
        (4, 9, 1.0, 2),
        (4, 9, 2.0, 2),
        (4, 9, 3.0, 1),
    ]


def test_items_are_latin1_and_strict_leaves_out_odd_lines(spark, tmp_path):
    path = tmp_path / "movies.dat"
    path.write_bytes(
        "1::Misérables, Les (1995)::Drama\n2::Face::Off::Action\nx::No id::Drama\n"
        "1::Misérables, Les (1995)::Drama\n".encode("latin-1")
    )
    rows = [tuple(r) for r in read_items(spark, str(path)).collect()]
    assert rows[0] == (1, "Misérables, Les (1995)", "Drama")
    assert rows[1] == (2, "Face", "Off")
    strict = read_items(spark, str(path), strict=True)
    assert {tuple(r) for r in strict.collect()} == {(1, "Misérables, Les (1995)", "Drama")}
    assert distinct_items(strict).count() == 1


def test_kafka_options(spark):
    assert kafka_source_options("b:9092", "ratings") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "ratings",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    options = kafka_sink_options("b:9092", "ratings")
    assert options["kafka.acks"] == "all" and options["topic"] == "ratings"


def test_kafka_needs_the_connector(spark):
    """The connector isn't part of this installation; the calls must reach it."""
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_records(spark, "b:9092", "ratings")
    records = spark.createDataFrame([(b"0", b"{}", 0)], "key binary, value binary, partition int")
    with pytest.raises(AnalysisException, match="kafka"):
        write_kafka(records, "b:9092", "ratings")


def test_served_round_trip_skips_bad_lines_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "served")
    served = spark.createDataFrame(
        [(1, [(7, "A", 4.5)], "s", "A (4.50)")],
        "user_id int, recommendations array<struct<movie_id int, title string,"
        " predicted_rating double>>, source string, display string",
    )
    for batch_id in (0, 1, 1, 2):
        write_served(served, path, batch_id, 12.3456)
    (tmp_path / "served" / "batch_id=2" / "bad.json").write_text("{broken\n")
    got = read_served(spark, path)
    assert sorted((r["user_id"], r["batch_id"], r["latency_ms"]) for r in got.collect()) == [
        (1, 0, 12.35),
        (1, 1, 12.35),
        (1, 2, 12.35),
    ]
    assert sorted(r["batch_id"] for r in newest_batches(got, 2).collect()) == [1, 2]
    newest = read_newest(spark, path, 2)
    assert sorted(r["batch_id"] for r in newest.collect()) == [1, 2]
    text = plan_of(newest)
    assert "batch_id" in text.split("PartitionFilters: [")[1].split("]")[0]
    files = (tmp_path / "served" / "batch_id=0").glob("part-*.json")
    assert json.loads("".join(f.read_text() for f in files)) == {
        "user_id": 1,
        "recommendations": [{"movie_id": 7, "title": "A", "predicted_rating": 4.5}],
        "latency_ms": 12.35,
        "source": "s",
    }


def test_served_files_named_by_batch(spark, tmp_path):
    record = '{"user_id": 4, "recommendations": [], "latency_ms": 1.0, "source": "s"}\n'
    for batch_id in (7, 12):
        (tmp_path / f"batch_{batch_id}.json").write_text(record)
    assert sorted(r["batch_id"] for r in read_served_files(spark, str(tmp_path)).collect()) == [7, 12]


def test_warm_table_is_cached(spark, tmp_path):
    path = str(tmp_path / "recs")
    spark.range(3).write.parquet(path)
    table = read_recommendations(spark, path, warm=True)
    assert table.is_cached and table.count() == 3
    table.unpersist()


def test_alert_log_round_trip(spark, tmp_path):
    messages = [
        "🔴 ALERT [RATING SPIKE] Item 1 (Trending [TRENDING]) avg_rating=5.00 > 4.5",
        "🔥 ALERT [TRENDING] Item 2 (B) trending_score=30.00 > 30",
    ]
    alerts = spark.createDataFrame(
        [("2024-01-02 03:04:05", m) for m in messages], "t string, message string"
    ).selectExpr("cast(t as timestamp) alert_time", "message")
    path = str(tmp_path / "log")
    alert_lines(alerts).write.text(path)
    (tmp_path / "log" / "more.txt").write_text("\n   \nno alert\n")
    rows = read_alert_lines(spark, path).selectExpr(
        "cast(alert_time as string)", "alert_type", "message"
    )
    assert sorted(map(tuple, rows.collect()), key=lambda r: r[2]) == sorted(
        [
            ("2024-01-02 03:04:05", "RATING SPIKE", messages[0]),
            ("2024-01-02 03:04:05", "TRENDING", messages[1]),
            (None, None, "no alert"),
        ],
        key=lambda r: r[2],
    )


def test_batch_sink_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        write_batch(spark.range(3), path, 5)
    rows = spark.read.parquet(path)
    assert rows.count() == 3
    assert {r["batch_id"] for r in rows.collect()} == {5}
