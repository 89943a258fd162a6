import json
import os
from dataclasses import replace

import pytest
from plans_helper import plan_of
from pyspark.sql import functions as F

from ratewise.operators.alerts import first_alerts
from ratewise.operators.popularity import popular_items
from ratewise.operators.windows import item_windows, latest_version, user_windows
from ratewise.settings import Settings
from ratewise.sources import read_records, read_served
from ratewise.streaming import handlers
from ratewise.streaming import (
    Outputs,
    encode_events,
    parse_events,
    run_until_stopped,
    start_queries,
    stop_all,
    write_replay,
)

SETTINGS = Settings(popular_min_ratings=1)


def records(spark, values):
    return spark.createDataFrame(
        [(b"0", v if isinstance(v, bytes) else v.encode(), 0) for v in values],
        "key binary, value binary, partition int",
    )


def event(user=1, item=1, rating=3.0, second=0):
    time = f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}"
    return json.dumps({"user_id": user, "item_id": item, "rating": rating, "timestamp": time})


def write_file(spark, path, values, number):
    """One file, with modification times in order."""
    before = set(os.listdir(path)) if os.path.isdir(path) else set()
    records(spark, values).coalesce(1).write.mode("append").parquet(path)
    for name in set(os.listdir(path)) - before:
        os.utime(f"{path}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.fixture
def sides(spark):
    items = spark.createDataFrame(
        [(1, "One", "G"), (2, "Two", "G")], "movie_id int, title string, genres string"
    )
    recs = spark.createDataFrame(
        [(1, [(2, 4.25), (7, 4.0)])],
        "user_id int, recommendations array<struct<movie_id int, rating float>>",
    )
    popular = spark.createDataFrame(
        [(1, 1, "One", 4.5, 9, "note")],
        "rank int, movie_id int, title string, avg_rating double, num_ratings long, note string",
    )
    return recs, items, popular


def run_once(spark, source, sides, root, files_per_trigger=1, **options):
    out = Outputs(f"{root}/out")
    queries = start_queries(
        parse_events(read_records(spark, source, files_per_trigger)),
        *sides,
        out,
        f"{root}/checkpoint",
        {"availableNow": True},
        options.pop("settings", SETTINGS),
        **options,
    )
    run_until_stopped(queries)
    return out


def table(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_parse_events(spark):
    good = event(5, 6, 4.5, 30)
    odd_time = '{"user_id":1,"item_id":2,"rating":3.0,"timestamp":"2000"}'
    spaced = '{"user_id":1,"item_id":3,"rating":3.0,"timestamp":"2000-12-31 18:22:40"}'
    extra = '{"user_id":1,"item_id":4,"rating":3,"timestamp":"2000-12-31T18:22:40","more":[1]}'
    bad = [
        "garbage",
        "[]",
        "",
        '{"user_id":1,"item_id":2,"rating":3.0}',
        '{"user_id":"x","item_id":2,"rating":3.0,"timestamp":"2000"}',
        '{"user_id":1,"item_id":2,"rating":"4.0","timestamp":"2000"}',
        '{"user_id":1.0,"item_id":2,"rating":4.0,"timestamp":"2000"}',
        '{"user_id":null,"item_id":2,"rating":4.0,"timestamp":"2000"}',
    ]
    rows = parse_events(records(spark, [good, odd_time, spaced, extra, *bad])).withColumn(
        "event_time", F.col("event_time").cast("string")
    )
    assert sorted(map(tuple, rows.collect())) == [
        (1, 2, 3.0, "2000", None),
        (1, 3, 3.0, "2000-12-31 18:22:40", None),
        (1, 4, 3.0, "2000-12-31T18:22:40", "2000-12-31 18:22:40"),
        (5, 6, 4.5, "2024-01-01T00:00:30", "2024-01-01 00:00:30"),
    ]


def test_encode_events(spark):
    df = spark.createDataFrame(
        [(1, 1193, 5.0, 978300760), (2, 8, 4.0, 978300000)],
        "user_id int, movie_id int, rating float, timestamp long",
    )
    rows = encode_events(df).collect()
    assert [(bytes(r["key"]), r["partition"]) for r in rows] == [(b"0", 0), (b"1", 1)]
    assert json.loads(bytes(rows[1]["value"])) == {
        "user_id": 1,
        "item_id": 1193,
        "rating": 5.0,
        "timestamp": "2000-12-31T22:12:40",
    }
    back = parse_events(encode_events(df)).select("user_id", "item_id", "rating")
    assert sorted(map(tuple, back.collect())) == [(1, 1193, 5.0), (2, 8, 4.0)]
    # A negative item id has a partition too, and one partition takes all.
    negative = df.withColumn("movie_id", -F.col("movie_id"))
    assert {r["partition"] for r in encode_events(negative, 3).collect()} <= {0, 1, 2}


def test_replay_files_are_in_time_order(spark, tmp_path):
    df = spark.range(100).selectExpr(
        "cast(id % 7 as int) user_id", "cast(id % 5 as int) movie_id", "cast(3 as float) rating",
        "1000 + (id * 37) % 100 as timestamp",
    )
    path = str(tmp_path / "replay")
    write_replay(df, path, 4)
    files = sorted((f for f in os.scandir(path) if f.name.endswith(".parquet")), key=lambda f: f.stat().st_mtime_ns)
    times = []
    for f in files:
        parsed = parse_events(spark.read.parquet(f.path)).agg(F.min("timestamp"), F.max("timestamp"))
        low, high = parsed.first()
        times.append((low, high))
    times = [t for t in times if t[0]]
    assert len(times) >= 4
    assert all(a[1] <= b[0] for a, b in zip(times, times[1:]) if a != b)
    assert spark.read.parquet(path).count() == 100
    write_replay(df.filter("false"), str(tmp_path / "none"), 4)


def test_late_rows_lose_the_windows_that_are_closed(spark, sides, tmp_path):
    """Five copies are dropped: all of second 10, two of second 62, none of second 82."""
    source = str(tmp_path / "source")
    for number, seconds in enumerate([(5, 20), (100,), (101,), (62, 10, 82), (130,)]):
        write_file(spark, source, [event(second=s) for s in seconds], number)
    out = run_once(spark, source, sides, tmp_path)
    got = latest_version(spark.read.parquet(out.item_windows), ["window_start", "item_id"])
    counts = {r["window_start"].strftime("%H:%M:%S"): r["interaction_count"] for r in got.collect()}
    kept = [5, 20, 100, 101, 130, 82, 62]
    expected = {}
    for second in kept:
        for k in range(3):
            start = second // 10 * 10 - 10 * k
            if second == 62 and start < 60:
                continue
            clock = f"23:59:{60 + start:02d}" if start < 0 else f"00:{start // 60:02d}:{start % 60:02d}"
            expected[clock] = expected.get(clock, 0) + 1
    assert counts == expected


def test_stream_equals_batch_and_survives_a_restart(spark, sides, tmp_path):
    """In time order nothing is late; the run is split in two by a restart."""
    source = str(tmp_path / "source")
    rows = [(s * 13 % 7, s * 5 % 3 + 1, float(s % 5 + 1), s) for s in range(0, 300, 3)]
    slices = [rows[i : i + 25] for i in range(0, len(rows), 25)]
    for number, part in enumerate(slices[:2]):
        write_file(spark, source, [event(*r) for r in part], number)
    out = run_once(spark, source, sides, tmp_path)
    before = spark.read.parquet(out.item_windows).count()
    for number, part in enumerate(slices[2:]):
        write_file(spark, source, [event(*r) for r in part], 2 + number)
    run_once(spark, source, sides, tmp_path)
    events = parse_events(spark.read.parquet(source))

    def flat(df):
        return df.select("window.start", "window.end", *(c for c in df.columns if c != "window")).toDF(
            "window_start", "window_end", *(c for c in df.columns if c != "window")
        )

    written = spark.read.parquet(out.item_windows)
    assert written.count() > before
    keys = ["window_start", "window_end"]
    assert table(latest_version(written, [*keys, "item_id"])) == table(flat(item_windows(events)))
    users = latest_version(spark.read.parquet(out.user_windows), [*keys, "user_id"])
    assert table(users) == table(flat(user_windows(events)))
    # Nothing to do: a third start changes nothing.
    count = written.count()
    run_once(spark, source, sides, tmp_path)
    assert spark.read.parquet(out.item_windows).count() == count


def test_alerts_and_served_records(spark, sides, tmp_path):
    source = str(tmp_path / "source")
    write_file(spark, source, [event(1, 1, 5.0, 5), event(9, 2, 1.0, 5)], 0)
    many = [event(1, 1, 3.0, 6) for _ in range(12)]
    no_time = '{"user_id":4,"item_id":2,"rating":3.0,"timestamp":"2000"}'
    write_file(spark, source, [*many, no_time], 1)
    out = run_once(spark, source, sides, tmp_path)
    alerts = spark.read.parquet(out.item_alerts)
    once = first_alerts(alerts)
    kinds = {(r["alert_type"], r["batch_id"]): r["n"] for r in once.groupBy("alert_type", "batch_id").agg(F.count("*").alias("n")).collect()}
    # The lone five-star vote fires in batch 0; the score of 13 rows in batch 1.
    assert kinds == {("RATING SPIKE", 0): 3, ("TRENDING", 1): 3}
    assert {r["title"] for r in alerts.collect()} == {"One"}
    users = spark.read.parquet(out.user_alerts).collect()
    assert {(r["entity_id"], r["metric"]) for r in users} == {(1, 13.0)}
    top = spark.read.parquet(out.trending)
    best = top.filter("batch_id = 1").orderBy(F.desc("trending_score"), F.desc("window_start")).first()
    assert (best["item_id"], best["title"], best["trending_score"]) == (1, "One", 41.0)
    active = spark.read.parquet(out.active_users).filter("batch_id = 0")
    assert {r["user_id"] for r in active.collect()} == {1, 9}
    served = read_served(spark, out.served)
    got = {(r["batch_id"], r["user_id"]): r for r in served.collect()}
    assert set(got) == {(0, 1), (0, 9), (1, 1), (1, 4)}
    assert [tuple(r) for r in got[0, 1]["recommendations"]] == [(2, "Two", 4.25), (7, "Movie 7", 4.0)]
    assert got[0, 1]["source"] == "precomputed ALS recommendations"
    assert [tuple(r) for r in got[1, 4]["recommendations"]] == [(1, "One", 4.5)]
    assert all(r["latency_ms"] > 0 for r in got.values())


def test_top_n_limits_the_alert_check(spark, sides, tmp_path):
    source = str(tmp_path / "source")
    values = [event(1, 1, 5.0, 5)] * 10 + [event(2, 2, 5.0, 5)] * 2
    write_file(spark, source, values, 0)
    out = run_once(spark, source, sides, tmp_path, alert_top_n=3)
    assert {r["entity_id"] for r in spark.read.parquet(out.item_alerts).collect()} == {1}


def test_one_failing_query_stops_the_others(spark, sides, tmp_path):
    source = str(tmp_path / "source")
    write_file(spark, source, [event()], 0)
    recs, items, popular = sides
    broken = recs.withColumn("recommendations", F.raise_error(F.lit("broken")).cast("array<struct<movie_id int, rating float>>"))
    queries = start_queries(
        parse_events(read_records(spark, source)), broken, items, popular,
        Outputs(str(tmp_path / "out")), str(tmp_path / "checkpoint"), {"processingTime": "1 second"}, SETTINGS,
    )
    with pytest.raises(Exception, match="broken"):
        run_until_stopped(queries)
    assert not any(q.isActive for q in queries.values())
    stop_all(queries)


def test_windows_are_derived_from_the_written_batch_without_a_broadcast(
    spark, sides, tmp_path, monkeypatch
):
    """Tasks over a stateful batch, persisted or not, report on all state partitions."""
    plans = []

    def seen(name):
        original = getattr(handlers, name)

        def derive(windows, *args, **options):
            out = original(windows, *args, **options)
            plans.append((plan_of(windows), plan_of(out)))
            return out

        monkeypatch.setattr(handlers, name, derive)

    for name in ("item_alerts", "top_trending", "with_title"):
        seen(name)
    write_file(spark, f"{tmp_path}/in", [event(1, 1, 5.0, s) for s in range(8)], 0)
    items = f"{tmp_path}/items"
    sides[1].write.parquet(items)
    out = run_once(
        spark, f"{tmp_path}/in", (sides[0], spark.read.parquet(items), sides[2]), str(tmp_path)
    )
    assert len(plans) >= 3
    for source, derived in plans:
        assert "StateStore" not in source and "InMemoryTableScan" not in source
        assert "BroadcastHashJoin" not in derived
    # A micro-batch without updates, after the last one with rows, leaves no directory.
    for path in (out.item_windows, out.item_alerts, out.trending):
        assert [d for d in os.listdir(path) if d.startswith("batch_id")] == ["batch_id=0"]


def test_state_partitions_are_those_of_the_settings(spark, sides, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    write_file(spark, f"{tmp_path}/in", [event(1, i, 5.0, i) for i in range(1, 9)], 0)
    run_once(
        spark, f"{tmp_path}/in", sides, str(tmp_path),
        settings=replace(SETTINGS, state_partitions=2),
    )
    for name in ("item_windows", "user_windows"):
        parts = os.listdir(f"{tmp_path}/checkpoint/{name}/state/0")
        assert sorted(p for p in parts if p.isdigit()) == ["0", "1"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_popular_titles_are_not_broadcast(spark, tmp_path):
    spark.range(50).selectExpr(
        "cast(id as int) movie_id", "cast(id as string) title", "'' genres"
    ).write.parquet(f"{tmp_path}/items")
    items = spark.read.parquet(f"{tmp_path}/items")
    ratings = spark.range(90).selectExpr("cast(id % 9 as int) movie_id", "4.0 rating")
    top = popular_items(ratings, items, 3, 1)
    assert "BroadcastHashJoin" not in plan_of(top)
    assert [(r["movie_id"], r["title"]) for r in top.orderBy("rank").collect()] == [
        (0, "0"), (1, "1"), (2, "2")
    ]
