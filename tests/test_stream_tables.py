"""Upkeep of the tables that streams write."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from ratewise.operators.profiling import SKETCH_ERROR, cleaning_counts, daily_profiles, profile, profile_of_days
from ratewise.operators.serving import latest_served
from ratewise.operators.windows import _micros, item_windows, latest_version
from ratewise.sinks import write_alert_log, write_batch, write_served
from ratewise.sources import read_alert_lines, read_served
from ratewise.streaming import compact, compaction, merge_served, read_current, read_latest_served, remove_folded, snapshots
from ratewise.streaming.compaction import compacted_root
from ratewise.streaming.manifests import commit_state, newest_state
from plans_helper import plan_of

KEYS = ["window_start", "window_end", "item_id"]


def minute(m: int) -> datetime:
    return datetime(2024, 1, 1 + m // 1440, m // 60 % 24, m % 60, tzinfo=timezone.utc)


def add_batch(spark, table, batch_id, rows):
    """Rows (minute of the start, item, count) of windows of ten minutes."""
    data = [(minute(m), minute(m + 10), item, n) for m, item, n in rows]
    schema = "window_start timestamp, window_end timestamp, item_id int, n int"
    write_batch(spark.createDataFrame(data, schema), table, batch_id)


def rows_of(df):
    return sorted((r["window_start"], r["item_id"], r["n"]) for r in df.collect())


def by_scan(spark, table):
    return rows_of(latest_version(spark.read.parquet(table), KEYS))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "windows")
    add_batch(spark, path, 0, [(0, 1, 1), (0, 2, 1), (10, 1, 1)])
    add_batch(spark, path, 3, [(0, 1, 2), (10, 1, 2), (1430, 1, 1)])
    add_batch(spark, path, 4, [(10, 1, 3), (1430, 1, 2), (1440, 2, 1)])
    return path


def test_compaction_keeps_the_newest_versions(spark, table):
    before = by_scan(spark, table)
    assert rows_of(read_current(spark, table, ["item_id"])) == before
    assert compact(spark, table, ["item_id"], minute(10), 3) == 1
    assert rows_of(read_current(spark, table, ["item_id"])) == before
    assert compact(spark, table, ["item_id"], minute(1440), 4) == 2
    assert rows_of(read_current(spark, table, ["item_id"])) == before
    assert compact(spark, table, ["item_id"], minute(1440), 4) == 2  # nothing new
    add_batch(spark, table, 5, [(1440, 2, 4), (1450, 1, 1)])
    assert rows_of(read_current(spark, table, ["item_id"])) == by_scan(spark, table)
    assert {r["window_start"].date() for r in read_current(spark, table, ["item_id"], date(2024, 1, 2)).collect()} == {
        date(2024, 1, 2)
    }


def test_a_compaction_that_broke_off_has_no_effect(spark, table, monkeypatch):
    before = by_scan(spark, table)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "commit_state", broken)
    with pytest.raises(RuntimeError, match="lost"):
        compact(spark, table, ["item_id"], minute(10), 3)
    monkeypatch.undo()
    assert newest_state(spark, compacted_root(table)) == (0, {})
    assert rows_of(read_current(spark, table, ["item_id"])) == before
    assert compact(spark, table, ["item_id"], minute(10), 4) == 1
    assert rows_of(read_current(spark, table, ["item_id"])) == before
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        commit_state(spark, compacted_root(table), 1, {})


def test_a_read_lists_the_base_and_open_batches_only(spark, table):
    compact(spark, table, ["item_id"], minute(10), 3)
    files = read_current(spark, table, ["item_id"]).inputFiles()
    assert any("fold=" in f for f in files) and any("batch_id=4/" in f for f in files)
    assert not any("batch_id=0/" in f or "batch_id=3/" in f for f in files)
    # The base is taken as it is; only open rows are grouped.
    assert plan_of(read_current(spark, table, ["item_id"])).count("Exchange") == 1


def test_folded_batches_can_go(spark, table, monkeypatch):
    before = by_scan(spark, table)
    assert remove_folded(spark, table) == []
    monkeypatch.setattr(compaction, "commit_state", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compact(spark, table, ["item_id"], minute(10), 3)
    monkeypatch.undo()
    compact(spark, table, ["item_id"], minute(10), 3)
    gone = remove_folded(spark, table)
    assert sum("batch_id=" in p for p in gone) == 2 and sum("fold=" in p for p in gone) == 1
    assert rows_of(read_current(spark, table, ["item_id"])) == before
    compact(spark, table, ["item_id"], minute(2000), 4)
    remove_folded(spark, table)
    assert rows_of(read_current(spark, table, ["item_id"])) == before


def test_new_versions_of_closed_windows_are_refused(spark, table):
    compact(spark, table, ["item_id"], minute(10), 3)
    add_batch(spark, table, 5, [(0, 1, 9)])
    with pytest.raises(ValueError, match="closed"):
        compact(spark, table, ["item_id"], minute(20), 5)


def serve_batch(spark, path, batch_id, users):
    rows = [(u, [(batch_id, f"t{batch_id}", 1.0)], "s") for u in users]
    schema = "user_id int, recommendations array<struct<movie_id int, title string, predicted_rating double>>, source string"
    write_served(spark.createDataFrame(rows, schema), path, batch_id, 1.0)


def newest(df):
    return sorted((r["user_id"], r["batch_id"], r["recommendations"][0]["title"]) for r in df.collect())


def test_snapshot_equals_a_scan_of_everything(spark, tmp_path, monkeypatch):
    served, root = str(tmp_path / "served"), str(tmp_path / "latest")
    serve_batch(spark, served, 0, range(40))
    serve_batch(spark, served, 1, [3, 4, 50])
    assert newest(read_latest_served(spark, served, root)) == newest(latest_served(read_served(spark, served)))
    assert merge_served(spark, served, root, 0, buckets=8) == 1
    assert merge_served(spark, served, root, 0) == 1
    monkeypatch.setattr(snapshots, "commit_state", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merge_served(spark, served, root, 1)
    monkeypatch.undo()
    assert newest(read_latest_served(spark, served, root)) == newest(latest_served(read_served(spark, served)))
    _, first = newest_state(spark, root)
    assert merge_served(spark, served, root, 1) == 2
    _, second = newest_state(spark, root)
    # Only the buckets of the three users are written anew.
    assert 1 <= sum(first["files"][b] != second["files"][b] for b in first["files"]) <= 3
    serve_batch(spark, served, 2, [4, 60])
    whole = newest(latest_served(read_served(spark, served)))
    assert newest(read_latest_served(spark, served, root)) == whole
    one = read_latest_served(spark, served, root, [4])
    assert newest(one) == [r for r in whole if r[0] == 4]
    files = one.inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in files if "batch_id=" in f} == {"2"}
    assert len({f.split("user_bucket_of_8=")[1].split("/")[0] for f in files if "user_bucket_of_8=" in f}) == 1
    assert newest(read_latest_served(spark, served, root, [4, 50, 999])) == [r for r in whole if r[0] in (4, 50)]


def test_the_log_of_a_batch_that_runs_again_is_the_same(spark, tmp_path):
    path = str(tmp_path / "log")
    alerts = spark.createDataFrame([(minute(10), "⚡ ALERT [USER SPIKE] User 1 has 2")], "window_end timestamp, message string")
    seen = []
    for _ in range(2):
        write_alert_log(alerts, path, 7)
        seen.append([r["value"] for r in spark.read.text(path).collect()])
    assert seen[0] == seen[1] == ["[2024-01-01 00:10:00] ⚡ ALERT [USER SPIKE] User 1 has 2"]
    row = read_alert_lines(spark, path).first()
    assert (row["alert_type"], row["alert_time"].minute) == ("USER SPIKE", 10)


def test_windows_are_built_without_a_job(spark):
    events = spark.createDataFrame([(1, 1, 4.0, minute(3))], "user_id int, item_id int, rating float, event_time timestamp")
    spark.sparkContext.setJobGroup("windows", "none")
    try:
        _micros.cache_clear()
        built = item_windows(events, "7 days", "1 day")
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("windows") == []
        assert built.count() == 7
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    lengths = {"30 seconds": 30, "1 minute 5 seconds": 65, "2 days": 172800, "1 week": 604800}
    assert {d: _micros(d) for d in lengths} == {d: s * 1_000_000 for d, s in lengths.items()}


def test_cleaning_counts_need_one_scan(spark, tmp_path):
    rows = [(1, 1, 3.0, 5), (1, 1, 4.0, 6), (1, None, 3.0, 5), (2, 1, 9.0, 5), (-1, 1, 3.0, 5), (2, 2, None, 5), (2, 2, 1.0, None)]
    spark.createDataFrame(rows, "user_id int, movie_id int, rating float, timestamp long").write.parquet(f"{tmp_path}/r")
    counts = cleaning_counts(spark.read.parquet(f"{tmp_path}/r"))
    assert plan_of(counts).count("FileScan") == 1
    assert {r["frame"]: r["n_rows"] for r in counts.collect()} == {"raw": 7, "valid": 2, "clean": 1}
    none = cleaning_counts(spark.read.parquet(f"{tmp_path}/r").limit(0))
    assert {r["n_rows"] for r in none.collect()} == {0}


def test_days_add_up_to_the_profile(spark):
    ratings = spark.range(60_000).selectExpr(
        "cast(id % 20011 as int) user_id", "cast(id % 3001 as int) movie_id", "cast(id % 5 + 1 as float) rating",
        "timestamp_seconds(id * 60) event_time",
    )
    exact, days = profile(ratings).first(), daily_profiles(ratings)
    assert days.count() == 42
    got = profile_of_days(days).first()
    for c in ("n_ratings", "min_rating", "max_rating", "avg_rating"):
        assert got[c] == exact[c]
    for c in ("n_users", "n_items"):
        assert abs(got[c] - exact[c]) <= SKETCH_ERROR * exact[c]
    part = profile_of_days(days.filter(F.col("day") < "1970-01-03")).first()
    assert part["n_ratings"] == 2880
