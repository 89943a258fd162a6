"""Compaction of the tables that window queries write in update mode.

Such a table holds every version of every window, a directory per micro-batch. Windows
that end at or below the watermark get no further version: a compaction folds the
newest version of each into a base, by date of the window, and carries those that are
still open along. A state names the base runs, the carried rows and the last batch that
is folded; it is committed last. A read takes the base as it is, without a shuffle, and
looks for newest versions only among the carried rows and the batches after.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.cleaning import keep_latest
from ratewise.streaming.manifests import (
    batch_paths,
    child_paths,
    commit_state,
    newest_state,
    remove_paths,
)

_DATE, _OPEN = "window_date", "is_open"


def compacted_root(table: str) -> str:
    """Where the compactions of a table lie: beside it, so that it can be read as before."""
    return f"{table.rstrip('/')}_compacted"


def _micros(time: datetime) -> int:
    """Microseconds since 1970 of a time; one without a zone is UTC."""
    aware = time if time.tzinfo else time.replace(tzinfo=timezone.utc)
    return round(aware.timestamp() * 1_000_000)


def _open_rows(spark: SparkSession, table: str, state: dict, upto: int | None = None) -> list[DataFrame]:
    """Rows that may have a newer version: the carried ones and those of later batches."""
    found = []
    if state.get("carry"):
        found.append(spark.read.parquet(state["carry"]).drop(_DATE))
    paths = batch_paths(spark, table, state.get("mark", -1), upto)
    if paths:
        found.append(spark.read.option("basePath", table).parquet(*paths))
    return found


def compact(
    spark: SparkSession, table: str, keys: Sequence[str], watermark: datetime, upto: int
) -> int:
    """Fold the micro-batches up to ``upto``, which must be complete; number of the state.

    ``watermark`` is the one that the last of them ran with: Spark drops later rows of
    windows up to it. A batch that has such a window nevertheless is refused. ``keys``
    name a window's row besides ``window_start`` and ``window_end``. Nothing new to fold
    changes nothing. A compaction that broke off has no effect; run it again.
    """
    root, (number, state) = compacted_root(table), newest_state(spark, compacted_root(table))
    frames = _open_rows(spark, table, state, upto)
    if not frames or (upto <= state.get("mark", -1) and _micros(watermark) <= state["closed"]):
        return number
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    if state:
        closed = F.unix_micros("window_end") <= state["closed"]
        if rows.filter((F.col("batch_id") > state["mark"]) & closed).limit(1).count():
            raise ValueError(f"{table} has new versions of windows that were closed")
    latest = keep_latest(rows, ["window_start", "window_end", *keys], "batch_id")
    fold = f"{root}/fold={uuid4().hex}"
    still_open = F.unix_micros("window_end") > _micros(watermark)
    marked = latest.withColumns({_OPEN: still_open, _DATE: F.to_date("window_start")})
    marked.hint("rebalance", _OPEN, _DATE).write.partitionBy(_OPEN, _DATE).parquet(fold)
    parts = {p.rsplit("=", 1)[1]: p for p in child_paths(spark, fold, _OPEN)}
    new = {
        "mark": max(upto, state.get("mark", -1)),
        "closed": max(_micros(watermark), state.get("closed", -(2**62))),
        "runs": state.get("runs", []) + ([parts["false"]] if "false" in parts else []),
        "carry": parts.get("true"),
    }
    commit_state(spark, root, number + 1, new)
    return number + 1


def read_current(
    spark: SparkSession, table: str, keys: Sequence[str], since: date | None = None
) -> DataFrame:
    """The newest version of each window, without ``batch_id``.

    Reads the base, from the date of ``since`` on, and the batches that aren't folded;
    folded ones aren't even listed by the scan.
    """
    _, state = newest_state(spark, compacted_root(table))
    wanted = F.lit(True) if since is None else F.col(_DATE) >= F.lit(since)
    frames = [
        spark.read.parquet(path).filter(wanted).drop(_DATE, "batch_id") for path in state.get("runs", [])
    ]
    still_open = _open_rows(spark, table, state)
    if still_open:
        rows = reduce(lambda a, b: a.unionByName(b), still_open)
        if since is not None:
            rows = rows.filter(F.to_date("window_start") >= F.lit(since))
        frames.append(keep_latest(rows, ["window_start", "window_end", *keys], "batch_id").drop("batch_id"))
    return reduce(lambda a, b: a.unionByName(b), frames)


def remove_folded(spark: SparkSession, table: str) -> list[str]:
    """Delete the micro-batches that are folded, and folds that no state names any more or
    that broke off. Not while a compaction runs or a reader holds an older state."""
    root = compacted_root(table)
    number, state = newest_state(spark, root)
    if not state:
        return []
    named = [*state["runs"], *([state["carry"]] if state["carry"] else [])]
    gone = [p for p in child_paths(spark, root, "fold") if not any(n.startswith(f"{p}/") for n in named)]
    gone += batch_paths(spark, table, -1, state["mark"])
    remove_paths(spark, gone)
    return gone
