"""Small states of a table's upkeep, written one after the other.

A state is a JSON document in a directory of its own, numbered and complete once Spark
has marked it so. What a state names exists before it is written, so work that broke off
leaves files that no state names, and readers go on with the state before.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

_BATCH = re.compile(r"batch_id=(\d+)$")


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, by the file system of the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(path) or []
    return sorted(status.getPath().toString() for status in found)


def newest_state(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest complete state; 0 and nothing if there is none."""
    done = _listed(spark, f"{root}/state=*/_SUCCESS")
    if not done:
        return 0, {}
    number = max(int(p.rsplit("/", 2)[1].removeprefix("state=")) for p in done)
    rows = spark.read.text(f"{root}/state={number:08d}").collect()
    return number, json.loads("".join(r["value"] for r in rows))


def commit_state(spark: SparkSession, root: str, number: int, state: dict) -> None:
    """Write a state; fails if there is one of that number, so that one of two writers wins."""
    text = spark.createDataFrame([(json.dumps(state),)], "value string")
    text.coalesce(1).write.text(f"{root}/state={number:08d}")


def batch_paths(spark: SparkSession, table: str, after: int, upto: int | None = None) -> list[str]:
    """Directories of the micro-batches with ``after`` < id <= ``upto``."""
    ids = {int(_BATCH.search(p)[1]): p for p in _listed(spark, f"{table}/batch_id=*") if _BATCH.search(p)}
    return [ids[i] for i in sorted(ids) if i > after and (upto is None or i <= upto)]


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete directories with all they hold."""
    for text in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def child_paths(spark: SparkSession, root: str, name: str) -> list[str]:
    """Directories ``<name>=…`` below a root."""
    return _listed(spark, f"{root}/{name}=*")
