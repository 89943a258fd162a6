"""The newest served record of each user, kept as a snapshot in buckets.

A merge takes the micro-batches since the last one and writes anew only the buckets
that their users are in; a state names the files of each bucket and the last batch that
is merged, and is committed last. Reading one user touches one bucket and the batches
after that mark.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions import bucket_column, user_bucket
from ratewise.operators.serving import latest_served
from ratewise.settings import DEFAULTS
from ratewise.sources.served import read_served_batches
from ratewise.streaming.manifests import batch_paths, child_paths, commit_state, newest_state


def merge_served(
    spark: SparkSession, served: str, root: str, upto: int, buckets: int = DEFAULTS.user_buckets
) -> int:
    """Merge the batches of ``served`` up to ``upto`` into the snapshot at ``root``; number
    of its state. The number of buckets is that of the first merge. Nothing new changes
    nothing, and a merge that broke off has no effect."""
    number, state = newest_state(spark, root)
    paths = batch_paths(spark, served, state.get("mark", -1), upto)
    if not paths:
        return number
    n, files = state.get("buckets", buckets), dict(state.get("files", {}))
    bucket = bucket_column(n)
    new = latest_served(read_served_batches(spark, served, paths))
    new = new.withColumn(bucket, user_bucket(F.col("user_id"), n))
    touched = {str(r[0]) for r in new.select(bucket).distinct().collect()}  # at most n
    old = [files[b] for b in touched if b in files]
    if old:
        held = spark.read.parquet(*old).withColumn(bucket, user_bucket(F.col("user_id"), n))
        new = latest_served(held.unionByName(new))
    merged = f"{root}/merge={uuid4().hex}"
    new.hint("rebalance", bucket).sortWithinPartitions(bucket, "user_id").write.partitionBy(
        bucket
    ).parquet(merged)
    files |= {p.rsplit("=", 1)[1]: p for p in child_paths(spark, merged, bucket)}
    commit_state(spark, root, number + 1, {"mark": upto, "buckets": n, "files": files})
    return number + 1


def _buckets_of(spark: SparkSession, users: Sequence[int], n: int) -> set[str]:
    """Buckets of some users, folded by the optimizer: no job."""
    ids = ", ".join(f"({int(u)})" for u in users)
    rows = spark.sql(f"SELECT CAST(u AS INT) AS u FROM VALUES {ids} AS t(u)")
    return {str(r[0]) for r in rows.select(user_bucket(F.col("u"), n)).collect()}


def read_latest_served(
    spark: SparkSession, served: str, root: str, users: Sequence[int] | None = None
) -> DataFrame:
    """The newest record of each user, or of the ``users`` alone, with its ``batch_id``."""
    _, state = newest_state(spark, root)
    files = state.get("files", {})
    if users is not None and files:
        wanted = _buckets_of(spark, users, state["buckets"]) if users else set()
        files = {b: p for b, p in files.items() if b in wanted}
    frames = [read_served_batches(spark, served, batch_paths(spark, served, state.get("mark", -1)))]
    if files:
        frames.append(spark.read.parquet(*files.values()))
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    if users is not None:
        rows = rows.filter(F.col("user_id").isin(list(users)))
    return latest_served(rows)
