"""Connected components of an edge table, in rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.session import scratch_path


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the smallest node reachable.

    Alternates large-star and small-star steps: each hangs the neighbours of a
    node below the smallest of them, until only stars are left, after a number of
    rounds logarithmic in the longest path. A node with very many neighbours
    costs one grouped minimum, which Spark adds up before its shuffle, and one
    join that adaptive execution may split. Every round is written to the
    shared folder, which cuts the lineage. Null ends and self links are left out.
    """
    current = _written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # Larger neighbours of a node go to its smallest neighbour, or to itself.
        ways = _both_ways(current)
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
        large = (
            ways.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("root").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        # A node and its smaller neighbours go to the smallest of these.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        smallest = down.groupBy("a").agg(F.min("b").alias("root"))
        joined = down.join(smallest, "a")
        small = (
            joined.select(F.col("b").alias("a"), F.col("root").alias("b"))
            .union(smallest.select("a", F.col("root").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        current = _written(small, "edges")
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
