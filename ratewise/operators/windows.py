"""Sliding event-time windows per item and per user, on batches and streams."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.cleaning import keep_latest
from ratewise.settings import DEFAULTS


@lru_cache(maxsize=256)
def _micros(duration: str) -> int:
    """Microseconds of a duration as ``F.window`` takes it, parsed by Spark.

    The optimizer folds a row of literals on the driver, so there is no job.
    """
    length = "unix_micros(timestamp_seconds(0) + CAST(:duration AS INTERVAL))"
    row = SparkSession.active().sql(f"SELECT {length} FROM VALUES (1)", {"duration": duration})
    return row.first()[0]


def _start(time: str, length: str, slide: str | None = None) -> Column:
    return F.window(time, length, slide).getField("start").alias("start")


def _totals(df: DataFrame, key: str, length: str, slide: str, panes: bool | None) -> DataFrame:
    """Rows, rated rows and rating sum per (window, key).

    A row falls into length/slide windows. A stream keeps that many states per
    key. A batch can first add up each key over panes, the longest tumbling
    windows every window is made of, and copy only those sums into windows:
    a second shuffle for fewer copies. On 10 million rows that took 0.6 of the
    time at seven dense windows per row and 1.5 at three sparse ones, so it is
    the default from five windows per row on.
    """
    rating = F.col("rating").cast("double")
    sums = (
        F.count("*").alias("n"),
        F.count(rating).alias("n_rated"),
        F.sum(rating).alias("total"),
    )
    if df.isStreaming:
        return df.groupBy(F.window("event_time", length, slide).alias("window"), key).agg(*sums)
    if panes is None:
        panes = _micros(length) >= 5 * _micros(slide)
    pane = math.gcd(_micros(length), _micros(slide))
    # Grouped by the start alone: a plain column, unlike the window struct,
    # is a key of the generated code's fast hash map, and half the bytes.
    if panes and pane < _micros(length):
        per_pane = (
            df.select(_start("event_time", f"{pane} microseconds"), key, rating.alias("rating"))
            .groupBy("start", key)
            .agg(*sums)
        )
        totals = (
            per_pane.select(_start("start", length, slide), key, "n", "n_rated", "total")
            .groupBy("start", key)
            .agg(*(F.sum(c).alias(c) for c in ("n", "n_rated", "total")))
        )
    else:
        totals = (
            df.select(_start("event_time", length, slide), key, rating.alias("rating"))
            .groupBy("start", key)
            .agg(*sums)
        )
    end = F.col("start") + F.expr(f"INTERVAL '{_micros(length) / 1_000_000:.6f}' SECOND")
    window = F.struct("start", end.alias("end")).alias("window")
    return totals.select(window, key, "n", "n_rated", "total")


def _windowed(
    df: DataFrame, key: str, length: str, slide: str, watermark: str | None, panes: bool | None
) -> DataFrame:
    if watermark:
        df = df.withWatermark("event_time", watermark)
    mean = F.round(F.try_divide("total", "n_rated"), 4)
    return _totals(df, key, length, slide, panes).select("window", key, mean.alias("mean"), "n")


def item_windows(
    df: DataFrame,
    length: str = DEFAULTS.window,
    slide: str = DEFAULTS.slide,
    watermark: str | None = None,
    panes: bool | None = None,
) -> DataFrame:
    """Mean rating, interactions and trending score per (window, item).

    The score is the mean, already rounded to four places, times the count.
    """
    return _windowed(df, "item_id", length, slide, watermark, panes).select(
        "window",
        "item_id",
        F.col("mean").alias("avg_rating"),
        F.col("n").alias("interaction_count"),
        F.round(F.col("mean") * F.col("n"), 2).alias("trending_score"),
    )


def user_windows(
    df: DataFrame,
    length: str = DEFAULTS.window,
    slide: str = DEFAULTS.slide,
    watermark: str | None = None,
    panes: bool | None = None,
) -> DataFrame:
    """Interactions and mean rating per (window, user)."""
    return _windowed(df, "user_id", length, slide, watermark, panes).select(
        "window",
        "user_id",
        F.col("n").alias("user_interaction_count"),
        F.col("mean").alias("user_avg_rating"),
    )


def latest_version(df: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """The last written row per key of a table that holds every update of a window."""
    return keep_latest(df, keys, version).drop(version)
