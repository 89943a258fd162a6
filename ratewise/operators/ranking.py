"""Top-k over window tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.settings import DEFAULTS

TRENDING_ORDER = ("trending_score", "item_id")
ACTIVITY_ORDER = ("user_interaction_count", "user_id")


def top_trending(windows: DataFrame, n: int = DEFAULTS.trending_n) -> DataFrame:
    """The n highest scores over all windows; an item may appear once per window."""
    return windows.orderBy(
        F.desc("trending_score"), F.desc("window.start"), F.asc("item_id")
    ).limit(n)


def top_users(windows: DataFrame, n: int = DEFAULTS.top_n) -> DataFrame:
    """The n most active (window, user) rows."""
    return windows.orderBy(
        F.desc("user_interaction_count"), F.desc("window.start"), F.asc("user_id")
    ).limit(n)


def top_k_per_window(
    windows: DataFrame, order: tuple[str, str] = TRENDING_ORDER, k: int = DEFAULTS.top_n
) -> DataFrame:
    """Rank 1..k inside each window by the first column down, the second up.

    ``WindowGroupLimit`` keeps k rows per window and map task before the
    shuffle, so a crowded window costs no more than a quiet one.
    """
    value, tie = order
    place: Column = F.row_number().over(
        Window.partitionBy("window").orderBy(F.desc(value), F.asc(tie))
    )
    return windows.withColumn("rank", place).filter(F.col("rank") <= k)


def newest_events(events: DataFrame, slide: str = DEFAULTS.slide) -> DataFrame:
    """Events that the window which starts last can hold.

    The last event alone says when that window starts, so the windows of all
    the events before needn't be made.
    """
    last = events.agg(F.max("event_time").alias("last"))
    start = last.select(F.window("last", slide).getField("start").alias("start"))
    return events.filter(F.col("event_time") >= start.scalar())


def current_window(windows: DataFrame) -> DataFrame:
    """Rows of the newest window of the table; ``newest_events`` can go before the windows."""
    newest = windows.agg(F.max("window.start").alias("start"))
    return windows.filter(F.col("window.start") == newest.scalar())
