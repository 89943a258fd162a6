"""Threshold alerts on window tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions import fixed_text
from ratewise.operators.cleaning import keep_latest
from ratewise.operators.ranking import top_trending
from ratewise.operators.titles import with_title
from ratewise.settings import DEFAULTS

# Alert names and texts. A rule fires at >=, its text says ">".
RATING_SPIKE = "RATING SPIKE"
TRENDING = "TRENDING"
USER_SPIKE = "USER SPIKE"
ALERT_TYPES = (TRENDING, RATING_SPIKE, USER_SPIKE)
RATING_SPIKE_TEXT = "🔴 ALERT [RATING SPIKE] Item %d (%s) avg_rating=%s > %s"
TRENDING_TEXT = "🔥 ALERT [TRENDING] Item %d (%s) trending_score=%s > %s"
USER_SPIKE_TEXT = "⚡ ALERT [USER SPIKE] User %d has %d interactions in window (threshold=%s)"

ALERT_KEY = ("alert_type", "window_start", "window_end", "entity_id")


def _alert(
    kind: str, fires: Column, entity: str, title: Column, metric: Column, threshold, text: Column
) -> Column:
    """An alert struct where the rule fires, else null."""
    return F.when(
        fires,
        F.struct(
            F.lit(kind).alias("alert_type"),
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.col(entity).alias("entity_id"),
            title.alias("title"),
            metric.cast("double").alias("metric"),
            F.lit(float(threshold)).alias("threshold"),
            text.alias("message"),
        ),
    )


def item_alerts(
    windows: DataFrame,
    items: DataFrame,
    rating: float = DEFAULTS.alert_rating,
    score: float = DEFAULTS.alert_score,
    min_count: int = 1,
    top_n: int | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Rating-spike and trending alerts; a row that meets both rules gives two.

    All rows are checked unless ``top_n`` limits the check to the highest scores.
    ``shuffled`` joins the titles without a broadcast (see ``with_title``).
    """
    if top_n:
        windows = top_trending(windows, top_n)
    spike = (F.col("avg_rating") >= rating) & (F.col("interaction_count") >= min_count)
    trend = F.col("trending_score") >= score
    fired = with_title(windows.filter(spike | trend), items, "item_id", shuffled=shuffled)
    title = F.col("title")
    rules = F.array(
        _alert(
            RATING_SPIKE, spike, "item_id", title, F.col("avg_rating"), rating,
            F.format_string(
                RATING_SPIKE_TEXT, "item_id", title, fixed_text(F.col("avg_rating")),
                F.lit(str(rating)),
            ),
        ),
        _alert(
            TRENDING, trend, "item_id", title, F.col("trending_score"), score,
            F.format_string(
                TRENDING_TEXT, "item_id", title, F.format_string("%.2f", "trending_score"),
                F.lit(str(score)),
            ),
        ),
    )
    return fired.select(F.inline(F.array_compact(rules)))


def user_alerts(windows: DataFrame, count: int = DEFAULTS.alert_interactions) -> DataFrame:
    """User-spike alerts."""
    n = F.col("user_interaction_count")
    alert = _alert(
        USER_SPIKE, n >= count, "user_id", F.lit(None).cast("string"), n, count,
        F.format_string(USER_SPIKE_TEXT, "user_id", n, F.lit(str(count))),
    )
    return windows.filter(n >= count).select(alert.alias("alert")).select("alert.*")


def first_alerts(alerts: DataFrame) -> DataFrame:
    """Each alert once, as first raised: a window that is updated fires again."""
    return keep_latest(
        alerts.withColumn("_age", -F.col("batch_id")), ALERT_KEY, "_age"
    ).drop("_age")


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Number of alerts per type, zeros included."""
    counts = alerts.agg(
        *(F.count_if(F.col("alert_type") == kind).alias(kind) for kind in ALERT_TYPES)
    )
    rows = [
        F.struct(F.lit(kind).alias("alert_type"), F.col(f"`{kind}`").alias("n_alerts"))
        for kind in ALERT_TYPES
    ]
    return counts.select(F.inline(F.array(*rows)))


def alerts_per_batch(alerts: DataFrame) -> DataFrame:
    """Number of rule hits of each micro-batch."""
    return alerts.groupBy("batch_id").agg(F.count("*").alias("n_alerts"))


def recent_alerts(alerts: DataFrame, n: int = DEFAULTS.recent_alerts) -> DataFrame:
    """The newest n alerts, newest first."""
    order = [F.desc("alert_time"), F.desc("window_end"), F.asc("alert_type"), F.asc("entity_id")]
    return alerts.orderBy(*order).limit(n)
