"""What happens with each micro-batch.

A window handler writes its batch at once and goes on from the files, because every
further action on the batch would run the stateful plan of the stream again; even on a
persisted batch each of its tasks would report the metrics of all state partitions to the
driver, the square of their number for an action. The lookup of recommendations has no
state, and persists its batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.operators.alerts import item_alerts, user_alerts
from ratewise.operators.ranking import top_trending, top_users
from ratewise.operators.serving import batch_users, check_users, serve
from ratewise.operators.titles import with_title
from ratewise.settings import DEFAULTS, Settings
from ratewise.sinks import write_alert_log, write_alerts, write_batch, write_served
from ratewise.streaming.manifests import remove_paths

Handler = Callable[[DataFrame, int], None]

TITLE_WIDTH = 35  # Fixed value: width of a title in the trending table.


@contextmanager
def _kept(batch: DataFrame):
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def _flat(windows: DataFrame) -> DataFrame:
    """Window bounds as columns, so that readers can prune files by time."""
    others = [c for c in windows.columns if c != "window"]
    return windows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others
    )


def _framed(flat: DataFrame) -> DataFrame:
    """Window bounds as a struct again."""
    bounds = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    others = [c for c in flat.columns if c not in ("window_start", "window_end")]
    return flat.select(bounds.alias("window"), *others)


Derive = Callable[[DataFrame], DataFrame]


def _window_handler(
    windows_path: str,
    alerts_path: str,
    top_path: str,
    log_path: str | None,
    alerts_of: Derive,
    top_of: Derive,
) -> Handler:
    def handle(batch: DataFrame, batch_id: int) -> None:
        flat = _flat(batch)
        write_batch(flat, windows_path, batch_id)
        written = f"{windows_path}/batch_id={batch_id}"
        windows = _framed(batch.sparkSession.read.schema(flat.schema).parquet(written))
        if windows.isEmpty():
            remove_paths(batch.sparkSession, [written])
            return
        with _kept(alerts_of(windows)) as alerts:
            write_alerts(alerts, alerts_path, batch_id)
            if log_path:
                write_alert_log(alerts, log_path, batch_id)
        write_batch(_flat(top_of(windows)), top_path, batch_id)

    return handle


def item_handler(
    windows_path: str,
    alerts_path: str,
    trending_path: str,
    items: DataFrame,
    settings: Settings = DEFAULTS,
    top_n: int | None = None,
    log_path: str | None = None,
) -> Handler:
    """Write the updated item windows, their alerts (as lines, too, with ``log_path``),
    and the batch's top trending items."""
    return _window_handler(
        windows_path,
        alerts_path,
        trending_path,
        log_path,
        lambda windows: item_alerts(
            windows, items, settings.alert_rating, settings.alert_score, top_n=top_n, shuffled=True
        ),
        lambda windows: with_title(
            top_trending(windows, settings.trending_n), items, "item_id", max_len=TITLE_WIDTH,
            shuffled=True,
        ),
    )


def user_handler(
    windows_path: str,
    alerts_path: str,
    active_path: str,
    settings: Settings = DEFAULTS,
    log_path: str | None = None,
) -> Handler:
    """Write the updated user windows, their alerts (as lines, too, with ``log_path``),
    and the batch's most active users."""
    return _window_handler(
        windows_path,
        alerts_path,
        active_path,
        log_path,
        lambda windows: user_alerts(windows, settings.alert_interactions),
        lambda windows: top_users(windows, settings.top_n),
    )


def recommendation_handler(
    path: str,
    recs: DataFrame,
    items: DataFrame,
    fallback: Column,
    settings: Settings = DEFAULTS,
) -> Handler:
    """Look up and write recommendations of every user in the batch.

    The latency is taken around the lookup itself, up to the rows being there.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch_users(batch)) as users:
            started = time.monotonic()
            check = check_users(users, recs, settings.max_broadcast_users)
            if not check.n_users:
                return
            with _kept(serve(users, recs, items, fallback, check)) as served:
                served.count()
                latency_ms = (time.monotonic() - started) * 1000
                write_served(served, path, batch_id, latency_ms)

    return handle
