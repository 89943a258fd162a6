"""The three queries over one event stream."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ratewise.operators.popularity import pinned_list
from ratewise.operators.windows import item_windows, user_windows
from ratewise.settings import DEFAULTS, Settings
from ratewise.streaming.handlers import item_handler, recommendation_handler, user_handler


@dataclass(frozen=True)
class Outputs:
    """Where the queries write, below one root."""

    root: str

    @property
    def item_windows(self) -> str:
        return f"{self.root}/item_windows"

    @property
    def user_windows(self) -> str:
        return f"{self.root}/user_windows"

    @property
    def item_alerts(self) -> str:
        return f"{self.root}/alerts/items"

    @property
    def user_alerts(self) -> str:
        return f"{self.root}/alerts/users"

    @property
    def item_alert_log(self) -> str:
        return f"{self.root}/alert_log/items"

    @property
    def user_alert_log(self) -> str:
        return f"{self.root}/alert_log/users"

    @property
    def trending(self) -> str:
        return f"{self.root}/trending"

    @property
    def active_users(self) -> str:
        return f"{self.root}/active_users"

    @property
    def served(self) -> str:
        return f"{self.root}/recommendations"


@contextmanager
def _state_partitions(spark: SparkSession, most: int | None):
    """A query that is started inside has at most that many state partitions."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if most is None or int(before) <= most:
        yield
        return
    # A query copies the session when it starts; one with a checkpoint keeps its number.
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_query(
    df: DataFrame,
    name: str,
    mode: str,
    handler,
    checkpoint: str,
    trigger: Mapping[str, object],
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start one query; its checkpoint is named after it."""
    # A query keeps the pool it is started in. Under the FAIR scheduler the
    # short lookups then don't wait behind the window queries' jobs.
    context = df.sparkSession.sparkContext
    pool = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        with _state_partitions(df.sparkSession, state_partitions):
            return (
                df.writeStream.queryName(name)
                .outputMode(mode)
                .foreachBatch(handler)
                .option("checkpointLocation", f"{checkpoint}/{name}")
                .trigger(**trigger)
                .start()
            )
    finally:
        context.setLocalProperty("spark.scheduler.pool", pool)


def start_queries(
    events: DataFrame,
    recs: DataFrame,
    items: DataFrame,
    popular: DataFrame,
    out: Outputs,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    settings: Settings = DEFAULTS,
    alert_top_n: int | None = None,
    prefix: str = "",
) -> dict[str, StreamingQuery]:
    """Start item windows, user windows and recommendations on parsed events.

    The window queries run in update mode and keep state per (window, key);
    the recommendation query keeps none. Each has its own checkpoint. If one
    can't be started the others are stopped.
    """
    trigger = trigger or {"processingTime": settings.trigger}
    fallback = pinned_list(popular)
    bounds = (settings.window, settings.slide, settings.watermark)
    plans = {
        "item_windows": (
            item_windows(events, *bounds),
            "update",
            item_handler(
                out.item_windows, out.item_alerts, out.trending, items, settings, alert_top_n,
                out.item_alert_log,
            ),
        ),
        "user_windows": (
            user_windows(events, *bounds),
            "update",
            user_handler(
                out.user_windows, out.user_alerts, out.active_users, settings, out.user_alert_log
            ),
        ),
        "recommendations": (
            events,
            "append",
            recommendation_handler(out.served, recs, items, fallback, settings),
        ),
    }
    started: dict[str, StreamingQuery] = {}
    try:
        for name, (df, mode, handler) in plans.items():
            started[name] = start_query(
                df, f"{prefix}{name}", mode, handler, checkpoint, trigger,
                settings.state_partitions if mode == "update" else None,
            )
    except Exception:
        stop_all(started)
        raise
    return started


def last_batch(query: StreamingQuery) -> tuple[int, datetime] | None:
    """The last micro-batch that a query completed, and the watermark it ran with.

    None before the first. The next batch drops rows of windows up to that watermark.
    """
    ran = [p for p in query.recentProgress if "addBatch" in p["durationMs"]]
    if not ran:
        return None
    text = (ran[-1]["eventTime"] or {}).get("watermark", "1970-01-01T00:00:00.000Z")
    return ran[-1]["batchId"], datetime.fromisoformat(text.replace("Z", "+00:00"))


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's state operators dropped as too late, of the batches that
    ``recentProgress`` still has. A batch's rows are already added up by window and key."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def stop_all(queries: Mapping[str, StreamingQuery]) -> None:
    """Stop every query; if some fail to stop, raise the first error after the last."""
    errors = []
    for query in queries.values():
        try:
            query.stop()
        except Exception as error:  # the others still have to stop
            errors.append(error)
    if errors:
        raise errors[0]


def run_until_stopped(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until all queries ended, one failed or the user interrupts; then stop all."""
    try:
        while any(query.isActive for query in queries.values()):
            for query in queries.values():
                query.awaitTermination(1)
        for query in queries.values():
            query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        stop_all(queries)
