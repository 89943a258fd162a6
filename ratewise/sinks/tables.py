"""File sinks. Everything written per micro-batch goes to its own ``batch_id``
directory in overwrite mode, so a batch that runs again replaces its own rows.
They are the same but for ``alert_time`` and ``latency_ms``, the times of the run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions import bucket_column, user_bucket
from ratewise.schemas import ALERT_TIME_FORMAT
from ratewise.settings import DEFAULTS


def write_batch(df: DataFrame, path: str, batch_id: int, format: str = "parquet") -> None:
    """Write one micro-batch. ``rebalance`` lets AQE set the number of files by bytes;
    what makes the rows keeps its own parallelism."""
    df.hint("rebalance").write.mode("overwrite").format(format).save(f"{path}/batch_id={batch_id}")


def write_recommendations(
    recs: DataFrame,
    path: str,
    buckets: int = DEFAULTS.user_buckets,
    row_group_bytes: int = DEFAULTS.row_group_bytes,
) -> None:
    """Overwrite the precomputed table, laid out in ``buckets`` directories by user.

    A micro-batch then reads only the directories of its own users. The table
    has one row per user, so hashed buckets can't be skewed; raise ``buckets``
    with the number of users. ``rebalance`` lets AQE write a large bucket with
    many tasks and many small ones with one. Files are sorted by user, in small row
    groups with a bloom filter of their users, so that a reader that names users leaves
    out the row groups without any of them.
    """
    bucket = bucket_column(buckets)
    bucketed = recs.withColumn(bucket, user_bucket(F.col("user_id"), buckets))
    options = {
        "parquet.block.size": row_group_bytes,
        "parquet.bloom.filter.enabled#user_id": "true",
        # Sized for the users of a row group: a writer holds the filters of its file.
        "parquet.bloom.filter.expected.ndv#user_id": max(row_group_bytes // 256, 64),
    }
    bucketed.hint("rebalance", bucket).sortWithinPartitions(bucket, "user_id").write.mode(
        "overwrite"
    ).options(**options).partitionBy(bucket).parquet(path)


def write_served(served: DataFrame, path: str, batch_id: int, latency_ms: float) -> None:
    """JSON lines of one batch, each with the time its lookup took."""
    records = served.select(
        "user_id", "recommendations", F.lit(round(latency_ms, 2)).alias("latency_ms"), "source"
    )
    write_batch(records, path, batch_id, "json")


def _line(alert_time: Column, message: Column) -> Column:
    return F.format_string("[%s] %s", F.date_format(alert_time, ALERT_TIME_FORMAT), message)


def alert_lines(alerts: DataFrame) -> DataFrame:
    """Alerts in log form, one ``[time] message`` line each, for ``write.text``."""
    return alerts.select(_line(F.col("alert_time"), F.col("message")).alias("value"))


def write_alert_log(alerts: DataFrame, path: str, batch_id: int) -> None:
    """Log lines of one batch. The time of a line is the end of the alert's window, so a
    batch that runs again leaves the same lines."""
    lines = alert_lines(alerts.withColumn("alert_time", F.col("window_end")))
    write_batch(lines, path, batch_id, "text")


def write_alerts(alerts: DataFrame, path: str, batch_id: int) -> None:
    """Typed alerts of one batch with the time they were raised."""
    timed = alerts.withColumn("alert_time", F.current_timestamp())
    write_batch(timed, path, batch_id)
