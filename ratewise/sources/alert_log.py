"""Plain-text alert logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.schemas import ALERT_TIME_FORMAT


def read_alert_lines(spark: SparkSession, path: str) -> DataFrame:
    """``[time] message`` lines as time, type and message; blank lines are left out.

    The type is read from the tag right behind ``ALERT``, so a title that
    holds the name of another type can't be miscounted.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")
    return lines.select(
        F.try_to_timestamp(
            F.regexp_extract("line", r"^\[([^\]]*)\]", 1), F.lit(ALERT_TIME_FORMAT)
        ).alias("alert_time"),
        F.nullif(F.regexp_extract("line", r"ALERT \[([^\]]*)\]", 1), F.lit("")).alias("alert_type"),
        F.regexp_replace("line", r"^\[[^\]]*\] ", "").alias("message"),
    )
