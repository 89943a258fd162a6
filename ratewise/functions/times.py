"""Epoch seconds, ISO text and timestamps, all in the (UTC) session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewise.schemas import EVENT_TIME_FORMAT


def epoch_to_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_to_iso(seconds: Column) -> Column:
    return F.date_format(epoch_to_time(seconds), EVENT_TIME_FORMAT)


def iso_to_time(text: Column) -> Column:
    """Null for text that isn't a time, also under ANSI rules."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))
