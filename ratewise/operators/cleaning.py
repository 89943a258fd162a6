"""Validity filters and keep-latest dedup of rating facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions import epoch_to_time
from ratewise.schemas import RATINGS
from ratewise.settings import DEFAULTS


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where all the columns are set, as null checks a scan can push down."""
    return df.filter(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def valid_rating(lo: float = DEFAULTS.rating_low, hi: float = DEFAULTS.rating_high) -> Column:
    """Whether a row is one that ``valid_ratings`` keeps; never null."""
    tests = [F.col(c).isNotNull() for c in RATINGS.names]
    tests += [F.col("rating").between(lo, hi), F.col("user_id") > 0, F.col("movie_id") > 0]
    return F.coalesce(reduce(and_, tests), F.lit(False))


def valid_ratings(
    df: DataFrame, lo: float = DEFAULTS.rating_low, hi: float = DEFAULTS.rating_high
) -> DataFrame:
    """Rows with all four fields, a rating in [lo, hi] (so not NaN) and positive ids."""
    return (
        complete(df, RATINGS.names)
        .filter(F.col("rating").between(lo, hi))
        .filter("user_id > 0 AND movie_id > 0")
    )


def keep_latest(
    df: DataFrame, keys: Sequence[str], by: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the largest ``by``, then ``tiebreak``, then the other columns.

    The largest struct is an aggregate with a map-side part, so a key with a
    third of all rows sends one row per map task; it took three quarters of
    the time of ``row_number() = 1`` on such data.
    """
    first = [by, *tiebreak]
    rest = [c for c in df.columns if c not in (*keys, *first)]
    newest = F.max(F.struct(*first, *rest)).alias("_newest")
    picked = [c if c in keys else F.col(f"_newest.{c}") for c in df.columns]
    return df.groupBy(*keys).agg(newest).select(*picked)


def clean_ratings(
    df: DataFrame,
    lo: float = DEFAULTS.rating_low,
    hi: float = DEFAULTS.rating_high,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Valid ratings, the latest per (user, item), with ``event_time``.

    Rows of equal time are ordered by ``tiebreak`` and then by rating, so the
    result doesn't depend on how the input is partitioned.
    """
    latest = keep_latest(
        valid_ratings(df.drop("event_time"), lo, hi), ("user_id", "movie_id"), "timestamp", (*tiebreak, "rating")
    )
    return latest.withColumn("event_time", epoch_to_time(F.col("timestamp")))
