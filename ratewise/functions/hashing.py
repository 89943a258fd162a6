"""Buckets that depend on the values only, never on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_BUCKET = "user_bucket_of_"


def split_bucket(user: Column, item: Column, buckets: int = 100) -> Column:
    """Bucket of a (user, item) pair from the first 32 bits of its MD5."""
    digest = F.md5(F.concat_ws(":", user, item))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def bucket_column(buckets: int) -> str:
    """Name of the directory column; it tells readers how many buckets there are."""
    return f"{_BUCKET}{buckets}"


def bucket_count(columns: list[str]) -> int | None:
    """Number of buckets of a table with these columns, None if it has none."""
    counts = [int(c.removeprefix(_BUCKET)) for c in columns if c.startswith(_BUCKET)]
    return counts[0] if counts else None


def user_bucket(user: Column, buckets: int) -> Column:
    """Directory of a user in the recommendation table."""
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")
