"""Column expressions shared by the operators; all run inside the JVM."""

from ratewise.functions.hashing import bucket_column, bucket_count, split_bucket, user_bucket
from ratewise.functions.numbers import exact_round, fixed_text, score_text
from ratewise.functions.times import epoch_to_iso, epoch_to_time, iso_to_time

__all__ = [
    "bucket_column",
    "bucket_count",
    "epoch_to_iso",
    "epoch_to_time",
    "exact_round",
    "fixed_text",
    "iso_to_time",
    "score_text",
    "split_bucket",
    "user_bucket",
]
