"""Scans of rating, item, event-record and recommendation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.schemas import ITEMS, RATINGS, RECORDS


def _literal(sep: str) -> str:
    """A separator as a pattern that means just these characters."""
    return f"\\Q{sep}\\E"


def read_ratings(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """Headerless delimited ratings; a malformed field becomes null."""
    return spark.read.csv(path, schema=RATINGS, sep=sep, header=False, mode="PERMISSIVE")


def read_rating_lines(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """Only the lines of exactly four fields that all parse."""
    parts = F.split(F.trim("value"), _literal(sep))
    fields = [
        parts.getItem(i).try_cast(field.dataType).alias(field.name)
        for i, field in enumerate(RATINGS)
    ]
    return (
        spark.read.text(path)
        .filter(F.size(parts) == len(fields))
        .select(*fields)
        .dropna("any")
    )


def read_items(
    spark: SparkSession,
    path: str,
    sep: str = "::",
    encoding: str = "ISO-8859-1",
    strict: bool = False,
) -> DataFrame:
    """Item id, title and genres.

    A title that holds the separator gives a fourth field: the default reader
    cuts it off, ``strict`` leaves the whole line out.
    """
    if not strict:
        return spark.read.csv(path, schema=ITEMS, sep=sep, header=False, encoding=encoding)
    # One column of whole lines: a separator that can't occur in a line.
    lines = spark.read.csv(path, schema="line string", sep="\u0001", quote="", encoding=encoding)
    parts = F.split(F.trim("line"), _literal(sep))
    return lines.filter(F.size(parts) == 3).select(
        parts.getItem(0).try_cast("int").alias("movie_id"),
        parts.getItem(1).alias("title"),
        parts.getItem(2).alias("genres"),
    ).filter("movie_id IS NOT NULL")


def distinct_items(items: DataFrame) -> DataFrame:
    """One row per id, so that a title lookup can never multiply rows."""
    return items.groupBy("movie_id").agg(
        F.min(F.struct("title", "genres")).alias("item")
    ).select("movie_id", "item.title", "item.genres")


def read_recommendations(spark: SparkSession, path: str, warm: bool = False) -> DataFrame:
    """The precomputed table; keeps its directory column if it has one.

    ``warm`` loads it into the cluster's cache at once, which suits a table
    that fits; else each lookup reads the directories it needs.
    """
    table = spark.read.parquet(path)
    if warm:
        table.persist().count()
    return table


def read_records(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Event records from a folder as a stream, oldest file first."""
    reader = spark.readStream.schema(RECORDS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
