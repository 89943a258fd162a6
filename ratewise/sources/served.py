"""Recommendations that were served, one JSON line per user and batch."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.schemas import SERVED
from ratewise.settings import DEFAULTS


_BATCH = re.compile(r"batch_id=(\d+)/")


def _records(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*SERVED.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).json(path).filter(F.col("user_id").isNotNull())


def read_served(spark: SparkSession, path: str) -> DataFrame:
    """All served records with their ``batch_id``; bad lines are left out.

    The batch is the ``batch_id=`` directory, so a filter on it reads only the
    directories that it names.
    """
    return _records(spark, path)


def read_served_batches(spark: SparkSession, path: str, batches: list[str]) -> DataFrame:
    """Records of some ``batch_id=`` directories below ``path``, the only ones listed."""
    schema = T.StructType([*SERVED.fields, T.StructField("batch_id", T.LongType())])
    if not batches:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).json(batches)
    return rows.filter(F.col("user_id").isNotNull())


def read_served_files(spark: SparkSession, path: str) -> DataFrame:
    """Served records of ``batch_<id>.json`` files; the batch is the number in the name."""
    in_name = F.regexp_extract("_metadata.file_name", r"^batch_(\d+)", 1).try_cast("bigint")
    return _records(spark, path).withColumn("batch_id", in_name)


def read_newest(
    spark: SparkSession, path: str, n: int = DEFAULTS.newest_batches
) -> DataFrame:
    """Records of the ``n`` newest ``batch_id=`` directories, the only ones that are read.

    Which they are comes from the file listing that the driver makes for any
    read, so no older record is parsed.
    """
    served = read_served(spark, path)
    found = {int(m[1]) for m in map(_BATCH.search, served.inputFiles()) if m}
    return served.filter(F.col("batch_id").isin(sorted(found)[-n:]))


def newest_batches(served: DataFrame, n: int = DEFAULTS.newest_batches) -> DataFrame:
    """Records of the ``n`` newest batches (the broadcast side holds n rows)."""
    newest = served.select("batch_id").distinct().orderBy(F.desc("batch_id")).limit(n)
    return served.join(F.broadcast(newest), "batch_id", "left_semi")
