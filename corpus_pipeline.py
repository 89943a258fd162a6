"""From raw documents to a training mixture, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import decontamination, mixing, simhash, templates, toxicity
from ratewise.llm.queries import MIXTURE, training_labels
from ratewise.llm.shipping import send_package
from ratewise.llm.text import free_prefix
from ratewise.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    send_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, training_labels(labels))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs across documents."""
    return templates.drop_recurring(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies (3-word shingles, 2 bits)."""
    send_package(spark)
    return simhash.keep_one(docs, words=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth comes from the benchmark."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards the target shares, with their probability and weight.

    These two take the place of columns of the same name.
    """
    own = free_prefix(docs.columns)
    mixed = mixing.mix(docs, MIXTURE, fraction=0.8, prefix=own).filter(F.col(f"{own}sampled"))
    added = ("probability", "weight")
    return mixed.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added],
        *[F.col(f"{own}{c}").alias(c) for c in added],
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", sample_mixture),
]

#: A classifier is fitted on the way, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
