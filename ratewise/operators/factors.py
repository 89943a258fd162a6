"""Splits, ALS training, evaluation and tuning."""

from __future__ import annotations

import math
import time
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions import split_bucket
from ratewise.session import shared_dir
from ratewise.settings import DEFAULTS, TUNING_GRID


def random_split(
    df: DataFrame, train: float = DEFAULTS.train_fraction, seed: int = DEFAULTS.seed
) -> tuple[DataFrame, DataFrame]:
    """Seeded split; which row goes where depends on the partitioning."""
    left, right = df.randomSplit([train, 1 - train], seed)
    return left, right


def tag_split(df: DataFrame, train_parts: int = 80, parts: int = 100) -> DataFrame:
    """Add ``part``, train or test, by (user, item) hash: the same on every layout.

    ``train_parts`` of ``parts`` buckets are for training; neither side may be empty.
    """
    if not 0 < train_parts < parts:
        raise ValueError(f"{train_parts} of {parts} parts leave no training or no test rows")
    bucket = split_bucket(F.col("user_id"), F.col("movie_id"), parts)
    return df.withColumn("part", F.when(bucket < train_parts, "train").otherwise("test"))


def split_parts(fraction: float) -> tuple[int, int]:
    """A fraction as parts of 100, or of 1,000 and more where it has more digits."""
    parts = 100
    while parts < 1_000_000 and abs(fraction * parts - round(fraction * parts)) > 1e-9 * parts:
        parts *= 10
    return round(fraction * parts), parts


def hash_split(df: DataFrame, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Both parts as frames, with no shuffle; each one runs ``df`` when used."""
    tagged = tag_split(df, train_percent)
    return (
        tagged.filter("part = 'train'").drop("part"),
        tagged.filter("part = 'test'").drop("part"),
    )


def written_split(
    df: DataFrame, path: str, train_parts: int = 80, parts: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Write the rating triples of both parts in one pass over ``df`` and read them back."""
    triples = df.select("user_id", "movie_id", "rating")
    tag_split(triples, train_parts, parts).write.partitionBy("part").parquet(path)
    stored = df.sparkSession.read.schema(tag_split(triples).schema).parquet(path)
    return (
        stored.filter("part = 'train'").drop("part"),
        stored.filter("part = 'test'").drop("part"),
    )


def fit_als(
    train: DataFrame,
    rank: int = DEFAULTS.rank,
    reg: float = DEFAULTS.reg,
    max_iter: int = DEFAULTS.max_iter,
    seed: int = DEFAULTS.seed,
    blocks: int | None = None,
) -> ALSModel:
    """Explicit, non-negative ALS; unknown ids get no prediction.

    ``blocks`` is the number of user and of item blocks and so the parallelism
    of a fit. Another number of blocks starts from other random factors, so it is
    a setting and never taken from the cluster: raise it for large data. ALS cuts its lineage every ten
    iterations in the shared checkpoint folder.
    """
    spark = train.sparkSession
    shared_dir(spark)
    als = ALS(
        userCol="user_id",
        itemCol="movie_id",
        ratingCol="rating",
        nonnegative=True,
        coldStartStrategy="drop",
        seed=seed,
        rank=rank,
        regParam=reg,
        maxIter=max_iter,
    )
    als.setNumBlocks(blocks or DEFAULTS.als_blocks)
    return als.fit(train.select("user_id", "movie_id", "rating"))


def predict(model: ALSModel, ratings: DataFrame) -> DataFrame:
    return model.transform(ratings)


def rmse(predictions: DataFrame) -> DataFrame:
    """Root mean squared error as a one-row frame."""
    error = F.col("rating").cast("double") - F.col("prediction").cast("double")
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def evaluate(model: ALSModel, test: DataFrame) -> float:
    """The error on ``test``; infinite, so the worst, if no row gets a prediction."""
    error = rmse(predict(model, test)).first()["rmse"]
    return math.inf if error is None else error


@dataclass
class Training:
    """The kept model with its score, and every (rank, reg, rmse) tried."""

    model: ALSModel
    rank: int
    reg: float
    rmse: float
    seconds: float = 0.0
    trials: list[tuple[int, float, float]] = field(default_factory=list)

    @property
    def tuned(self) -> bool:
        return len(self.trials) > 1


def train_and_score(
    train: DataFrame,
    test: DataFrame,
    rank: int = DEFAULTS.rank,
    reg: float = DEFAULTS.reg,
    **fit_options,
) -> Training:
    """Fit once and measure; ``train`` and ``test`` should be cached or written."""
    started = time.monotonic()
    model = fit_als(train, rank, reg, **fit_options)
    score = evaluate(model, test)
    return Training(model, rank, reg, score, time.monotonic() - started, [(rank, reg, score)])


def tune(
    first: Training,
    train: DataFrame,
    test: DataFrame,
    grid: Iterable[tuple[int, float]] = TUNING_GRID,
    threshold: float = DEFAULTS.rmse_threshold,
    **fit_options,
) -> Training:
    """Try the grid if the first error is above the threshold; keep the best model.

    The first model is a candidate too, so a grid of worse settings returns it.
    """
    if first.rmse <= threshold:
        return first
    best = first
    trials = list(first.trials)
    seconds = first.seconds
    for rank, reg in grid:
        attempt = train_and_score(train, test, rank, reg, **fit_options)
        trials += attempt.trials
        seconds += attempt.seconds
        if attempt.rmse < best.rmse:
            best = attempt
    return Training(best.model, best.rank, best.reg, best.rmse, seconds, trials)


def optimality(
    model: ALSModel, train: DataFrame, reg: float = DEFAULTS.reg, tolerance: float = 1e-3
) -> DataFrame:
    """(user_id, n_ratings, slack, optimal): whether each user's factors solve their
    non-negative least squares, given the items'.

    Users are solved last in a fit. Half the gradient of a user's loss is the sum over
    their ratings of (prediction - rating) * item factors, and reg * n_ratings * user
    factors. At the minimum it is zero where a factor is positive and not below zero
    where it is zero. ``slack`` is the largest departure from that, relative to the
    largest sum of rating * item factor; ``optimal`` says that it is within the tolerance.
    The sums have a part before the shuffle, so a user with a third of all ratings is as
    good as any other.
    """
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("movie_id"), F.col("features").alias("v"))
    rated = train.select("user_id", "movie_id", F.col("rating").cast("double").alias("rating"))
    rows = rated.join(items, "movie_id").join(users, "user_id")
    product = F.aggregate(
        F.zip_with("u", "v", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x
    )
    rows = rows.withColumn("error", product - F.col("rating"))
    rank = range(model.rank)
    sums = [F.sum(F.col("error") * F.col("v")[k]).alias(f"g{k}") for k in rank]
    sizes = [F.sum(F.col("rating") * F.col("v")[k]).alias(f"b{k}") for k in rank]
    # A user has one list of factors, so any of their rows has it.
    per_user = rows.groupBy("user_id").agg(
        F.count("*").alias("n_ratings"), F.first("u").alias("u"), *sums, *sizes
    )
    departures = []
    for k in rank:
        own = F.col("u")[k].cast("double")
        gradient = F.col(f"g{k}") + reg * F.col("n_ratings") * own
        departures.append(F.when(own > 0, F.abs(gradient)).otherwise(F.greatest(-gradient, F.lit(0.0))))
    scale = F.greatest(*[F.abs(F.col(f"b{k}")) for k in rank], F.lit(1e-30))
    slack = F.greatest(*departures, F.lit(0.0)) / scale
    return per_user.select("user_id", "n_ratings", slack.alias("slack"), (slack <= tolerance).alias("optimal"))


def trial_table(spark: SparkSession, training: Training) -> DataFrame:
    """One row per setting tried, in order."""
    rows = [(i, *trial) for i, trial in enumerate(training.trials)]
    return spark.createDataFrame(rows, "trial int, rank int, reg double, rmse double")


def training_summary(
    training: Training,
    train: DataFrame,
    test: DataFrame,
    max_iter: int = DEFAULTS.max_iter,
) -> DataFrame:
    """One row: settings, error, sizes and time of a training."""
    sizes = train.agg(F.count("*").alias("n_train")).select(
        "n_train", test.agg(F.count("*").alias("n_test")).scalar().alias("n_test")
    )
    return sizes.select(
        F.lit("ALS").alias("algorithm"),
        F.lit(training.rank).alias("rank"),
        F.lit(training.reg).alias("reg"),
        F.lit(max_iter).alias("max_iter"),
        "n_train",
        "n_test",
        F.lit(training.rmse).alias("rmse"),
        F.lit(training.tuned).alias("tuned"),
        F.lit(training.seconds).alias("seconds"),
    )


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
