"""From rating files to a model and a recommendation table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ratewise.operators.cleaning import clean_ratings
from ratewise.operators.factors import (
    split_parts,
    Training,
    load_model,
    save_model,
    train_and_score,
    training_summary,
    tune,
    written_split,
)
from ratewise.operators.popularity import popular_items
from ratewise.operators.recommending import recommend, recommend_all
from ratewise.operators.serving import titled_recommendations
from ratewise.session import scratch_path
from ratewise.settings import DEFAULTS, Settings
from ratewise.sinks import write_recommendations
from ratewise.sources import distinct_items, read_items, read_ratings


@dataclass(frozen=True)
class TrainedModel:
    training: Training
    summary: DataFrame


def train_model(
    ratings: DataFrame, model_path: str, settings: Settings = DEFAULTS, blocks: int | None = None
) -> TrainedModel:
    """Split, fit, measure, tune if the error is too high, and save the model.

    The split is written to the shared folder once; every fit of the tuning
    reads it from there instead of running the cleaning again.
    """
    path = scratch_path(ratings.sparkSession, "split")
    train, test = written_split(ratings, path, *split_parts(settings.train_fraction))
    options = {"max_iter": settings.max_iter, "seed": settings.seed, "blocks": blocks}
    first = train_and_score(train, test, settings.rank, settings.reg, **options)
    best = tune(first, train, test, threshold=settings.rmse_threshold, **options)
    save_model(best.model, model_path)
    return TrainedModel(best, training_summary(best, train, test, settings.max_iter))


def train_from_files(
    spark: SparkSession,
    ratings_path: str,
    items_path: str,
    model_path: str,
    recs_path: str,
    settings: Settings = DEFAULTS,
    blocks: int | None = None,
) -> DataFrame:
    """Read, clean, train, and write model and recommendation table; returns the summary."""
    clean = clean_ratings(
        read_ratings(spark, ratings_path), settings.rating_low, settings.rating_high
    )
    trained = train_model(clean, model_path, settings, blocks)
    recs = recommend_all(load_model(model_path), settings.top_n)
    items = distinct_items(read_items(spark, items_path))
    write_recommendations(titled_recommendations(recs, items), recs_path, settings.user_buckets)
    return trained.summary


def recommend_from_files(
    users: DataFrame,
    model_path: str,
    ratings_path: str,
    items_path: str,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """On-demand recommendations of the given users from a saved model."""
    spark = users.sparkSession
    ratings = read_ratings(spark, ratings_path)
    items = distinct_items(read_items(spark, items_path))
    popular = popular_items(ratings, items, settings.top_n, settings.popular_min_ratings)
    return recommend(load_model(model_path), users, ratings, items, popular, settings.top_n)
