"""From a stream of records and the files of a training to the three queries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ratewise.operators.popularity import popular_items
from ratewise.settings import DEFAULTS, Settings
from ratewise.sources import distinct_items, read_items, read_ratings, read_recommendations
from ratewise.streaming import Outputs, parse_events, start_queries


def start_from_files(
    records: DataFrame,
    ratings_path: str,
    items_path: str,
    recs_path: str,
    out: Outputs,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    settings: Settings = DEFAULTS,
) -> dict[str, StreamingQuery]:
    """Start the queries on any stream with a ``value`` column of JSON events.

    ``records`` is what ``kafka_records`` or ``read_records`` gives; ratings, items
    and the recommendation table are those ``train_from_files`` read and wrote.
    """
    spark = records.sparkSession
    items = distinct_items(read_items(spark, items_path))
    popular = popular_items(
        read_ratings(spark, ratings_path), items, settings.top_n, settings.popular_min_ratings
    )
    recs = read_recommendations(spark, recs_path)
    return start_queries(
        parse_events(records), recs, items, popular, out, checkpoint, trigger, settings
    )
