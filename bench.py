"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

Every query runs to its last row (``noop`` sink) once, in the order below, in
one session. A first small query starts the JVM's work and is not counted.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratewise.operators import factors, popularity, recommending, serving
from ratewise.plans import frames
from ratewise.plans.queries import QUERIES
from ratewise.session import build_session, scratch_path
from ratewise.sinks import write_recommendations
from ratewise.sources import read_recommendations, read_served
from ratewise.streaming.handlers import recommendation_handler

PLAIN = (
    "clean_ratings",
    "clean_ratings_orders",
    "profile_stats_orders",
    "rating_histogram_orders",
    "parsed_events",
    "encoded_events",
    "item_windows",
    "user_windows",
    "item_windows_30s",
    "trending_top10",
    "trending_topk_per_window",
    "alert_counts",
    "popular_items_orders",
    "unseen_candidates",
    "rating_split",
)
MICRO_BATCHES = 5


def finish(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="ratewise-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    extra: dict[str, float] = {}

    def timed(name: str, run: Callable[[], object]):
        started = time.monotonic()
        result = run()
        seconds[name] = round(time.monotonic() - started, 3)
        return result

    finish(QUERIES["batch_users"](spark, sf_dir))
    for name in PLAIN:
        timed(name, lambda: finish(QUERIES[name](spark, sf_dir)))
    model_queries(spark, sf_dir, timed, extra)
    # The model and table the stream serves from are made before it is timed.
    timed("als_events_and_table", lambda: finish(QUERIES["recommendation_table"](spark, sf_dir)))
    timed("stream_item_windows", lambda: finish(QUERIES["stream_item_windows"](spark, sf_dir)))

    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                **extra,
            }
        )
    )
    spark.stop()


def model_queries(spark: SparkSession, sf_dir: str, timed, extra: dict[str, float]) -> None:
    """Training, precomputing and serving on the orders: 600,000 lines at sf0.1."""
    stored = scratch_path(spark, "bench-ratings")
    frames.clean_order_ratings(spark, sf_dir).write.parquet(stored)
    ratings = spark.read.parquet(stored)
    train, test = factors.written_split(ratings, scratch_path(spark, "bench-split"))
    training = timed("als_train_and_rmse", lambda: factors.train_and_score(train, test))
    extra["rmse"] = round(training.rmse, 4)
    extra["train_rows"] = train.count()
    items = frames.part_items(spark, sf_dir)
    table = scratch_path(spark, "bench-recommendations")
    timed(
        "recommend_all_and_write",
        lambda: write_recommendations(
            serving.titled_recommendations(recommending.recommend_all(training.model), items), table
        ),
    )
    users = frames.customers(spark, sf_dir)
    some = users.filter("user_id % 100 = 0")
    popular = popularity.popular_items(ratings, items)
    timed(
        "recommend_on_demand_all_users",
        lambda: finish(
            recommending.recommend(training.model, users, ratings, items, popular)
        ),
    )
    served = scratch_path(spark, "bench-served")
    handler = recommendation_handler(
        served, read_recommendations(spark, table), items, popularity.pinned_list(popular)
    )

    def micro_batches() -> None:
        for batch_id in range(MICRO_BATCHES):
            handler(some, batch_id)

    timed(f"serve_{MICRO_BATCHES}_micro_batches", micro_batches)
    latencies = [
        row["latency_ms"]
        for row in read_served(spark, served).select("latency_ms").distinct().collect()
    ]
    extra["serve_latency_ms_median"] = sorted(latencies)[len(latencies) // 2]


if __name__ == "__main__":
    main()
