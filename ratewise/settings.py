"""Tunable values. No paths: every source and sink takes its own."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # The published defaults of the model, windows and alerts.
    rank: int = 10
    max_iter: int = 10
    reg: float = 0.1
    train_fraction: float = 0.8
    seed: int = 42
    als_blocks: int = 10
    rmse_threshold: float = 1.5
    rating_low: float = 1.0
    rating_high: float = 5.0
    window: str = "30 seconds"
    slide: str = "10 seconds"
    watermark: str = "15 seconds"
    alert_rating: float = 4.5
    alert_score: float = 30
    alert_interactions: int = 10
    top_n: int = 5
    trending_n: int = 10
    popular_min_ratings: int = 100
    topic_partitions: int = 2
    recent_alerts: int = 50
    newest_batches: int = 10
    trigger: str = "10 seconds"
    latency_target_ms: float = 5000

    # Ours: the most state partitions of
    # a new window query (None: as many as the session shuffles into), as each task of a
    # stateful stage reports on all of them and the driver gets their square; what a
    # micro-batch may broadcast, how many ids it names to the Parquet
    # reader, how many directories the recommendation table is laid out in, and the
    # size of the row groups that such a reader can leave out.
    state_partitions: int | None = None
    max_broadcast_users: int = 100_000
    max_pushed_users: int = 1_000
    user_buckets: int = 64
    row_group_bytes: int = 1 << 20


DEFAULTS = Settings()

# Fixed values: (rank, reg) pairs tried when the first model is too weak.
TUNING_GRID = ((10, 0.05), (20, 0.1), (20, 0.05), (50, 0.1), (50, 0.01))
