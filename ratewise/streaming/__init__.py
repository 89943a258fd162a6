from ratewise.streaming.compaction import compact, read_current, remove_folded
from ratewise.streaming.events import encode_events, parse_events
from ratewise.streaming.replay import replay_slices, write_replay
from ratewise.streaming.runner import (
    Outputs,
    dropped_rows,
    last_batch,
    run_until_stopped,
    start_queries,
    start_query,
    stop_all,
)
from ratewise.streaming.snapshots import merge_served, read_latest_served

__all__ = [
    "Outputs",
    "compact",
    "dropped_rows",
    "encode_events",
    "last_batch",
    "merge_served",
    "parse_events",
    "read_current",
    "read_latest_served",
    "remove_folded",
    "replay_slices",
    "run_until_stopped",
    "start_queries",
    "start_query",
    "stop_all",
    "write_replay",
]
