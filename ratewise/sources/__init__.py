from ratewise.sources.alert_log import read_alert_lines
from ratewise.sources.files import (
    distinct_items,
    read_items,
    read_rating_lines,
    read_ratings,
    read_recommendations,
    read_records,
)
from ratewise.sources.kafka import kafka_records, kafka_source_options
from ratewise.sources.served import (
    newest_batches,
    read_newest,
    read_served,
    read_served_files,
)

__all__ = [
    "distinct_items",
    "kafka_records",
    "kafka_source_options",
    "newest_batches",
    "read_alert_lines",
    "read_items",
    "read_newest",
    "read_rating_lines",
    "read_ratings",
    "read_recommendations",
    "read_records",
    "read_served",
    "read_served_files",
]
