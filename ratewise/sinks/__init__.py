from ratewise.sinks.kafka import kafka_sink_options, write_kafka
from ratewise.sinks.tables import (
    alert_lines,
    write_alert_log,
    write_alerts,
    write_batch,
    write_recommendations,
    write_served,
)

__all__ = [
    "alert_lines",
    "kafka_sink_options",
    "write_alert_log",
    "write_alerts",
    "write_batch",
    "write_kafka",
    "write_recommendations",
    "write_served",
]
