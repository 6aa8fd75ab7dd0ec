from flightrank.streaming.late import count_windows, read_late, read_windows
from flightrank.streaming.rankings import (
    LATE_DAYS,
    LEG,
    best_legs,
    best_legs_stream,
    running_carriers,
    running_popularity,
    two_leg_stream,
    untimed,
    windowed_popularity,
)
from flightrank.streaming.run import (
    drain_appended,
    drain_latest,
    drain_ranked,
    drain_trips,
    drain_updated,
    drain_upserted,
    publish_trips,
    run_to_end,
)
from flightrank.streaming.sinks import (
    BATCH_INTERVAL,
    publish_batches,
    publish_messages,
    publish_to_kafka,
    show_on_console,
    to_files,
    to_kafka,
    write_batches,
)
from flightrank.streaming.store import BUCKETS, read_latest, upsert_results

__all__ = [
    "BATCH_INTERVAL",
    "BUCKETS",
    "LATE_DAYS",
    "LEG",
    "best_legs",
    "best_legs_stream",
    "count_windows",
    "drain_appended",
    "drain_latest",
    "drain_ranked",
    "drain_trips",
    "drain_updated",
    "drain_upserted",
    "publish_batches",
    "publish_messages",
    "publish_to_kafka",
    "publish_trips",
    "read_late",
    "read_latest",
    "read_windows",
    "run_to_end",
    "running_carriers",
    "running_popularity",
    "show_on_console",
    "to_files",
    "to_kafka",
    "two_leg_stream",
    "untimed",
    "upsert_results",
    "windowed_popularity",
    "write_batches",
]
