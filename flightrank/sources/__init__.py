from flightrank.sources.flight_lines import (
    checked_by_name,
    counted,
    flights_by_name,
    parse_flights,
    rejected_by_name,
    rejected_lines,
    render_lines,
)
from flightrank.sources.results import (
    BATCH_HEADER,
    READABLE,
    RECORD_SHAPES,
    checked_records,
    counted_results,
    parse_batch_messages,
    parse_best_flights,
    parse_frequencies,
    parse_key_metric,
    parse_messages,
    parse_pair_metric,
    read_records,
    rejected_records,
)
from flightrank.sources.streams import file_stream, kafka_lines, text_stream

__all__ = [
    "BATCH_HEADER",
    "READABLE",
    "RECORD_SHAPES",
    "checked_by_name",
    "checked_records",
    "counted",
    "counted_results",
    "file_stream",
    "flights_by_name",
    "kafka_lines",
    "parse_batch_messages",
    "parse_best_flights",
    "parse_flights",
    "parse_frequencies",
    "parse_key_metric",
    "parse_messages",
    "parse_pair_metric",
    "read_records",
    "rejected_by_name",
    "rejected_lines",
    "rejected_records",
    "render_lines",
    "text_stream",
]
