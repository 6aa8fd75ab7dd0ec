"""Where streams go. Batches are written by the executors, never collected."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from flightrank.sinks import answer_messages, batch_messages

# Fixed value: seconds between micro-batches.
BATCH_INTERVAL = "60 seconds"

Transform = Callable[[DataFrame], DataFrame]


def publish_to_kafka(
    stream: DataFrame,
    brokers: str,
    topic: str,
    checkpoint: str,
    entity: Sequence[str],
    metric: str,
    interval: str = BATCH_INTERVAL,
) -> DataStreamWriter:
    """Send each result row as a message of two parts; needs the Kafka connector on the class path."""
    return (
        answer_messages(stream, entity, metric)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
    )


Send = Callable[[DataFrame], None]


def to_kafka(brokers: str, topic: str) -> Send:
    """Sends messages with their keys and headers; needs the Kafka connector on the class path."""

    def send(messages: DataFrame) -> None:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("topic", topic)
            .save()
        )

    return send


def to_files(path: str) -> Send:
    """Appends messages, with their keys and headers, to files; a topic for those without a broker."""
    return lambda messages: messages.write.mode("append").parquet(path)


def publish_messages(
    send: Send, transform: Transform, entity: Sequence[str], metric: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: each batch's answer as messages with a key and the batch's
    number, sent by the executors. A batch may be sent twice, after a failure; its
    reader drops what it has (``sources.parse_batch_messages``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        send(batch_messages(transform(batch), entity, metric, batch_id))

    return write


def publish_batches(
    brokers: str, topic: str, transform: Transform, entity: Sequence[str], metric: str
) -> Callable[[DataFrame, int], None]:
    """``publish_messages`` to a Kafka topic."""
    return publish_messages(to_kafka(brokers, topic), transform, entity, metric)


def show_on_console(stream: DataFrame, mode: str = "append", rows: int = 100) -> DataStreamWriter:
    return (
        stream.writeStream.format("console")
        .outputMode(mode)
        .option("numRows", rows)
        .trigger(processingTime=BATCH_INTERVAL)
    )


def write_batches(path: str, transform: Transform | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: each batch, transformed, into its own folder.

    A batch that runs again after a failure replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        result = transform(batch) if transform else batch
        result.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
