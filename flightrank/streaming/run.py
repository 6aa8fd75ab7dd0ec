"""Run a stream over all data that is there now, then read its result as a batch table."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from flightrank.operators.itinerary import join_legs
from flightrank.session import shared_folder
from flightrank.streaming.rankings import LEG, best_legs
from flightrank.streaming.sinks import write_batches
from flightrank.streaming.store import NO_VALUE, Transform, drop_parts, parts, read_latest, upsert_results


def run_to_end(writer: DataStreamWriter, folder: str) -> None:
    """Run a stream over all data that is there, with its checkpoint in ``folder``."""
    query = (
        writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def drain_appended(stream: DataFrame) -> DataFrame:
    """Everything an append-mode stream emits, through the exactly-once file sink."""
    spark = stream.sparkSession
    folder = shared_folder(spark, "stream")
    run_to_end(
        stream.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out"),
        folder,
    )
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def drain_latest(stream: DataFrame) -> DataFrame:
    """The last full result of a complete-mode stream."""
    spark = stream.sparkSession
    folder = shared_folder(spark, "stream")
    out = f"{folder}/out"
    write = write_batches(out)
    done = []

    def write_and_note(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        done.append(batch_id)

    run_to_end(stream.writeStream.outputMode("complete").foreachBatch(write_and_note), folder)
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{out}/batch_id={done[-1]}")


def _empty(stream: DataFrame, transform: Transform | None = None) -> DataFrame:
    """The result of a stream that had no batch."""
    none = stream.sparkSession.createDataFrame([], stream.schema)
    result = transform(none) if transform else none
    return result.withColumn("batch_id", F.lit(None).cast("bigint")).filter(F.lit(False))


def drain_ranked(stream: DataFrame, transform: Transform) -> DataFrame:
    """Rank every micro-batch on its own; the result of each carries its ``batch_id``."""
    spark = stream.sparkSession
    folder = shared_folder(spark, "stream")
    out = f"{folder}/out"
    write, done = write_batches(out, transform), []

    def write_and_note(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        done.append(batch_id)

    run_to_end(stream.writeStream.foreachBatch(write_and_note), folder)
    if not done:
        return _empty(stream, transform)
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def drain_upserted(
    stream: DataFrame,
    keys: list[str],
    transform: Transform | None = None,
    mode: str = "append",
    by: str | None = None,
) -> DataFrame:
    """Keep the latest result per key over all micro-batches."""
    spark = stream.sparkSession
    folder = shared_folder(spark, "stream")
    out = f"{folder}/out"
    write, done = upsert_results(out, keys, transform, by), []

    def write_and_note(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        done.append(batch_id)

    run_to_end(stream.writeStream.outputMode(mode).foreachBatch(write_and_note), folder)
    return read_latest(spark, out) if done else _empty(stream, transform)


def drain_updated(stream: DataFrame, keys: list[str], by: str | None = None) -> DataFrame:
    """All rows of an update-mode stream in their last form, open windows among them."""
    return drain_upserted(stream, keys, mode="update", by=by).drop("batch_id").select(*stream.columns)


def drain_trips(flights: DataFrame, gap_days: int = 2, late: str = "1 day") -> DataFrame:
    """Best trip for every X, Y, Z and date of a stream of flights, the last days among them."""
    legs = drain_updated(best_legs(flights, late), LEG, by="flight_date")
    return join_legs(legs, legs, gap_days)


def publish_trips(
    store: str,
    publish: Callable[[DataFrame, int], None],
    gap_days: int = 2,
    keep_days: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for ``best_legs`` in update mode: keeps the legs in ``store``
    by day and publishes the trips that a batch's legs change.

    A batch reads the days of its own legs and those ``gap_days`` before and after.
    With ``keep_days``, days are dropped that lie so many days behind the newest one
    that neither their flights nor their partners' can still come: it has to be
    at least the days that flights may come late, and ``gap_days`` are added.
    """
    keep = upsert_results(store, LEG, by="flight_date")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if keep_days is not None:
            # Before the batch, so that one that runs again finds the days it needs.
            days = sorted(set(parts(spark, store, before=batch_id)) - {NO_VALUE})
            if days:
                oldest = shifted(days[-1], -keep_days - gap_days)
                drop_parts(spark, store, lambda day: day < oldest)
        keep(batch, batch_id)
        touched = [day for day, step in parts(spark, store).items() if step == batch_id and day != NO_VALUE]
        changed = read_latest(spark, store, touched).filter(F.col("batch_id") == batch_id)

        def legs(gap: int) -> DataFrame:
            return read_latest(spark, store, {shifted(day, gap) for day in touched}).drop("batch_id")

        changed = changed.drop("batch_id")
        first, second = join_legs(changed, legs(gap_days), gap_days), join_legs(legs(-gap_days), changed, gap_days)
        publish(first.unionByName(second).distinct(), batch_id)

    return write


def shifted(day: str, days: int) -> str:
    """A day as the name of its part, so many days later."""
    return (datetime.date.fromisoformat(day) + datetime.timedelta(days)).isoformat()
