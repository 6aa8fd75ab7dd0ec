"""Windows of departure time with the late flights kept beside them.

Spark's own windows drop a row whose window the watermark has passed. Here a
micro-batch splits its rows instead: those of open windows are added to the
counts of a keyed store, the others are written to a table of late rows. So the
two tables together hold every row that has a time.

The watermark of a batch is the latest time of the batches before it less the
allowed delay. (Spark's drops rows by the watermark of one batch earlier still,
and moves it in batches without data too, so which rows it drops depends on when
batches run.) One row per batch tells the latest time so far, so a batch that
runs again sees the same watermark and splits its rows the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightrank.functions import departure_time
from flightrank.operators.popularity import movements
from flightrank.streaming.store import read_latest, upsert_results

WINDOW = ["window_day", "window_start", "airport"]


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*WINDOW).agg(F.sum("n").alias("n"), F.max("batch_id").alias("batch_id"))


def count_windows(
    folder: str, interval: str = "60 seconds", late: str = "1 hour"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for flights: counts per airport and window, and the late rows.

    ``read_windows`` and ``read_late`` give the two tables.
    """
    keep = upsert_results(f"{folder}/windows", WINDOW, by="window_day", merge=_added)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        timed = movements(batch.withColumn("departed", departure_time("flight_date", "dep_time")))
        window = F.window("departed", interval)
        ends = timed.filter(F.col("departed").isNotNull()).withColumn("window", window).persist()
        try:
            before = _latest(spark, folder, batch_id - 1)
            own = F.max("departed").alias("latest")
            seen = ends.agg(F.greatest(own, F.lit(before).cast("timestamp")).alias("latest"))
            seen.write.mode("overwrite").parquet(f"{folder}/latest/batch={batch_id}")
            limit = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {late}")
            is_late = F.coalesce(F.col("window.end") <= limit, F.lit(False))
            behind = ends.filter(is_late).withColumn("window_start", F.col("window.start")).drop("window")
            behind.write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")
            start = F.col("window.start")
            counted = (
                ends.filter(~is_late)
                .groupBy(start.cast("date").alias("window_day"), start.alias("window_start"), "airport")
                .agg(F.count(F.lit(1)).alias("n"))
            )
            keep(counted, batch_id)
        finally:
            ends.unpersist()

    return write


def _latest(spark: SparkSession, folder: str, batch_id: int):
    """The latest time up to a batch, one row."""
    if batch_id < 0:
        return None
    return spark.read.parquet(f"{folder}/latest/batch={batch_id}").first()[0]


def read_windows(spark: SparkSession, folder: str) -> DataFrame:
    return read_latest(spark, f"{folder}/windows").select("window_start", "airport", "n")


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """The late rows, one per end of a flight, with the window they missed and their batch."""
    return spark.read.option("basePath", f"{folder}/late").parquet(f"{folder}/late")
