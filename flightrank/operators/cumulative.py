"""Cumulative sums over a whole table without sorting it in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_bucket(table: DataFrame, value: str, cuts: Column, n_cuts: int) -> DataFrame:
    """Add ``bucket``: how many of the ``n_cuts`` rising cut points are at or below ``value``.

    Whole steps are counted first, then the cut points within one, so that a value is
    not compared with all.
    """
    step = math.isqrt(n_cuts) + 1

    def passed(place: Column) -> Column:
        return F.coalesce((F.get("cuts", place) <= F.col(value)).cast("int"), F.lit(0))

    steps = [passed(F.lit(last)) for last in range(step - 1, n_cuts, step)]
    within = [passed(F.col("before") + i) for i in range(step - 1)]
    return (
        table.withColumn("cuts", cuts)
        .withColumn("before", step * sum(steps, F.lit(0)))
        .withColumn("bucket", sum(within, F.col("before")))
        .drop("cuts", "before")
    )


def sums_from_top(
    table: DataFrame, value: str, parts: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Add ``bucket`` and, for each of ``parts``, ``from_<part>``: its sum over all rows
    whose ``value`` is at least this row's, and ``total_<part>``, over all rows.

    ``table`` has one row per value. A window without a partition would sort
    all of it in one task. Here quantiles cut the values into buckets of like
    size, each bucket sums its own rows, and the totals of the higher buckets
    (at most ``buckets`` rows in all) are added. By default there are some for
    each shuffle partition, which the size of the data decides.
    """
    if buckets is None:
        buckets = max(256, 4 * int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = table.agg(F.percentile_approx(value, shares, 10 * buckets)).scalar()
    cut = with_bucket(table, value, cuts, len(shares))

    # At most ``buckets`` rows: a window in one task and a broadcast are safe.
    higher = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy("bucket").agg(*[F.sum(p).alias(f"all_{p}") for p in parts])
    above = totals.select(
        "bucket",
        *[
            F.coalesce(F.sum(f"all_{p}").over(higher), F.lit(0)).alias(f"above_{p}")
            for p in parts
        ],
        *[F.sum(f"all_{p}").over(Window.partitionBy()).alias(f"total_{p}") for p in parts],
    )

    inside = (
        Window.partitionBy("bucket")
        .orderBy(F.desc(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    own = cut.select("*", *[F.sum(p).over(inside).alias(f"own_{p}") for p in parts])
    summed = own.join(F.broadcast(above), "bucket")
    return summed.select(
        *table.columns,
        "bucket",
        *[(F.col(f"own_{p}") + F.col(f"above_{p}")).alias(f"from_{p}") for p in parts],
        *[f"total_{p}" for p in parts],
    )
