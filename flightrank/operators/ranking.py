"""Mean delays and top-k rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightrank.session import written_once


# Beyond this a delay has no exact place; such numbers are added as doubles, apart.
_EXACT = 1e15
_PARTS = 1_000_000


def exact_sum(c: str) -> Column:
    """The sum of a number column, the same however the rows are dealt to tasks.

    Doubles added in another order give another sum. So whole minutes and
    millionths of a minute are added as whole numbers, which a task reduces by
    hash like any sum. Finer fractions are rounded to a millionth. Numbers from
    1e15 on, infinite ones and NaN, are added as doubles.
    """
    small = F.abs(F.col(c)) < _EXACT
    whole = F.floor(c)
    parts = F.round((F.col(c) - whole) * _PARTS).cast("bigint")
    wholes = F.sum(F.when(small, whole)).cast("decimal(28,6)")
    exact = wholes + F.sum(F.when(small, parts)).cast("decimal(28,0)") / F.lit(_PARTS).cast("decimal(7,0)")
    rest = F.sum(F.when(~small, F.col(c)))
    return F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))


def mean_delay(flights: DataFrame, keys: Sequence[str], metric: str = "arr_delay") -> DataFrame:
    """Mean of ``metric`` per key. Groups without any delay do not appear.

    Running sums and a count per key leave each map task, never the single
    delays, so a key with a third of all flights costs no more than another.
    Sums are exact to a millionth of a minute: see ``exact_sum``.
    """
    return (
        flights.filter(F.col(metric).isNotNull())
        .groupBy(*keys)
        .agg((exact_sum(metric) / F.count(F.lit(1))).alias("mean_delay"))
    )


def _order(metric: str, ties: Sequence[str], ascending: bool) -> list[Column]:
    return [F.asc(metric) if ascending else F.desc(metric), *[F.asc(t) for t in ties]]


def ranked(df: DataFrame, metric: str, ties: Sequence[str], ascending: bool = True) -> DataFrame:
    """The whole ranking in order; range-partitioned by Spark, never collected."""
    return df.orderBy(*_order(metric, ties, ascending))


def placed(df: DataFrame, metric: str, ties: Sequence[str], ascending: bool = True) -> DataFrame:
    """The whole ranking with numbers: ``place``, from 1 without gaps, and ``tied_place``, which
    rows of the same ``metric`` share.

    A window over all rows would sort them in one task. Here Spark deals the rows
    out by ranges of the whole order, so rows that tie are split like others; each
    range numbers its own rows, and the sizes of the ranges before it are added.
    Only a tie at the edge of a range can go on in another, so of each range two
    values at most are looked up for where they begin.
    """
    order = _order(metric, ties, ascending)
    ranges = df.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    # Written, because both the sizes and the numbers have to see the same ranges.
    held = written_once(ranges, "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.groupBy("range").agg(
        F.count(F.lit(1)).alias("size"), F.min(metric).alias("low"), F.max(metric).alias("high")
    )
    bases = sizes.select("range", "low", "high", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range")
    own = held.withColumns(
        {
            "place": F.row_number().over(inside.orderBy(*order)).cast("bigint"),
            "tied_place": F.rank().over(inside.orderBy(order[0])).cast("bigint"),
        }
    )
    # One row per range.
    numbered = own.join(F.broadcast(bases), "range").withColumns(
        {"place": F.col("place") + F.col("base"), "tied_place": F.col("tied_place") + F.col("base")}
    )
    at_edge = F.col(metric).isNull() | (F.col(metric) == F.col("low")) | (F.col(metric) == F.col("high"))
    begins = numbered.filter(at_edge).groupBy(F.col(metric).alias("shared")).agg(F.min("tied_place").alias("begin"))
    # At most two rows per range and one for NULL.
    found = numbered.join(F.broadcast(begins), F.col(metric).eqNullSafe(F.col("shared")), "left")
    return found.select(*df.columns, "place", F.coalesce("begin", "tied_place").alias("tied_place"))


def top_k(
    df: DataFrame, metric: str, ties: Sequence[str], k: int = 10, ascending: bool = True
) -> DataFrame:
    """First ``k`` of the ranking; ``ties`` make the order total."""
    return ranked(df, metric, ties, ascending).limit(k)


def top_k_per_key(
    df: DataFrame,
    by: Sequence[str],
    metric: str,
    ties: Sequence[str],
    k: int = 10,
    ascending: bool = True,
) -> DataFrame:
    """First ``k`` rows of every key, with their ``rank``.

    Spark limits each map task to ``k`` rows per key before the shuffle, so a
    key sends at most ``k`` rows per task however many it has.
    """
    window = Window.partitionBy(*by).orderBy(*_order(metric, ties, ascending))
    place = df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return place.withColumn("rank", F.col("rank").cast("bigint"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order``; columns as given.

    Reduced per map task before the shuffle: one row per key and task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    last = F.max(F.struct(*order, *rest)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*").select(*df.columns)
