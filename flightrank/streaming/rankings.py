"""Streaming forms of the questions. Plans only; ``run`` and ``sinks`` start them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightrank.functions import departure_time, is_airport, shift_date
from flightrank.operators.itinerary import CHOICE, best_per, candidates, prefixed, trip_columns
from flightrank.operators.popularity import movements
from flightrank.plans.questions import carriers, popular_airports


def running_popularity(flights: DataFrame, k: int = 10) -> DataFrame:
    """Top airports over everything seen so far; for complete mode.

    State is one count per airport code.
    """
    return popular_airports(flights, k)


def running_carriers(flights: DataFrame, metric: str = "arr_delay", k: int = 10) -> DataFrame:
    """Most punctual carriers over everything seen so far; for complete mode."""
    return carriers(flights, metric, k)


def windowed_popularity(
    flights: DataFrame, interval: str = "60 seconds", late: str = "1 hour"
) -> DataFrame:
    """Flights per airport in windows of departure time.

    For update mode with a keyed store (``drain_updated``): a window is emitted
    whenever its count changes, the open ones too, and its state is dropped when
    the watermark passes its end. Append mode emits a window once, at its end,
    and so never the last ones. Flights without a readable time belong to no
    window; ``untimed`` counts them.
    """
    timed = flights.withColumn("departed", departure_time("flight_date", "dep_time"))
    return (
        movements(timed)
        .withWatermark("departed", late)
        .groupBy(F.window("departed", interval), "airport")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "airport", "n")
    )


def untimed(flights: DataFrame, as_name: str) -> DataFrame:
    """``flights`` with the number of those without a readable time observed, in the progress
    of a stream under ``as_name``."""
    missing = departure_time("flight_date", "dep_time").isNull()
    return flights.observe(as_name, F.count_if(missing).alias("untimed"))


# How many days a flight may come after those of a later day, by default.
LATE_DAYS = 1


def best_legs(flights: DataFrame, late: str = f"{LATE_DAYS} day") -> DataFrame:
    """Best flight per route, day and half of the day, from one reading of the source.

    For update mode with a keyed store: a leg is emitted whenever a better
    flight comes. State holds one row per route and half for the days that the
    watermark has not passed.
    """
    known = candidates(flights).filter(F.col("half_day").isNotNull() & is_airport("dest"))
    days = known.withColumn("day", F.col("flight_date").cast("timestamp")).withWatermark("day", late)
    best = best_per(days, ("origin", "dest", "day", "half_day"))
    return best.withColumn("flight_date", F.col("day").cast("date")).drop("day")


LEG = ["origin", "dest", "flight_date", "half_day"]


def best_legs_stream(flights: DataFrame, half: str, late: str = "1 day") -> DataFrame:
    """Best flight per route and day in one half of the day; for append mode.

    A day is emitted when the watermark reaches it, so state holds one row per
    route for the open days only.
    """
    known = candidates(flights).filter((F.col("half_day") == half) & is_airport("dest"))
    days = known.withColumn("day", F.col("flight_date").cast("timestamp")).withWatermark("day", late)
    return best_per(days, ("origin", "dest", "day"))


def two_leg_stream(flights: DataFrame, gap_days: int = 2, late: str = "1 day") -> DataFrame:
    """Best trip X-Y-Z per date as a stream-stream join of the two halves' best legs.

    The legs are reduced before the join, as in the batch plan. The second
    leg's day is a join key under a watermark, which lets Spark drop legs whose
    partner can no longer come.
    """
    first = prefixed(best_legs_stream(flights, "AM", late), "a_").withColumn(
        "a_flight_date", F.col("a_day").cast("date")
    )
    second = prefixed(best_legs_stream(flights, "PM", late), "b_").withColumn(
        "b_flight_date", F.col("b_day").cast("date")
    )
    first = first.withColumn("a_next", shift_date("a_flight_date", gap_days).cast("timestamp"))
    meet = (F.col("a_dest") == F.col("b_origin")) & (F.col("a_next") == F.col("b_day"))
    return first.join(second, meet).select(*trip_columns(CHOICE, CHOICE))
