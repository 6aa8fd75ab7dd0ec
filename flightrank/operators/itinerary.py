"""Best flights of a route and two-leg trips with a stopover."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightrank.functions import half_day, is_airport, is_carrier, shift_date
from flightrank.session import written_once

# Least delay first; the other columns only settle ties.
CHOICE = ("arr_delay", "carrier", "flight_num", "dep_time")
ROUTE_DAY = ("origin", "dest", "flight_date")


def candidates(flights: DataFrame, blank_as_zero: bool = False) -> DataFrame:
    """Flights that can be chosen, with their half of the day.

    A blank arrival delay means the flight did not arrive, so it is no
    candidate; ``blank_as_zero`` counts it as punctual instead.
    """
    delay = F.coalesce("arr_delay", F.lit(0.0)) if blank_as_zero else F.col("arr_delay")
    return (
        flights.filter(is_carrier("carrier") & is_airport("origin"))
        .withColumn("arr_delay", delay)
        .filter(F.col("arr_delay").isNotNull())
        .withColumn("half_day", half_day("dep_time"))
    )


def best_per(flights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The flight with the least arrival delay of each key.

    Every task first reduces its own flights to the best one per key, which Spark
    does before the exchange for a first place in a window (``WindowGroupLimit``).
    So a key sends at most one row per task, also one with a third of all flights.
    That takes a sort in each task; with a hash of the key as its first column,
    rows are told apart by one number and texts are compared within a key only.
    """
    if flights.isStreaming:
        best = F.min(F.struct(*CHOICE)).alias("best")
        return flights.groupBy(*keys).agg(best).select(*keys, "best.*")
    first = Window.partitionBy("key_hash", *keys).orderBy(*CHOICE)
    hashed = flights.select(F.xxhash64(*keys).alias("key_hash"), *keys, *CHOICE)
    placed = hashed.withColumn("place", F.row_number().over(first))
    return placed.filter(F.col("place") == 1).drop("key_hash", "place")


def best_flights(flights: DataFrame, blank_as_zero: bool = False) -> DataFrame:
    """Best flight for every route, date and half of the day."""
    known = candidates(flights, blank_as_zero).filter(F.col("half_day").isNotNull())
    return best_per(known, (*ROUTE_DAY, "half_day"))


def best_flight_on_date(
    flights: DataFrame, origin: str, dest: str, date: str, half: str, blank_as_zero: bool = False
) -> DataFrame:
    """All flights of one route, date (``yyyy-MM-dd``) and half of the day, best first."""
    wanted = (
        (F.col("origin") == origin)
        & (F.col("dest") == dest)
        & (F.col("flight_date") == F.lit(date).cast("date"))
        & (F.col("half_day") == half)
    )
    return candidates(flights, blank_as_zero).filter(wanted).orderBy(*CHOICE)


def leg_search(
    flights: DataFrame,
    origin: str,
    stop: str,
    dest: str,
    date: str,
    gap_days: int = 2,
    blank_as_zero: bool = False,
) -> DataFrame:
    """Flights for both legs of one trip, labelled 1 and 2, each leg best first.

    One scan serves both legs: a flight gets the label of each leg it fits.
    """
    start = F.lit(date).cast("date")

    def fits(x: str, y: str, day: Column) -> Column:
        return (F.col("origin") == x) & (F.col("dest") == y) & (F.col("flight_date") == day)

    first, second = fits(origin, stop, start), fits(stop, dest, shift_date(start, gap_days))
    labels = F.array_compact(F.array(F.when(first, 1), F.when(second, 2))).cast("array<bigint>")
    return (
        candidates(flights, blank_as_zero)
        .filter(first | second)
        .select(
            F.explode(labels).alias("leg"), *ROUTE_DAY, "dep_time", "carrier",
            "flight_num", "arr_delay",
        )
        .orderBy("leg", *CHOICE)
    )


def trip_columns(first: Sequence[str], second: Sequence[str]) -> list[Column]:
    """The result columns of a trip from its two legs, prefixed ``a_`` and ``b_``."""
    total = (F.col("a_arr_delay") + F.col("b_arr_delay")).alias("total_delay")
    return [
        F.col("a_origin").alias("origin"),
        F.col("a_dest").alias("stop"),
        F.col("b_dest").alias("dest"),
        F.col("a_flight_date").alias("flight_date"),
        *[F.col(f"a_{c}").alias(f"leg1_{c}") for c in first],
        *[F.col(f"b_{c}").alias(f"leg2_{c}") for c in second],
        total,
    ]


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def join_legs(legs: DataFrame, others: DataFrame, gap_days: int = 2) -> DataFrame:
    """Trips from the morning legs of ``legs`` and the afternoon legs of ``others``."""
    first = prefixed(legs.filter(F.col("half_day") == "AM").drop("half_day"), "a_")
    second = prefixed(others.filter(F.col("half_day") == "PM").drop("half_day"), "b_")
    meet = (F.col("a_dest") == F.col("b_origin")) & (
        shift_date("a_flight_date", gap_days) == F.col("b_flight_date")
    )
    return first.join(second, meet).select(*trip_columns(CHOICE, CHOICE))


def on_trip(
    flights: DataFrame,
    origin: str | None,
    stop: str | None,
    dest: str | None,
    date: str | None,
    gap_days: int,
) -> DataFrame:
    """The flights, or legs, that can be part of a trip for which some of these are given."""

    def fits(start: str | None, end: str | None, days: int) -> Column:
        wanted = F.lit(True)
        for column, value in (("origin", start), ("dest", end)):
            if value is not None:
                wanted = wanted & (F.col(column) == value)
        if date is not None:
            wanted = wanted & (F.col("flight_date") == F.date_add(F.lit(date).cast("date"), days))
        return wanted

    return flights.filter(fits(origin, stop, 0) | fits(stop, dest, gap_days))


def two_leg_best(
    flights: DataFrame,
    gap_days: int = 2,
    blank_as_zero: bool = False,
    origin: str | None = None,
    stop: str | None = None,
    dest: str | None = None,
    date: str | None = None,
) -> DataFrame:
    """Best trip X-Y-Z for every X, Y, Z and date, or for those given: morning leg, then an
    afternoon leg ``gap_days`` later.

    The legs' delays add up, so the best trip is made of the best flight of
    each leg. Choosing those first leaves one row per route, date and half of
    the day, and the join never sees the flights of a busy stop, nor all pairs
    of them. Both sides of the join read that reduced table from one written
    copy: the flights are scanned once.
    """
    asked = on_trip(flights, origin, stop, dest, date, gap_days)
    both = best_flights(asked, blank_as_zero).filter(is_airport("dest"))
    legs = written_once(both, "best-legs", partition_by=("half_day",))
    return chosen_trips(join_legs(legs, legs, gap_days), origin, stop, dest, date)


def chosen_trips(
    trips: DataFrame,
    origin: str | None = None,
    stop: str | None = None,
    dest: str | None = None,
    date: str | None = None,
) -> DataFrame:
    wanted = {"origin": origin, "stop": stop, "dest": dest, "flight_date": date}
    for column, value in wanted.items():
        if value is not None:
            trips = trips.filter(F.col(column) == value)
    return trips
