"""The questions, each a function from flights to its answer. Batch and micro-batches share them.

The functions at the end answer from the keyed text files that earlier jobs wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightrank.functions import is_airport, is_carrier
from flightrank.operators.popularity import airport_counts
from flightrank.operators.ranking import mean_delay, placed, ranked, top_k, top_k_per_key
from flightrank.sources import parse_best_flights, parse_key_metric, parse_pair_metric


def popular_airports(flights: DataFrame, k: int | None = 10) -> DataFrame:
    """Airports by flights to and from them; ``k=None`` gives the whole ranking."""
    counts = airport_counts(flights)
    if k is None:
        return ranked(counts, "n", ["airport"], ascending=False)
    return top_k(counts, "n", ["airport"], k, ascending=False)


def carriers(
    flights: DataFrame, metric: str = "arr_delay", k: int = 10, ascending: bool = True
) -> DataFrame:
    """Carriers by mean delay, most punctual first unless ``ascending`` is false."""
    means = mean_delay(flights.filter(is_carrier("carrier")), ["carrier"], metric)
    return top_k(means, "mean_delay", ["carrier"], k, ascending)


def carriers_from(
    flights: DataFrame, origin: str | None = None, metric: str = "dep_delay", k: int = 10
) -> DataFrame:
    """Carriers by mean departure delay from ``origin``, or from every airport with ``rank``."""
    known = flights.filter(is_carrier("carrier") & is_airport("origin"))
    return _top_for(known, ["origin"], [origin], "carrier", metric, k)


def destinations_from(
    flights: DataFrame, origin: str | None = None, metric: str = "dep_delay", k: int = 10
) -> DataFrame:
    """Destinations by mean departure delay from ``origin``, or from every airport with ``rank``."""
    return _top_for(flights.filter(is_airport("origin")), ["origin"], [origin], "dest", metric, k)


def carriers_on_route(
    flights: DataFrame,
    origin: str | None = None,
    dest: str | None = None,
    metric: str = "arr_delay",
    k: int = 10,
) -> DataFrame:
    """Carriers by mean arrival delay on one route, or on every route with ``rank``."""
    known = flights.filter(is_carrier("carrier") & is_airport("origin"))
    return _top_for(known, ["origin", "dest"], [origin, dest], "carrier", metric, k)


def _top_for(
    flights: DataFrame, by: list[str], wanted: list[str | None], entity: str, metric: str, k: int
) -> DataFrame:
    for column, value in zip(by, wanted):
        if value is not None:
            flights = flights.filter(F.col(column) == value)
    means = mean_delay(flights, [*by, entity], metric)
    if None in wanted:
        return top_k_per_key(means, by, "mean_delay", [entity], k)
    return top_k(means, "mean_delay", [entity], k)


def all_carriers_on_routes(flights: DataFrame, metric: str = "arr_delay") -> DataFrame:
    """Every carrier of every route in one ranking by mean delay, with its places."""
    known = flights.filter(is_carrier("carrier") & is_airport("origin"))
    means = mean_delay(known, ["origin", "dest", "carrier"], metric)
    return placed(means, "mean_delay", ["origin", "dest", "carrier"])


def all_airports(flights: DataFrame) -> DataFrame:
    """Every airport by flights to and from it, with its places."""
    return placed(airport_counts(flights), "n", ["airport"], ascending=False)


def route_delays(flights: DataFrame, metric: str = "arr_delay") -> DataFrame:
    """Mean delay of every route."""
    return mean_delay(flights, ["origin", "dest"], metric)


def key_results(lines: DataFrame, k: int | None = None, ascending: bool = False) -> DataFrame:
    """Ranking of ``key<tab>metric`` lines, greatest first unless ``ascending``."""
    rows = parse_key_metric(lines)
    if k is None:
        return ranked(rows, "metric", ["key"], ascending)
    return top_k(rows, "metric", ["key"], k, ascending)


def pair_results(
    lines: DataFrame,
    first: str,
    second: str,
    metric: str,
    wanted: str | None = None,
    k: int | None = None,
) -> DataFrame:
    """``first second<tab>metric`` lines in order, for one ``first`` or for all; of each
    ``first`` the best ``k`` only, if that is given."""
    rows = parse_pair_metric(lines, first, second, metric)
    if wanted is not None:
        rows = rows.filter(F.col(first) == wanted)
    if k is not None:
        rows = top_k_per_key(rows, [first], metric, [second], k).drop("rank")
    return rows.orderBy(first, metric, second)


def best_flight_results(
    lines: DataFrame, origin: str, dest: str, date: str, half_day: str
) -> DataFrame:
    """Best-flight lines of one route, date (``yyyy-MM-dd``) and half of the day, best first."""
    wanted = {"origin": origin, "dest": dest, "flight_date": date, "half_day": half_day}
    rows = parse_best_flights(lines)
    for column, value in wanted.items():
        rows = rows.filter(F.col(column) == value)
    return rows.orderBy("mean_delay", "carrier", "flight_num", "dep_time")
