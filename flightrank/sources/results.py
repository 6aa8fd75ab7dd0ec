"""Readers for ranking results: keyed text, frequency files, messages, CSV records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightrank.functions import delay_minutes, is_airport, remove_quotes
from flightrank.sources.checked_csv import PROBLEMS, counted_checks, read_checked, rejects, usable

# The header of a message that holds the number of its micro-batch.
BATCH_HEADER = "batch"

# Result tables and the columns of their records.
RECORD_SHAPES = {
    "top-airports-for-each-airport": (
        "origin_airport string, dest_airport string, average_arrival_delay double"
    ),
    "top-carriers-for-each-airport": (
        "origin_airport string, carrier string, average_arrival_delay double"
    ),
    "best-flight-on-a-given-date": (
        "origin_airport string, dest_airport string, date string, am_pm string, "
        "carrier string, flight_number string, time string, average_departure_delay double"
    ),
    "average-airport-delay-for-each-airport": (
        "airport string, carrier string, average_departure_delay double"
    ),
}


def _tab_field(i: int) -> Column:
    return remove_quotes(F.get(F.split("value", "\t"), F.lit(i)))


def _flight_parts(i: int) -> Column:
    return F.split(_tab_field(i), " ")


def _message_parts() -> Column:
    return F.split(F.translate(F.col("value").cast("string"), "()[]\"'", ""), ",")


# Whether a line of each kind can be read; a line that cannot is left out.
READABLE: dict[str, Callable[[], Column]] = {
    "key": lambda: delay_minutes(_tab_field(1)).isNotNull(),
    "pair": lambda: READABLE["key"]() & (F.size(F.split(_tab_field(0), " ")) == 2),
    "best_flight": lambda: (F.size(_flight_parts(0)) == 4)
    & (F.size(_flight_parts(1)) == 4)
    & delay_minutes(F.get(_flight_parts(1), F.lit(3))).isNotNull(),
    "frequency": lambda: delay_minutes(F.get(F.split(F.trim("value"), "\\s+"), F.lit(0))).isNotNull(),
    "message": lambda: (F.size(_message_parts()) == 2)
    & delay_minutes(F.trim(F.get(_message_parts(), F.lit(1)))).isNotNull(),
}


def counted_results(lines: DataFrame, kind: str, as_name: str | Observation) -> DataFrame:
    """``lines`` with their counts observed: all, and those that ``kind`` cannot read."""
    readable = F.coalesce(READABLE[kind](), F.lit(False))
    return lines.observe(
        as_name, F.count(F.lit(1)).alias("lines"), F.count_if(~readable).alias("unreadable")
    )


def parse_key_metric(lines: DataFrame) -> DataFrame:
    """``"key"<tab>number`` lines; lines without a readable number are left out."""
    return lines.select(
        _tab_field(0).alias("key"), delay_minutes(_tab_field(1)).alias("metric")
    ).filter(F.col("metric").isNotNull())


def parse_pair_metric(lines: DataFrame, first: str, second: str, metric: str) -> DataFrame:
    """``"A B"<tab>number`` lines to (first, second, metric); keys of other lengths are left out."""
    parts = F.split("key", " ")
    return (
        parse_key_metric(lines)
        .filter(F.size(parts) == 2)
        .select(
            F.get(parts, F.lit(0)).alias(first),
            F.get(parts, F.lit(1)).alias(second),
            F.col("metric").alias(metric),
        )
    )


def parse_best_flights(lines: DataFrame) -> DataFrame:
    """``"X Y date AM"<tab>"carrier number time delay"`` lines."""
    pair = lines.select(_flight_parts(0).alias("route"), _flight_parts(1).alias("flight"))

    def part(column: str, i: int) -> Column:
        return F.get(F.col(column), F.lit(i))

    return (
        pair.filter((F.size("route") == 4) & (F.size("flight") == 4))
        .select(
            part("route", 0).alias("origin"),
            part("route", 1).alias("dest"),
            part("route", 2).alias("flight_date"),
            part("route", 3).alias("half_day"),
            part("flight", 0).alias("carrier"),
            delay_minutes(part("flight", 1)).alias("flight_num"),
            part("flight", 2).alias("dep_time"),
            delay_minutes(part("flight", 3)).alias("mean_delay"),
        )
        .filter(F.col("mean_delay").isNotNull())
    )


def parse_frequencies(lines: DataFrame) -> DataFrame:
    """``count<white space>code`` lines."""
    parts = F.split(F.trim("value"), "\\s+")
    return lines.select(
        delay_minutes(F.get(parts, F.lit(0))).alias("n"), F.get(parts, F.lit(1)).alias("airport")
    ).filter(F.col("n").isNotNull())


def parse_messages(messages: DataFrame) -> DataFrame:
    """Result messages such as ``["STX", -2.8]``: brackets and quotes dropped, two parts kept."""
    return (
        messages.select(_message_parts().alias("parts"))
        .filter(F.size("parts") == 2)
        .select(
            F.get("parts", F.lit(0)).alias("key"),
            delay_minutes(F.trim(F.get("parts", F.lit(1)))).alias("metric"),
        )
        .filter(F.col("metric").isNotNull())
    )


def checked_records(spark: SparkSession, table: str, path: str, header: bool = True) -> DataFrame:
    """Every row of CSV results by the fields of ``table``, with what is wrong with it."""
    fields = T.StructType.fromDDL(RECORD_SHAPES[table]).fields
    names = spark.read.option("header", True).csv(path).columns if header else [f.name for f in fields]
    # Fields are taken by place: earlier jobs name them differently.
    raw = {f.name: name for f, name in zip(fields, names)}
    if len(names) < len(fields):
        raise ValueError(f"{path} has {len(names)} fields, {table} needs {len(fields)}")
    typed = {f.name: F.col(f"`{raw[f.name]}`").try_cast(f.dataType) for f in fields}
    checked = read_checked(spark, path, typed, raw, header=None if header else names)
    no_code = ~F.coalesce(is_airport(fields[0].name), F.lit(False)) & (F.size(PROBLEMS) == 0)
    problem = F.when(no_code, F.array(F.lit(f"{fields[0].name}: no airport"))).otherwise(F.col(PROBLEMS))
    return checked.withColumn(PROBLEMS, problem)


def read_records(
    spark: SparkSession, table: str, path: str, header: bool = True, line_counts: Observation | None = None
) -> DataFrame:
    """CSV results as the typed records of ``table``.

    Rows that cannot be read or have no airport code are left out: ``line_counts``
    reports how many, ``rejected_records`` returns them.
    """
    checked = checked_records(spark, table, path, header)
    if line_counts is not None:
        checked = counted_checks(checked, line_counts)
    return usable(checked)


def rejected_records(spark: SparkSession, table: str, path: str, header: bool = True) -> DataFrame:
    """The rows that ``read_records`` leaves out: ``record`` and its ``problems``."""
    return rejects(checked_records(spark, table, path, header))


def parse_batch_messages(messages: DataFrame) -> DataFrame:
    """Messages that ``sinks.batch_messages`` made: ``batch_id key metric``, each once.

    A batch that ran again has sent the same messages a second time; a message is
    known by its batch and its key. Messages without a batch number are left out.
    """
    numbers = F.filter("headers", lambda h: h["key"] == BATCH_HEADER)
    number = F.get(numbers, F.lit(0))["value"].cast("string").try_cast("bigint")
    return (
        messages.select(
            number.alias("batch_id"), F.col("key").cast("string").alias("key"), _message_parts().alias("parts")
        )
        .filter(F.col("batch_id").isNotNull() & (F.size("parts") == 2))
        .withColumn("metric", delay_minutes(F.trim(F.get("parts", F.lit(1)))))
        .filter(F.col("metric").isNotNull())
        .groupBy("batch_id", "key")
        .agg(F.max("metric").alias("metric"))
    )
