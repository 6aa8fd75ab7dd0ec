"""Batch outputs: CSV with a header, message lines, report lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightrank.functions import flight_report, json_array
from flightrank.session import shared_folder
from flightrank.sources import BATCH_HEADER


def write_csv(results: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header. ``one_file`` is for limited results: one task writes all of it."""
    (results.coalesce(1) if one_file else results).write.option("header", True).csv(path)


def messages(results: DataFrame) -> DataFrame:
    """One JSON array message per result row, in the ``value`` column."""
    return results.select(json_array(results.schema).alias("value"))


def _entity(results: DataFrame, entity: Sequence[str]) -> Column:
    names = [F.date_format(c, "yyyy-MM-dd") if dict(results.dtypes)[c] == "date" else c for c in entity]
    return F.concat_ws(" ", *names)


def answer_messages(results: DataFrame, entity: Sequence[str], metric: str) -> DataFrame:
    """One message of two parts per row, ``["ATL AA", 0.5]``, as ``parse_messages`` reads them.

    ``entity``: the columns that tell the rows of an answer apart, joined by a
    space. An answer about one airport names the carrier alone; one about every
    airport names the airport as well.
    """
    return messages(results.select(_entity(results, entity).alias("entity"), metric))


def batch_messages(results: DataFrame, entity: Sequence[str], metric: str, batch_id: int) -> DataFrame:
    """The messages of ``answer_messages`` with the entity as their ``key``, which also keeps
    those of one entity in order, and the micro-batch in their ``headers``.

    A batch that runs again sends them again, all equal to the first ones, so
    ``sources.parse_batch_messages`` can tell that it has them.
    """
    parts = results.select(_entity(results, entity).alias("entity"), metric)
    number = F.struct(F.lit(BATCH_HEADER).alias("key"), F.lit(str(batch_id)).cast("binary").alias("value"))
    return parts.select(
        F.col("entity").alias("key"), json_array(parts.schema).alias("value"), F.array(number).alias("headers")
    )


def report_lines(flights: DataFrame) -> DataFrame:
    """One line of text per flight."""
    return flights.select(flight_report().alias("line"))


def write_report(flights: DataFrame, path: str) -> None:
    report_lines(flights).write.text(path)


def as_text_files(spark: SparkSession, lines: DataFrame, label: str) -> str:
    """Write a ``value`` column as text files into the shared folder; returns the folder."""
    path = shared_folder(spark, label)
    lines.select("value").write.text(path)
    return path
