"""Raw flight lines to typed flights, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightrank.functions import clock_time, delay_minutes, remove_quotes
from flightrank.schema import ALL_FIELDS, FIELD_POSITION, HEADER_MARK, HEADER_NAMES
from flightrank.sources.checked_csv import counted_checks, read_checked, rejects, usable


def _fields() -> Column:
    """The fields that are read and, unsplit, whatever comes after them."""
    return F.split(F.col("value").cast("string"), ",", ALL_FIELDS + 1)


def _n_fields() -> Column:
    text = F.col("value").cast("string")
    return F.length(text) - F.length(F.replace(text, F.lit(","))) + 1


def _is_header(fields: Column) -> Column:
    return F.upper(remove_quotes(F.get(fields, F.lit(0)))) == HEADER_MARK


def _typed(raw: dict[str, Column], legacy_len: bool) -> dict[str, Column]:
    return {
        "flight_num": raw["flight_num"],
        "carrier": raw["carrier"],
        "origin": raw["origin"],
        "dest": raw["dest"],
        "flight_date": raw["flight_date"].try_cast("date"),
        "dep_time": clock_time(raw["dep_time"]),
        "dep_delay": delay_minutes(raw["dep_delay"], legacy_len),
        "arr_delay": delay_minutes(raw["arr_delay"], legacy_len),
    }


def counted(lines: DataFrame, as_name: str | Observation, min_fields: int = ALL_FIELDS) -> DataFrame:
    """``lines`` with their counts observed: all, too short ones, headers.

    An ``Observation`` reports them after a batch action. For a stream give a
    name: the counts of a micro-batch are then in its progress, under that name.
    """
    header = _is_header(_fields())
    return lines.observe(
        as_name,
        F.count(F.lit(1)).alias("lines"),
        F.count_if((F.size(_fields()) < min_fields) & ~header).alias("short"),
        F.count_if(header).alias("headers"),
    )


def parse_flights(
    lines: DataFrame,
    legacy_len: bool = False,
    line_counts: str | Observation | None = None,
    min_fields: int = ALL_FIELDS,
) -> DataFrame:
    """Parse a ``value`` column of comma-separated lines, batch or stream.

    Lines of fewer than ``min_fields`` fields (``schema.FIELDS_FOR`` a metric) and
    header lines are left out: ``line_counts`` reports how many there were (see ``counted``) and
    ``rejected_lines`` returns the short ones. A field behind the end of a line
    is NULL.
    """
    if line_counts is not None:
        lines = counted(lines, line_counts, min_fields)
    # The one-element explode keeps the filter above the split: pushed below it,
    # or into a join under it, the filter would split every line again.
    split = lines.select(F.explode(F.array(_fields())).alias("fields"))
    kept = split.filter((F.size("fields") >= min_fields) & ~_is_header(F.col("fields")))
    raw = {
        name: remove_quotes(F.get(F.col("fields"), F.lit(position)))
        for name, position in FIELD_POSITION.items()
    }
    return kept.select(*[c.alias(name) for name, c in _typed(raw, legacy_len).items()])


def rejected_lines(lines: DataFrame, min_fields: int = ALL_FIELDS) -> DataFrame:
    """The lines that ``parse_flights`` finds too short, with their field count."""
    text = F.col("value").cast("string").alias("value")
    rows = F.struct(text, _n_fields().alias("n_fields"), _is_header(_fields()).alias("header"))
    split = lines.select(F.inline(F.array(rows)))
    return split.filter((F.col("n_fields") < min_fields) & ~F.col("header")).drop("header")


def checked_by_name(
    spark: SparkSession,
    path: str,
    names: dict[str, str] = HEADER_NAMES,
    legacy_len: bool = False,
) -> DataFrame:
    """Every row of CSV files with a header, by column name, with what is wrong with it."""
    fields = {ours: F.col(f"`{theirs}`") for ours, theirs in names.items()}
    # A delay that the legacy rule leaves out can still be read, so its row is no problem.
    return read_checked(spark, path, _typed(fields, legacy_len), names, _typed(fields, False))


def flights_by_name(
    spark: SparkSession,
    path: str,
    names: dict[str, str] = HEADER_NAMES,
    legacy_len: bool = False,
    line_counts: Observation | None = None,
) -> DataFrame:
    """Read CSV files with a header through Spark's quote-aware reader, by column name.

    Rows with a field that cannot be read are left out: ``line_counts`` reports how
    many, ``rejected_by_name`` returns them.
    """
    checked = checked_by_name(spark, path, names, legacy_len)
    if line_counts is not None:
        checked = counted_checks(checked, line_counts)
    return usable(checked)


def rejected_by_name(spark: SparkSession, path: str, names: dict[str, str] = HEADER_NAMES) -> DataFrame:
    """The rows that ``flights_by_name`` leaves out: ``record`` and its ``problems``."""
    return rejects(checked_by_name(spark, path, names))


def render_lines(flights: DataFrame, whole_minutes: bool = False) -> DataFrame:
    """Write flights as raw lines: quoted texts, two city names with an inner comma."""

    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"'))

    def minutes(name: str) -> Column:
        number = F.col(name).cast("bigint") if whole_minutes else F.col(name)
        return F.coalesce(number.cast("string"), F.lit(""))

    date = F.date_format("flight_date", "yyyy-MM-dd")
    shown = {
        "year": F.coalesce(F.year("flight_date").cast("string"), F.lit("")),
        "flight_date": F.coalesce(date, F.lit("")),
        "carrier": quoted(F.col("carrier")),
        "flight_num": quoted(F.col("flight_num")),
        "origin": quoted(F.col("origin")),
        "dest": quoted(F.col("dest")),
        "dep_time": quoted(F.col("dep_time")),
        "dep_delay": minutes("dep_delay"),
        "arr_delay": minutes("arr_delay"),
    }
    at = {FIELD_POSITION[name]: c for name, c in shown.items()}
    # A city follows each airport code and takes two places, its comma included.
    for code in ("origin", "dest"):
        position = FIELD_POSITION[code] + 1
        at[position] = F.concat(F.lit('"'), F.col(code), F.lit(" city"))
        at[position + 1] = F.lit(' ST"')
    # Empty fields between two filled ones make one constant run of commas.
    pieces, commas = [], ""
    for position in range(ALL_FIELDS):
        if position in at:
            pieces += [F.lit(commas), F.coalesce(at[position], F.lit(""))]
            commas = ""
        commas += ","
    return flights.select(F.concat(*pieces).alias("value"))
