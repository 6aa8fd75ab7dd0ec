"""Text forms of results: messages, numbers, report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def python_float(c: Column | str) -> Column:
    """A number as plain decimal text with at least one decimal: ``12446097.0``, ``0.0001``.

    A cast to string gives the shortest digits that stand for the number, but
    from ten million on and below a thousandth with an exponent. A decimal of
    enough places writes the same digits out; its trailing zeros go. Numbers
    of 1e27 and more, or closer to zero than 1e-11, keep the exponent.
    """
    c = F.col(c) if isinstance(c, str) else c
    number = c.cast("double")
    shortest, size = number.cast("string"), F.abs(number)

    def written_out(decimal: str) -> Column:
        return F.regexp_replace(shortest.try_cast(decimal).cast("string"), r"(\.\d+?)0+$", "$1")

    return (
        F.when(number == 0, "0.0")
        .when((size >= 1e-11) & (size < 1e9), written_out("decimal(38,28)"))
        .when((size >= 1e9) & (size < 1e27), written_out("decimal(38,10)"))
        .otherwise(shortest)
    )


def _json_value(name: str, data_type: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        text = python_float(name)
    elif isinstance(data_type, (T.IntegralType, T.BooleanType)):
        text = c.cast("string")
    else:
        # Escape through Spark's own JSON writer: ["..."] without its brackets.
        as_array = F.to_json(F.array(c.cast("string")))
        text = as_array.substr(F.lit(2), F.length(as_array) - 2)
    return F.when(c.isNull(), "null").otherwise(text)


def json_array(schema: T.StructType) -> Column:
    """One JSON array per row, its columns in order: ``["STX", -2.8]``."""
    values = [_json_value(f.name, f.dataType) for f in schema.fields]
    return F.concat(F.lit("["), F.concat_ws(", ", *values), F.lit("]"))


# Fixed value: the form of a report line.
REPORT_LINE = "%s -> %s on %s: Flight: %s %s at %s. Arrival Delay: %s"


def flight_report() -> Column:
    """``X -> Y on D: Flight: C N at T. Arrival Delay: d``; NULL fields read ``None``."""

    def shown(c: Column) -> Column:
        return F.coalesce(c, F.lit("None"))

    return F.format_string(
        REPORT_LINE,
        shown(F.col("origin")),
        shown(F.col("dest")),
        shown(F.date_format("flight_date", "yyyy-MM-dd")),
        shown(F.col("carrier")),
        shown(F.col("flight_num")),
        shown(F.col("dep_time")),
        shown(python_float("arr_delay")),
    )
