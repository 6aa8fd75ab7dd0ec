"""CSV with a header, read whole: rows that can be used, and the others with their reasons.

A row with too few or too many fields, or with a field that should be a number, a
date or a time and is not, is no flight or record; it goes to a table of its own
with what is wrong. Both tables come from one reading of every field, so each row
of the files is in exactly one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Columns that the reading adds: what is wrong with a row, and the row as text.
PROBLEMS, RECORD = "problems", "record"
_MALFORMED = "_malformed"

WRONG_FIELDS = "number of fields"


def read_checked(
    spark: SparkSession,
    path: str,
    typed: dict[str, Column],
    raw: dict[str, str],
    checks: dict[str, Column] | None = None,
    header: list[str] | None = None,
) -> DataFrame:
    """The ``typed`` columns of every row with ``problems`` and ``record``.

    ``raw`` names the field behind each typed column. A field that has text but no
    value is a problem; its value is that of ``checks``, by default of ``typed``.
    ``header``: the fields of files without a header line.
    """
    names = header or spark.read.option("header", True).csv(path).columns
    absent = sorted(set(raw.values()) - set(names))
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    fields = [f"`{n}`" for n in names]
    # Without pruning, so that a row is malformed or not whichever columns are asked for.
    rows = (
        spark.read.schema(", ".join(f"{n} string" for n in [*fields, _MALFORMED]))
        .option("header", header is None)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _MALFORMED)
        .csv(path)
    )
    malformed = F.col(_MALFORMED).isNotNull()

    def unreadable(name: str, value: Column) -> Column:
        text = F.col(f"`{raw[name]}`")
        return F.when(
            ~malformed & (F.trim(text) != "") & value.isNull(), F.concat(F.lit(f"{name}: "), text)
        )

    problems = F.array_compact(
        F.array(F.when(malformed, WRONG_FIELDS), *[unreadable(n, c) for n, c in (checks or typed).items()])
    )
    return rows.select(
        *[c.alias(n) for n, c in typed.items()],
        problems.alias(PROBLEMS),
        F.coalesce(F.col(_MALFORMED), F.to_csv(F.struct(*fields))).alias(RECORD),
    )


def counted_checks(checked: DataFrame, as_name: str | Observation) -> DataFrame:
    """``checked`` with its counts observed: all rows, and those that are rejected."""
    return checked.observe(
        as_name,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.size(PROBLEMS) > 0).alias("rejected"),
    )


def usable(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(PROBLEMS) == 0).drop(PROBLEMS, RECORD)


def rejects(checked: DataFrame) -> DataFrame:
    """The rows that are not usable, as text, with what is wrong with each."""
    return checked.filter(F.size(PROBLEMS) > 0).select(RECORD, PROBLEMS)
