"""Column expressions and numbering that several operators share."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold_case(text: Column) -> Column:
    """Lower-case A-Z only; null counts as the empty text.

    For a text of ASCII alone ``lower`` does just that and is faster than ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(text)).otherwise(folded)


def fresh_name(wanted: str, columns: Sequence[str]) -> str:
    """``wanted``, with underscores before it while a column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def numbered(
    table: DataFrame,
    group: str,
    cell: str,
    order: Sequence[str],
    name: str,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: a number from 0 without gaps within ``group``, in the order of
    ``cell`` and then ``order``.

    A window over a whole group would sort it in one task. Here a task sorts one
    cell of a group, and the counts of the cells before it come from prefix sums
    over the cell totals. ``cell`` is a whole number that the caller chooses so
    that a cell's rows fit one task, whatever the size of the group. ``cells``:
    the rows of each group and cell, ``_rows``, if they can be had cheaper.
    """
    place, base = (fresh_name(n, [*table.columns, name]) for n in ("_place", "_base"))
    inside = Window.partitionBy(group, cell).orderBy(*order)
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    if cells is None:
        cells = table.groupBy(group, cell).agg(F.count(F.lit(1)).alias("_rows"))
    bases = cells.select(group, cell, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(base))
    counted = table.withColumn(place, F.row_number().over(inside) - 1)
    return (
        counted.join(bases, [group, cell])
        .withColumn(name, (F.col(base) + F.col(place)).cast("long"))
        .drop(base, place)
    )


def schema_with(table: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of ``table`` and one more column."""
    return T.StructType([*table.schema.fields, T.StructField(name, kind)])
