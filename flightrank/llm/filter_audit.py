"""Which filter of a chain removes what, in every order of the filters.

A document is summed up by a mask, one bit per filter that it fails. What each
step of each order does with a document follows from the mask alone, so every
mask is mapped once to one wide whole number: a field per step of an order and
counter, ``FIELD_BITS`` bits each. The numbers of a part's documents are added,
and the fields of the sum are the counts of all steps at once. A document adds
at most one to a field and a count of documents is a long, so no field runs over
into the next.

Documents are counted by part, mask and labels before they are added: at most
``4 * 2 ** filters`` rows per part, whatever its size, so a hot part is no hot
group. Copies are found by the digest of the text (SHA-256): the least id of a
digest is reduced in each task first, rows that repeat are counted before the
join, and the join is on digest and id together, so a group of copies of any
size is spread like all other rows.

Defined results: null text is the empty text; null source is the part ``''``; a
document fails ``E`` if a smaller id has the same text, so of rows that repeat
the least id's all pass, and rows without an id neither fail nor are compared
with; a document without a label has neither; of several labels of one id any 1
counts; other columns of the input are not used; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightrank.llm.shipping import ship
from flightrank.session import written_once

COPIES = "E"
FIELD_BITS = 64
COUNTERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SPACE = r"[\x20\x09-\x0D]+"


def text_filters() -> dict[str, Column]:
    """The conditions under which a text fails, by the letter of the filter."""
    text, words = F.col("text"), F.col("words")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def masked(docs: DataFrame, filters: Callable[[], dict[str, Column]] = text_filters) -> DataFrame:
    """Documents by ``part``, ``doc_id`` and failed text filters: ``digest part doc_id mask n``,
    rows that repeat counted."""
    texts = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    )
    words = F.array_remove(F.split("text", SPACE), "").alias("words")
    split = texts.select(F.inline(F.array(F.struct("*", words))))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(filters().values())]
    mask = sum(bits, F.lit(0)).alias("mask")
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    keys = ("digest", "part", "doc_id", "mask")
    return split.select(digest, "part", "doc_id", mask).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``; rows without an id keep out of the join."""
    any_one = [
        F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name)
        for c, name in (("quality", "good"), ("toxic", "toxic"))
    ]
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*any_one)
    found = rows.filter(F.col("doc_id").isNotNull()).join(known, "doc_id", "left")
    found = found.fillna(False, ["good", "toxic"])
    rest = rows.filter(F.col("doc_id").isNull()).withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    return found.unionByName(rest)


def _with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """``rows`` with ``bit`` added to the mask where a smaller id has the same text."""
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = rows.join(least, ["digest", "doc_id"], "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return marked.withColumn("mask", F.col("mask") + F.when(copy, bit).otherwise(0)).drop("first")


def tallies(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How many documents each ``part mask good toxic`` has."""
    rows = written_once(masked(docs), "filter-masks")
    whole = _labelled(_with_copies(rows, 1 << len(text_filters())), labels)
    return whole.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


class Packed:
    """The wide numbers of every mask, and the counts back from their sums."""

    def __init__(self, letters: Sequence[str]):
        self.letters = tuple(letters)
        self.orders = list(itertools.permutations(range(len(letters))))
        self.steps = len(self.orders) * len(letters)
        self._made: dict[tuple[int, bool, bool], int] = {}

    def fields(self, mask: int, good: bool, toxic: bool) -> list[int]:
        """What one document adds to every counter of every step."""
        added = []
        for order in self.orders:
            present = True
            for f in order:
                fails = mask >> f & 1
                removed = present and fails
                added += [
                    present and not fails,
                    removed,
                    fails and not present,
                    mask == 1 << f,
                    removed and good,
                    removed and toxic,
                ]
                present = present and not fails
        return list(map(int, added))

    def number(self, mask: int, good: bool, toxic: bool) -> int:
        key = (mask, good, toxic)
        if key not in self._made:
            self._made[key] = sum(x << FIELD_BITS * i for i, x in enumerate(self.fields(*key)))
        return self._made[key]

    def counts(self, total: int) -> np.ndarray:
        """One row per step of every order, one column per counter."""
        width = self.steps * len(COUNTERS) * FIELD_BITS // 8
        return np.frombuffer(total.to_bytes(width, "little"), "<u8").reshape(self.steps, len(COUNTERS))

    def table(self, part: str, total: int) -> pd.DataFrame:
        counts = pd.DataFrame(self.counts(total).astype(np.int64), columns=list(COUNTERS))
        names = ["".join(self.letters[f] for f in order) for order in self.orders]
        counts.insert(0, "part", part)
        counts.insert(1, "filter_order", np.repeat(names, len(self.letters)))
        counts.insert(2, "step", np.tile(np.arange(1, len(self.letters) + 1, dtype=np.int32), len(names)))
        of_filter = [order[s - 1] for order, s in zip(counts["filter_order"], counts["step"])]
        counts["shapley"] = counts["removed"].groupby(of_filter).transform("sum")
        return counts


AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in (*COUNTERS, "shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every step of every order of the filters for every part.

    ``shapley`` is the removals of the step's filter summed over all orders: over
    their number it is the filter's Shapley value.
    """
    ship(docs.sparkSession)
    packed = Packed([*text_filters(), COPIES])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for mask, good, toxic, n in zip(rows["mask"], rows["good"], rows["toxic"], rows["n"]):
            total += int(n) * packed.number(int(mask), bool(good), bool(toxic))
        return packed.table(rows["part"].iloc[0], total)

    return tallies(docs, labels).groupBy("part").applyInPandas(add, AUDIT)
