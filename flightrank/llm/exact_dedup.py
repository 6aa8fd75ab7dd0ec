"""Exact deduplication by skew-safe combining.

Equal texts are combined three times, by their full content each time: within a
task (the partial aggregate), within a salt of a digest, and over the salts.
A digest only decides where rows meet. However many copies a text has, the
second exchange gets at most one row per task and the third at most one per salt.

Defined results: null is the empty text; texts are equal if they are identical
after lower-casing A-Z; of equal texts the row with the largest ``doc_id`` stays
(any id beats null); of repeated rows with that id and text exactly one stays;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightrank.llm.text import fold_case, fresh_name
from flightrank.session import written_once

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _combined(texts: DataFrame, salts: int) -> DataFrame:
    """One row per digest and text: ``keep_id`` and ``group_size``."""
    rows = texts.withColumn("n", F.lit(1)).withColumn("salt", F.spark_partition_id() % salts)

    def combine(by: list[str], table: DataFrame) -> DataFrame:
        return table.groupBy(*by).agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"))

    salted = combine(["digest", "salt", "folded"], rows)
    # By digest alone, so that texts that share a digest meet for the count of variants.
    over_salts = combine(["digest", "folded"], salted.drop("salt").repartition("digest"))
    return over_salts.select(
        "digest", "folded", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size")
    )


def _texts(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    folded = docs.select("doc_id", fold_case(F.col("text")).alias("folded"))
    return folded.withColumn("digest", digest(F.col("folded")))


def copy_groups(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> tuple[DataFrame, DataFrame | None]:
    """Groups of equal texts.

    Returns one row per digest that a single text has (``digest keep_id
    group_size``) and, only if texts that differ share a digest, those texts
    (``digest folded keep_id group_size``). Both are written once; the first
    holds no text.
    """
    texts = _texts(docs, digest)
    by_digest = (
        _combined(texts, salts)
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("variants"),
            F.max("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        )
    )
    groups = written_once(by_digest, "copy-groups")
    single = groups.filter("variants = 1").drop("variants")
    shared = groups.filter("variants > 1").select("digest")
    if shared.isEmpty():
        return single, None
    apart = texts.join(shared, "digest", "left_semi")
    return single, written_once(_combined(apart, salts), "colliding-texts")


def exact_copies(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id keep_id group_size kept text_sha256``."""
    single, colliding = copy_groups(docs, salts, digest)
    texts = _texts(docs, digest).withColumn("text_sha256", F.sha2("folded", 256))
    found = _placed(texts.drop("folded"), ["digest"], single)
    if colliding is not None:
        found = found.unionByName(
            _placed(texts, ["digest", "folded"], colliding).select(*found.columns)
        )
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _placed(texts: DataFrame, by: list[str], groups: DataFrame) -> DataFrame:
    # The copies of a row are numbered before the join, so that Spark may still
    # split a large group's side of the join among tasks.
    again = Window.partitionBy("doc_id", *by).orderBy("doc_id")
    rows = texts.withColumn("again", F.row_number().over(again))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("again") == 1)
    return rows.join(groups, by).withColumn("kept", kept)


def keep_last(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they are."""
    single, colliding = copy_groups(docs, salts, digest)
    key, folded, again = (fresh_name(c, docs.columns) for c in ("digest", "folded", "again"))
    rows = docs.withColumn(folded, fold_case(F.col("text"))).withColumn(key, digest(F.col(folded)))

    def stay(by: dict[str, str], groups: DataFrame) -> DataFrame:
        meet = [rows[a] == groups[b] for a, b in by.items()]
        kept = rows.join(groups, [*meet, rows["doc_id"].eqNullSafe(groups["keep_id"])], "left_semi")
        order = Window.partitionBy("doc_id", *by).orderBy("text")
        return kept.withColumn(again, F.row_number().over(order)).filter(F.col(again) == 1)

    left = stay({key: "digest"}, single)
    if colliding is not None:
        left = left.unionByName(stay({key: "digest", folded: "folded"}, colliding))
    return left.select(*docs.columns)
