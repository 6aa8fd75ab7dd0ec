"""A corpus pipeline: toxic documents go, then copies, then near copies; the rest is packed.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.

Defined results: a null text is the empty text in every stage, so documents
without a text are copies of each other and one of them is left, however long the
others; texts of any length are read whole; of equal texts the row of the largest
id stays, and any id beats null; of near copies the smallest id's; of rows that
repeat one stays; an empty table goes through all stages and gives no rows;
columns of ``documents`` beyond ``doc_id`` and ``text`` are carried along, also
where operators use their names. Labels of ids that ``documents`` does not have
are not used, and without labels nothing is toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightrank.llm import exact_dedup, packing, queries, simhash, toxicity
from flightrank.session import written_once


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.count_ids)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("packing", pack),
]

# Toxicity, fingerprints and tokens are beyond SQL; a brute-force version tests the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_once(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
