"""The given star-schema and event tables seen as flights.

All derived numbers are whole, so means do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightrank.sources import file_stream


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _nation_code(nation: str) -> Column:
    return F.concat(F.lit("N"), _two_digits(F.col(nation)))


def _percent(share: str) -> Column:
    return F.floor(F.col(share) * 100 + 0.5).cast("int")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per line item: from the supplier's nation to the customer's.

    Airport codes are made once per supplier and customer, before the joins.
    Spark broadcasts a side only when its statistics are below the threshold.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", _nation_code("s_nationkey").alias("origin")
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", _nation_code("c_nationkey").alias("dest")
    )
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    arrived = ~((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7))
    late_out = F.col("l_quantity").cast("int") - 20
    made_up = _percent("l_tax") - _percent("l_discount")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("flight_num"),
        _two_digits(F.col("l_partkey") % 25).alias("carrier"),
        "origin",
        "dest",
        F.col("l_shipdate").cast("date").alias("flight_date"),
        F.lpad(((F.col("l_partkey") % 24) * 100).cast("string"), 4, "0").alias("dep_time"),
        F.when(arrived, late_out).cast("double").alias("dep_delay"),
        F.when(arrived, late_out + made_up).cast("double").alias("arr_delay"),
    )


def event_flights(events: DataFrame) -> DataFrame:
    """One flight per event, batch or stream."""
    minute = F.hour("ts") * 100 + F.minute("ts")
    arrived = F.col("event_id") % 40 != 0
    late_out = F.floor("value") - 20
    return events.select(
        F.col("event_id").cast("string").alias("flight_num"),
        F.upper(F.substring("event_type", 1, 2)).alias("carrier"),
        F.concat(F.lit("E"), _two_digits(F.col("user_id") % 20)).alias("origin"),
        F.concat(F.lit("E"), _two_digits(F.col("event_id") % 20)).alias("dest"),
        F.col("ts").cast("date").alias("flight_date"),
        F.lpad(minute.cast("string"), 4, "0").alias("dep_time"),
        F.when(arrived, late_out).cast("double").alias("dep_delay"),
        F.when(arrived, late_out - 5 + F.col("event_id") % 11).cast("double").alias("arr_delay"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream, one file or many.

    A file source takes a folder or a pattern, so the table's name is given as one.
    """
    schema = table(spark, sf_dir, "events").schema
    return file_stream(spark, f"{sf_dir}/event[s].parquet", schema)
