"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "flightrank", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    Where that is unset, a folder below the warehouse. On a cluster a warehouse on
    the driver's own disk is refused, as executors would each write to theirs.
    Intermediate tables have to stay until the results that read them were used,
    so ``clear_shared`` deletes them, not the queries.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    one_machine = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if not one_machine and re.match(r"file:|/", warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse.rstrip('/')}/flightrank-intermediate"


_made: list[str] = []


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``shared_base``."""
    path = f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_shared(spark: SparkSession) -> int:
    """Delete the intermediate folders this process made; for after the results were used."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    deleted = 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        deleted += bool(path.getFileSystem(conf).delete(path, True))
    return deleted


def written_once(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a reduced table that a later plan reads several times: the work before
    it runs once, and a lost executor costs a re-read instead of a re-run.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
