"""A keyed store of stream results: plain partitioned Parquet, one folder per micro-batch.

The rows of a store lie in parts: buckets of the key's hash, or the values of one
key column, such as the day of a flight. A micro-batch reads only the parts its
own keys fall into, merges them, and writes those parts whole into its own folder
``step=<batch>``; parts that it does not touch stay where an earlier batch wrote
them. The table is the newest folder of each part. Spark marks a folder as
complete when all of it is written, so a reader sees whole batches only, and a
batch that runs again replaces its own folder and starts from those before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightrank.operators.ranking import latest_per_key

Transform = Callable[[DataFrame], DataFrame]

BUCKETS = 8
STEP, PART = "step", "store_part"
NO_VALUE = "none"  # the part of rows whose column ``by`` is null


def part_of(keys: Sequence[str], by: str | None = None, buckets: int = BUCKETS) -> Column:
    """The part of a row: its value of the key column ``by``, or its key's bucket."""
    if by is None:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")
    return F.coalesce(F.col(by).cast("string"), F.lit(NO_VALUE))


def upsert_results(
    path: str,
    keys: Sequence[str],
    transform: Transform | None = None,
    by: str | None = None,
    buckets: int = BUCKETS,
    merge: Transform | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that keeps the latest result of each key.

    ``merge``: another way to make one row per key of those held and those that
    come, both with the ``batch_id`` they are from, such as adding counts up.
    ``by``: a date or whole number among ``keys`` whose values are the parts, for keys that
    grow with time. Otherwise there are ``buckets`` parts, a number that has to stay for
    the life of a store and is to be chosen so that a part fits a few tasks. A store
    that another run has filled is refused: results of two runs must not mix.
    """
    if by is not None and by not in keys:
        raise ValueError(f"{by} is no key: rows of one key would lie in several parts")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = max(steps(spark, path), default=None)
        if last not in (None, batch_id - 1, batch_id):
            raise ValueError(f"{path} ends with batch {last} of another run; batch {batch_id} needs a new folder")
        held = parts(spark, path, before=batch_id)
        _delete_replaced(spark, path, held, batch_id)
        result = transform(batch) if transform else batch
        result = result.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if by is not None and dict(result.dtypes)[by] not in ("date", "int", "bigint"):
            raise ValueError(f"{by} is neither a date nor a whole number")
        if last is None:
            # An empty table that tells the columns of a store without rows.
            result.limit(0).write.mode("overwrite").parquet(f"{path}/columns")
        part = part_of(keys, by, buckets)
        result = result.persist()
        try:
            merged = result
            if held:
                # Bounded by the number of parts.
                touched = {r[0] for r in result.select(part.alias(PART)).distinct().collect()}
                merged = result.unionByName(_read(spark, path, {p: s for p, s in held.items() if p in touched}))
            merged = merge(merged) if merge else latest_per_key(merged, list(keys), ["batch_id"])
            placed = merged.withColumn(PART, part).hint("rebalance", PART)
            placed.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/{STEP}={batch_id}")
        finally:
            result.unpersist()

    return write


def read_latest(spark: SparkSession, path: str, of: Iterable[str] | None = None) -> DataFrame:
    """The table that ``upsert_results`` keeps, or those parts ``of`` it: one row per key, with
    the batch that wrote it last."""
    held = parts(spark, path)
    if not steps(spark, path):
        raise ValueError(f"{path} holds no results")
    wanted = held if of is None else {p: held[p] for p in of if p in held}
    return _read(spark, path, wanted)


def _read(spark: SparkSession, path: str, held: dict[str, int]) -> DataFrame:
    empty = spark.read.parquet(f"{path}/columns")
    if not held:
        return empty
    folders = [f"{path}/{STEP}={step}/{PART}={part}" for part, step in sorted(held.items())]
    return spark.read.schema(empty.schema).parquet(*folders)


def drop_parts(spark: SparkSession, path: str, unwanted: Callable[[str], bool]) -> None:
    """Delete the parts whose names are ``unwanted``, in every folder."""
    for step, part, place in _folders(spark, path):
        if unwanted(part):
            _files(spark, path).delete(place, True)


def steps(spark: SparkSession, path: str) -> list[int]:
    """The batches whose folders are complete."""
    files = _files(spark, path)
    marks = files.globStatus(_place(spark, f"{path}/{STEP}=*/_SUCCESS")) or []
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)


def parts(spark: SparkSession, path: str, before: int | None = None) -> dict[str, int]:
    """The newest complete folder of each part, as it was before a batch if that is given."""
    complete = set(steps(spark, path))
    newest: dict[str, int] = {}
    for step, part, _ in _folders(spark, path):
        if step in complete and (before is None or step < before):
            newest[part] = max(step, newest.get(part, step))
    return newest


def _folders(spark: SparkSession, path: str) -> list[tuple]:
    """Step, part and place of every folder of a part."""
    found = _files(spark, path).globStatus(_place(spark, f"{path}/{STEP}=*/{PART}=*")) or []
    places = [f.getPath() for f in found]
    return [(int(p.getParent().getName().split("=")[1]), p.getName().split("=", 1)[1], p) for p in places]


def _delete_replaced(spark: SparkSession, path: str, held: dict[str, int], batch_id: int) -> None:
    """Delete what batches before ``batch_id`` replaced: none of those can run again."""
    files = _files(spark, path)
    kept = set()
    for step, part, place in _folders(spark, path):
        if step >= batch_id or held.get(part) == step:
            kept.add(step)
        else:
            files.delete(place, True)
    for step in steps(spark, path):
        if step < batch_id - 1 and step not in kept:
            files.delete(_place(spark, f"{path}/{STEP}={step}"), True)


def _place(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _place(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
