"""Exact centroid clustering (Lloyd's rounds in whole numbers), filtered by rotated coordinates.

Vectors are rotated onto the principal axes of all of them. Of each vector the
``LEADING`` first rotated coordinates are stored, and the length of what is
left. For a centroid taken the same way, the squared distance of the leading
coordinates plus the squared difference of the lengths left is never more than
the squared distance. So per vector the centroid of the least bound is measured
first, in whole numbers, and then those whose bound does not rule them out.
Rounding of the bounds is covered by a margin, and the whole numbers decide, so
the result is exact and the rotation only affects speed.

A round maps the stored blocks and sends one sum per cluster and component from
each task; the centroids, at most ``K`` vectors, are all that the driver holds.
No vector is shuffled, so clusters of any size cost the same.

Defined results: vectors that are null, are not of ``LENGTH`` components, or hold
null or a component that is not finite take no part; components are rounded down
after multiplying by ``SCALE``; rows that repeat count each, a null id too, but a
null id is never a first centroid; with fewer vectors than ``K`` there are fewer
centroids; rows whose ids and hashes are the same start as centroids in the
order of their components; ties go to the smaller number; a centroid without
vectors stays; a component beyond ``LARGEST`` after scaling, whose distances
would not fit a long, fails the job, as an overflow does in Spark; other columns
of the input are not used; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightrank.llm.shipping import ship
from flightrank.session import written_once

SCALE = 1024
LENGTH = 64
K = 8
ROUNDS = 10
LEADING = 16
BLOCK_ROWS = 4096
LARGEST = 2**27  # 64 squared differences of this size fit a long
MARGIN = 1e-9  # share of the lengths involved by which rounding may lift a bound

BLOCK = "rows long, ids binary, known binary, whole binary, leading binary, rest binary"


def _whole(column: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their scaled vectors as whole numbers."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sound = (offsets[1:] - offsets[:-1] == length) & (bad[offsets[1:]] == bad[offsets[:-1]])
    rows = np.flatnonzero(np.asarray(column.is_valid()) & sound)
    scaled = np.floor(SCALE * values[offsets[rows][:, None] + np.arange(length)[None, :]])
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise OverflowError(f"a component is beyond {LARGEST // SCALE}: its distances do not fit a long")
    return rows, scaled.astype(np.int64)


def _vectors(length: int):
    """Rows to ``vec_id`` and the whole-number vector, of those that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole = _whole(batch.column(1), length)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1) * length, pa.int32()), pa.array(whole.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists], ["vec_id", "v"])

    return run


def _products(length: int):
    """Of a task's vectors their number, sums and sums of products: what a covariance needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length + 1, length + 1))
        for batch in batches:
            _, whole = _whole(batch.column(1), length)
            with_one = np.hstack([np.ones((len(whole), 1)), whole.astype(np.float64)])
            total += with_one.T @ with_one
        i, j = np.triu_indices(length + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "product"]
        )

    return run


def principal_axes(vectors: DataFrame, length: int = LENGTH, leading: int = LEADING) -> np.ndarray:
    """The axes of greatest variance over all vectors, one per column; ``length ** 2`` sums come
    to the driver."""
    sums = vectors.mapInArrow(_products(length), "i int, j int, product double")
    found = sums.groupBy("i", "j").agg(F.sum("product").alias("product")).collect()
    total = np.zeros((length + 1, length + 1))
    for r in found:
        total[r.i, r.j] = total[r.j, r.i] = r.product
    n = max(total[0, 0], 1.0)
    mean = total[0, 1:] / n
    _, axes = np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1][:, :leading])


def rotated(whole: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the length of what they leave of each vector."""
    exact = whole.astype(np.float64)
    leading = exact @ axes
    left = (exact**2).sum(1) - (leading**2).sum(1)
    return leading, np.sqrt(np.maximum(left, 0))


def _blocks(axes: np.ndarray, length: int):
    """Rows to stored blocks of whole vectors with their rotated form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), *[pa.binary()] * 5)
        names = [f.split()[0] for f in BLOCK.split(", ")]
        for batch in batches:
            rows, whole = _whole(batch.column(1), length)
            ids = batch.column(0).take(pa.array(rows))
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            known = np.asarray(ids.is_valid())
            leading, rest = rotated(whole, axes)
            for at in range(0, len(rows), BLOCK_ROWS):
                own = slice(at, at + BLOCK_ROWS)
                parts = [numbers[own], known[own], whole[own].astype(np.int32), leading[own], rest[own]]
                cells = [len(parts[0]), *[np.ascontiguousarray(p).tobytes() for p in parts]]
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names)

    return run


def bounds(
    leading: np.ndarray, rest: np.ndarray, centre_leading: np.ndarray, centre_rest: np.ndarray
) -> np.ndarray:
    """Lower bounds on the squared distances of all rows to all centroids."""
    squares = (leading**2).sum(1)[:, None] + (centre_leading**2).sum(1)[None, :]
    near = squares - 2 * leading @ centre_leading.T
    bound = np.maximum(near, 0) + (rest[:, None] - centre_rest[None, :]) ** 2
    reach = squares + (rest**2)[:, None] + (centre_rest**2)[None, :]
    return bound - MARGIN * reach - 1


def nearest(
    whole: np.ndarray, leading: np.ndarray, rest: np.ndarray, centres: np.ndarray, axes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number on a tie, and its squared distance."""
    bound = bounds(leading, rest, *rotated(centres, axes))
    first = bound.argmin(1)

    def measured(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return ((whole[rows] - centres[centre]) ** 2).sum(1)

    every = np.arange(len(whole))
    best, distance = first.copy(), measured(every, first)
    alive = bound <= distance[:, None]
    alive[every, first] = False
    for c in range(len(centres)):
        rows = np.flatnonzero(alive[:, c])
        d = measured(rows, np.full(len(rows), c))
        better = (d < distance[rows]) | ((d == distance[rows]) & (c < best[rows]))
        best[rows[better]], distance[rows[better]] = c, d[better]
    return best, distance


def _read(batches: Iterator[pa.RecordBatch], length: int, leading: int) -> Iterator[tuple]:
    """The arrays of stored blocks: ids, known, whole, leading, rest."""
    for batch in batches:
        for row in batch.to_pylist():
            yield (
                np.frombuffer(row["ids"], np.int64),
                np.frombuffer(row["known"], np.bool_),
                np.frombuffer(row["whole"], np.int32).reshape(-1, length).astype(np.int64),
                np.frombuffer(row["leading"], np.float64).reshape(-1, leading),
                np.frombuffer(row["rest"], np.float64),
            )


def _sums(centres: np.ndarray, axes: np.ndarray):
    """Of a task's vectors the sum of each component per cluster; component -1 counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, length = centres.shape
        total = np.zeros((k, length + 1), np.int64)
        for _, _, whole, leading, rest in _read(batches, length, axes.shape[1]):
            best, _ = nearest(whole, leading, rest, centres, axes)
            for c in np.unique(best):
                own = whole[best == c]
                total[c] += np.concatenate([[len(own)], own.sum(0)])
        cluster, component = np.divmod(np.arange(total.size), length + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(component - 1, pa.int32()), pa.array(total.ravel())],
            ["cluster", "component", "total"],
        )

    return run


def _assigned(centres: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, known, whole, leading, rest in _read(batches, centres.shape[1], axes.shape[1]):
            best, distance = nearest(whole, leading, rest, centres, axes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=~known), pa.array(best, pa.int32()), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return run


def first_centres(vectors: DataFrame, k: int, salt: str, length: int) -> np.ndarray:
    """The vectors whose salted ids have the smallest hashes."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    known = vectors.filter(F.col("vec_id").isNotNull()).mapInArrow(_vectors(length), "vec_id long, v array<long>")
    first = known.orderBy(order, "v").limit(k).collect()
    return np.array([r.v for r in first], np.int64).reshape(len(first), length)


def next_centres(blocks: DataFrame, centres: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """One round: every centroid becomes the mean of its vectors, rounded down."""
    sums = blocks.mapInArrow(_sums(centres, axes), "cluster int, component int, total long")
    whole = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    total = {(r.cluster, r.component): int(r.total) for r in sums.groupBy("cluster", "component").agg(whole).collect()}
    moved = centres.copy()
    for c in range(len(centres)):
        n = total.get((c, -1), 0)
        if n:
            moved[c] = [total[c, j] // n for j in range(centres.shape[1])]
    return moved


def digest(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centre.tolist())).encode()).hexdigest()


def cluster(
    embeddings: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    salt: str = "3",
    length: int = LENGTH,
    leading: int = LEADING,
) -> DataFrame:
    """``vec_id cluster distance cluster_inertia inertia centroid_sha256``, one row per vector
    that takes part."""
    spark = embeddings.sparkSession
    ship(spark)
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    centres = first_centres(vectors, k, salt, length)
    if not len(centres):
        return spark.createDataFrame([], RESULT)
    axes = principal_axes(vectors, length, min(leading, length))
    blocks = written_once(vectors.mapInArrow(_blocks(axes, length), BLOCK), "vector-blocks")
    for _ in range(rounds):
        centres = next_centres(blocks, centres, axes)
    assigned = written_once(
        blocks.mapInArrow(_assigned(centres, axes), "vec_id long, cluster int, distance long"), "assigned"
    )
    # At most ``k`` rows: each centroid's digest and the distances summed over its vectors.
    digests = spark.createDataFrame([(c, digest(v)) for c, v in enumerate(centres)], "cluster int, centroid_sha256 string")
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = assigned.agg(F.sum("distance")).scalar()
    per_cluster = inertia.join(digests, "cluster").withColumn("inertia", total)
    return assigned.join(F.broadcast(per_cluster), "cluster").select(*RESULT_COLUMNS)


RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)
RESULT_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]
