"""Exact top-k search by inner product, pruned with multi-resolution segment statistics.

A vector is cut into 1, 4 and then 16 segments. Of each segment its mean and its
deviation from the mean give a lower bound on the distance of two vectors, and
so an upper bound on their inner product, which is half of what both squared
lengths exceed the squared distance by. Bounds are taken coarse to fine, each
only for the rows that are left, and the product itself for what survives. A
candidate goes only if its bound is below a query's k-th best product so far, so
the result is exact.

Queries and candidates are packed into blocks of rows. A cell is one block of
queries with a bounded number of candidate blocks, so no task or driver holds a
whole side, and a cell sends k rows per query.

Defined results: components are rounded down after multiplying by ``SCALE``;
vectors that are null or hold null or a component that is not finite, and rows
without an id, take no part; vectors of different length are not compared; rows
with the query's own id are no candidates for it; other rows that repeat are
candidates each; a query row that repeats is answered once; products are exact
while they fit a long; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightrank.llm.shipping import ship
from flightrank.session import written_once

SCALE = 256
K = 5
SEGMENTS = (1, 4, 16)
QUERY_ROWS = 1024
BLOCK_ROWS = 2048
CELL_BLOCKS = 4
PAIRS = 1 << 16  # pairs whose products are computed at once
DENSE = 0.05  # share of survivors from which a block's products are one matrix product
_LARGEST = float(2**62)


def _whole(column: pa.ListArray, ids: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and whole-number vectors of the rows that take part, by length."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (
        np.asarray(column.is_valid())
        & np.asarray(ids.is_valid())
        & (bad[offsets[1:]] == bad[offsets[:-1]])
    )
    lengths = offsets[1:] - offsets[:-1]
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for length in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == length))
        taken = values[offsets[rows][:, None] + np.arange(length)[None, :]]
        scaled = np.clip(np.floor(SCALE * taken), -_LARGEST, _LARGEST)
        yield numbers[rows], scaled.astype(np.int64)


def _blocks(rows: int):
    """Rows to blocks: ``length, part, piece`` name it, ``ids`` and ``values`` are its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        for batch in batches:
            for ids, values in _whole(batch.column(1), batch.column(0)):
                for at in range(0, len(ids), rows):
                    own = (
                        [values.shape[1]],
                        [part],
                        [piece],
                        [ids[at : at + rows].tobytes()],
                        [values[at : at + rows].tobytes()],
                    )
                    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    piece += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(own, kinds)],
                        ["length", "part", "piece", "ids", "values"],
                    )

    return run


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of a vector's segments, scaled so that the product of two
    rows bounds the product of their vectors from above."""
    length = vectors.shape[1]
    cuts = np.linspace(0, length, min(segments, max(1, length)) + 1).astype(int)
    means, deviations = [], []
    for a, b in zip(cuts, cuts[1:]):
        part = vectors[:, a:b].astype(np.float64)
        mean = part.mean(1) if b > a else np.zeros(len(part))
        means.append(mean * math.sqrt(b - a))
        deviations.append(np.sqrt(((part - mean[:, None]) ** 2).sum(1)))
    return np.stack([*means, *deviations], 1)


class _Best:
    """The best k candidates of each query so far; ties go to the smaller id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = query_ids, queries, k
        self.statistics = [segment_statistics(queries, s) for s in SEGMENTS]
        self.row = np.empty(0, np.int64)
        self.found = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)

    def least(self) -> np.ndarray:
        """The product that a candidate must reach, per query."""
        least = np.full(len(self.ids), -np.inf)
        counts = np.bincount(self.row, minlength=len(self.ids))
        # Rows are sorted by query, then falling product: the last of a full query is its k-th.
        last = np.cumsum(counts) - 1
        full = counts >= self.k
        least[full] = self.score[last[full]]
        return least

    def products(self, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        """All products of some queries with some candidates, exactly."""
        mine = self.queries[rows]
        largest = [float(np.abs(x).max(initial=0)) for x in (mine, values)]
        if largest[0] * largest[1] * mine.shape[1] < 2**53:  # whole numbers of this size are exact
            return (mine.astype(np.float64) @ values.T.astype(np.float64)).astype(np.int64)
        return mine @ values.T

    def take(self, row: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        """Keep the best of these pairs and of those kept before."""
        self.row = np.concatenate([self.row, row])
        self.found = np.concatenate([self.found, found])
        self.score = np.concatenate([self.score, score])
        order = np.lexsort((self.found, -self.score, self.row))
        sorted_rows = self.row[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows)
        keep = order[place < self.k]
        self.row, self.found, self.score = self.row[keep], self.found[keep], self.score[keep]

    def search(self, ids: np.ndarray, values: np.ndarray) -> None:
        """Search one block of candidates."""
        finest = segment_statistics(values, SEGMENTS[-1])
        levels = [segment_statistics(values, s) for s in SEGMENTS[:-1]] + [finest]
        left = self.ids[:, None] != ids[None, :]
        if not len(self.row) and len(ids) > self.k:
            # The pairs of highest bound first, so that there is something to prune with.
            bound = np.where(left, self.statistics[-1] @ finest.T, -np.inf)
            likely = np.zeros(left.shape, bool)
            best = np.argpartition(-bound, self.k, axis=1)[:, : self.k]
            likely[np.arange(len(self.ids))[:, None], best] = True
            row, column = np.nonzero(likely & left)
            self.take(row, ids[column], np.einsum("ij,ij->i", self.queries[row], values[column]))
            left &= ~likely
        least = self.least()
        rows, columns = np.arange(len(self.ids)), np.arange(len(ids))
        for mine, theirs in zip(self.statistics, levels):
            a, b = mine[rows], theirs[columns]
            slack = 1e-6 + 1e-9 * np.linalg.norm(a, axis=1).max() * np.linalg.norm(b, axis=1).max()
            left &= a @ b.T >= (least[rows] - slack)[:, None]
            some_rows, some_columns = left.any(1), left.any(0)
            rows, columns = rows[some_rows], columns[some_columns]
            left = left[some_rows][:, some_columns]
            if not left.size:
                return
        if left.mean() > DENSE:
            score = self.products(rows, values[columns])
            r, c = np.nonzero(left & (score >= least[rows][:, None]))
            self.take(rows[r], ids[columns[c]], score[r, c])
            return
        r, c = np.nonzero(left)
        for at in range(0, len(r), PAIRS):
            row, column = rows[r[at : at + PAIRS]], columns[c[at : at + PAIRS]]
            score = np.einsum("ij,ij->i", self.queries[row], values[column])
            good = score >= least[row]
            self.take(row[good], ids[column[good]], score[good])


def _cell(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], []]
        for q in queries.to_pylist():
            length = q["length"]
            ids = np.frombuffer(q["ids"], np.int64)
            vectors = np.frombuffer(q["values"], np.int64).reshape(len(ids), length)
            best = _Best(ids, vectors, k)
            for c in range(candidates.num_rows):
                own = np.frombuffer(candidates["ids"][c].as_py(), np.int64)
                values = np.frombuffer(candidates["values"][c].as_py(), np.int64)
                best.search(own, values.reshape(len(own), length))
            rows = (
                np.full(len(best.row), length, np.int32),
                np.full(len(best.row), q["number"], np.int64),
                best.row,
                ids[best.row],
                best.found,
                best.score,
            )
            for held, new in zip(out, rows):
                held.append(new)
        columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
        names = ["length", "number", "row", "query_id", "vec_id", "score"]
        kinds = [pa.int32(), *[pa.int64()] * 5]
        return pa.table({n: pa.array(x, t) for n, x, t in zip(names, columns, kinds)})

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = K) -> DataFrame:
    """The ``k`` best of ``vec_id, embedding`` for each row that ``queries`` is true for:
    ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    kind = "length int, part long, piece long, ids binary, values binary"

    asked = rows.filter(queries & F.col("embedding").isNotNull()).distinct()
    parts = max(1, math.ceil(rows.filter(queries).count() / QUERY_ROWS))
    packed = written_once(asked.repartition(parts).mapInArrow(_blocks(QUERY_ROWS), kind), "query-blocks")
    order = Window.partitionBy("length").orderBy("part", "piece")
    names = packed.select("length", "part", "piece").withColumn("number", F.row_number().over(order) - 1)
    numbered = packed.join(names, ["length", "part", "piece"]).select("length", "number", "ids", "values")
    per_length = names.groupBy("length").agg(F.max("number").alias("last"))

    blocks = rows.mapInArrow(_blocks(BLOCK_ROWS), kind)
    salts = max(1, math.ceil(rows.count() / (BLOCK_ROWS * CELL_BLOCKS)))
    salt = F.pmod(F.col("part") * 31 + F.col("piece"), F.lit(salts)).alias("salt")
    spread = blocks.join(per_length, "length").select(
        "length", salt, "ids", "values", F.explode(F.sequence(F.lit(0), "last")).alias("number")
    )
    copies = numbered.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    cell = ["length", "number", "salt"]
    found = (
        copies.groupBy(*cell)
        .cogroup(spread.groupBy(*cell))
        .applyInArrow(
            _cell(k), "length int, number long, row long, query_id long, vec_id long, score long"
        )
    )
    best = Window.partitionBy("length", "number", "row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
