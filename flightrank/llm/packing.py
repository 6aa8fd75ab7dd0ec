"""Packing into optimal length buckets.

Documents are counted in tokens, an end token included; one longer than
``MAX_LENGTH`` is cut into parts of that length, so nothing is dropped and the
global histogram of lengths has at most ``MAX_LENGTH`` rows. Dynamic programming
over the histogram chooses the bucket boundaries of least padding. Within a
bucket, sequences form batches of as many as the token budget holds at the
bucket's length.

Places within a bucket come from counts per cell and prefix sums, so a bucket
with a large share of all rows is spread over many tasks.

Defined results: null and empty texts have the end token alone; rows that repeat
are each packed; an empty table gives an empty result; columns besides
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightrank.llm.text import numbered
from flightrank.session import written_once

MAX_LENGTH = 8192
BUCKETS = 16
TOKEN_BUDGET = 65_536
CELL_ROWS = 100_000


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding in all.

    ``lengths`` ascend. The cost of a bucket is its length times its sequences
    (less their tokens, which no choice changes). The best last cut moves up
    with the end of the range, so each round halves the range around the middle.
    """
    n = len(lengths)
    if n == 0:
        return []
    upper = np.asarray(lengths, np.float64)
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    best = np.concatenate([[0.0], np.full(n, np.inf)])
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            middle = (low + high) // 2
            at = np.arange(first, min(last, middle - 1) + 1)
            cost = best[at] + upper[middle - 1] * (rows[middle] - rows[at])
            k = int(np.argmin(cost))
            new[middle], cut[middle] = cost[k], at[k]
            todo += [(low, middle - 1, first, int(at[k])), (middle + 1, high, int(at[k]), last)]
        best = new
        cuts.append(cut)
    chosen, end = [], n
    for cut in reversed(cuts):
        if end == 0:
            break
        chosen.append(int(lengths[end - 1]))
        end = int(cut[end])
    return chosen[::-1]


def pack(
    docs: DataFrame,
    count_tokens: Callable[[DataFrame], DataFrame],
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """A row per sequence: ``doc_id part start length bucket bucket_length batch_id slot``.

    ``count_tokens`` gives ``doc_id, n_tokens`` per row of ``docs``.
    """
    if max_length > token_budget:
        raise ValueError("a batch must hold one sequence of max_length")
    counted = count_tokens(docs).select("doc_id", (F.col("n_tokens") + 1).alias("total"))
    # Written once, so that a row keeps its number.
    counted = written_once(counted.withColumn("row", F.monotonically_increasing_id()), "lengths")
    starts = F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(max_length).cast("long"))
    parts = counted.select("doc_id", "row", "total", F.posexplode(starts).alias("part", "start"))
    parts = parts.withColumn(
        "length", F.least(F.col("total") - F.col("start"), F.lit(max_length)).cast("int")
    )
    # At most max_length rows.
    histogram = sorted(tuple(r) for r in parts.groupBy("length").count().collect())
    lengths, counts = [r[0] for r in histogram], [r[1] for r in histogram]
    bounds = best_boundaries(lengths, counts, buckets)
    rows = [0] * len(bounds)
    for length, count in histogram:
        rows[sum(b < length for b in bounds)] += count
    capacity = [token_budget // b for b in bounds]
    batches = [math.ceil(n / c) for n, c in zip(rows, capacity)]
    first = [sum(batches[:i]) for i in range(len(bounds))]
    cells = [math.ceil(n / cell_rows) for n in rows]

    def per_bucket(values: list[int], kind: str):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values or [1]]), F.col("bucket") + 1)

    bucket = sum(((F.col("length") > b).cast("int") for b in bounds[:-1]), F.lit(0))
    placed = parts.withColumn("bucket", bucket).withColumn(
        "cell", F.pmod(F.xxhash64("row", "part"), per_bucket(cells, "long"))
    )
    placed = numbered(placed, "bucket", "cell", ["row", "part"], "place")
    return placed.select(
        "doc_id",
        "part",
        "start",
        "length",
        "bucket",
        per_bucket(bounds, "int").alias("bucket_length"),
        (per_bucket(first, "long") + F.floor(F.col("place") / per_bucket(capacity, "long"))).alias("batch_id"),
        (F.col("place") % per_bucket(capacity, "long")).cast("int").alias("slot"),
    )
