import numpy as np
import pytest
from pyspark.sql import functions as F

from flightrank.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 9) for i, v in rows], SCHEMA).repartition(3)


def slow(rows, every, k):
    whole = [
        (i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    asked = {(i, tuple(v)) for i, v in whole if i % every == 0}
    out = []
    for q, v in asked:
        scored = sorted((-int(np.dot(v, c)), i) for i, c in whole if i != q and len(c) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, every=5, k=5):
    result = topk.top_k(frame(spark, rows), F.col("vec_id") % every == 0, k)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, result.collect()))


@pytest.mark.parametrize("clusters", [1, 12])
def test_equals_brute_force(spark, monkeypatch, clusters):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    rng = np.random.default_rng(clusters)
    centres = rng.normal(size=(clusters, 40))
    rows = [(i, (centres[i % clusters] + 0.05 * rng.normal(size=40)).tolist()) for i in range(300)]
    assert found(spark, rows) == slow(rows, 5, 5)


def test_ties_repeats_and_vectors_that_take_no_part(spark):
    v = [0.5, -0.25, 1.0]
    rows = [(i, v) for i in range(9)] + [(3, v), (5, v), (None, v), (10, None), (15, [1.0, None, 2.0])]
    rows += [(20, [1.0, float("nan"), 0.0]), (25, [float("inf"), 0.0, 0.0]), (30, []), (31, []), (35, [1.0] * 5)]
    rows += [(36, [0.001] * 5), (40, [-0.001] * 5), (45, [1e9, 1.0, 1.0])]
    assert found(spark, rows) == slow(rows, 5, 5)


def test_fewer_candidates_than_k_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 4.0])]
    assert found(spark, rows) == [(0, 1, 1, int(np.dot([256, 512], [768, 1024])))]
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, rows[:0]) == []


@pytest.mark.parametrize("length", [1, 3, 16, 64, 70])
@pytest.mark.parametrize("segments", topk.SEGMENTS)
def test_bounds_are_never_below_the_product(length, segments):
    rng = np.random.default_rng(length)
    a, b = rng.integers(-500, 500, (20, length)), rng.integers(-500, 500, (30, length))
    bound = topk.segment_statistics(a, segments) @ topk.segment_statistics(b, segments).T
    assert (bound >= a @ b.T - 1e-6).all()


def test_coarse_bounds_prune(monkeypatch):
    rng = np.random.default_rng(0)
    near = rng.integers(200, 260, (40, 64))
    far = rng.integers(-260, -200, (400, 64))
    best = topk._Best(np.arange(4), near[:4], 5)
    best.search(np.arange(100, 140), near)
    computed = []
    monkeypatch.setattr(topk._Best, "products", lambda *a: computed.append(a))
    best.search(np.arange(1000, 1400), far)
    assert not computed and set(best.found) <= set(range(100, 140))


def test_products_beyond_exact_floats_are_whole_numbers():
    big = np.array([[2**30 + 1, 3]], np.int64)
    best = topk._Best(np.array([0]), big, 1)
    assert best.products(np.array([0]), big).tolist() == [[(2**30 + 1) ** 2 + 9]]
