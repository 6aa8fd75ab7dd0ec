import hashlib

import numpy as np
import pytest

from flightrank.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 9) for i, v in rows], SCHEMA).repartition(3)


def slow(rows, k=8, rounds=10, length=64):
    """Plain rounds in Python's whole numbers."""
    kept = [
        (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if v is not None and len(v) == length and all(x is not None and np.isfinite(np.float32(x)) for x in v)
    ]
    known = [(hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centres = [v for _, v in sorted(known)[:k]]
    if not centres:
        return []

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centres)):
            mine = [v for (_, v), (a, _) in zip(kept, own) if a == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    total = sum(d for _, d in own)
    return sorted(
        (
            (i, c, d, sum(e for a, e in own if a == c), total,
             hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
            for (i, _), (c, d) in zip(kept, own)
        ),
        key=repr,
    )


def found(spark, rows, **how):
    result = centroids.cluster(frame(spark, rows), **how)
    assert result.columns == centroids.RESULT_COLUMNS
    return sorted(map(tuple, result.collect()), key=repr)


@pytest.mark.parametrize("clusters", [1, 6])
def test_equals_brute_force(spark, monkeypatch, clusters):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(clusters)
    middles = rng.normal(size=(clusters, 64))
    rows = [(i, (middles[i % clusters] + 0.3 * rng.normal(size=64)).tolist()) for i in range(300)]
    assert found(spark, rows) == slow(rows)


def test_ties_repeats_nulls_and_vectors_that_take_no_part(spark):
    v, w = [0.5] * 64, [-0.25] * 64
    rows = [(i, v if i % 2 else w) for i in range(12)] + [(3, v)] * 5 + [(None, w), (None, None), (20, None)]
    rows += [(21, v[:63]), (22, [*v, 1.0]), (23, [None, *v[1:]]), (24, [float("nan"), *v[1:]])]
    rows += [(25, [float("inf"), *v[1:]]), (26, []), (27, [1000.0, -1000.0] * 32)]
    assert found(spark, rows) == slow(rows)


def test_fewer_vectors_than_centroids_and_no_rows(spark):
    rows = [(i, np.linspace(i, i + 1, 64).tolist()) for i in range(3)]
    assert found(spark, rows) == slow(rows)
    assert found(spark, [(None, rows[0][1])]) == []
    assert found(spark, rows[:0]) == []


def test_a_component_whose_distances_do_not_fit_fails(spark):
    with pytest.raises(Exception, match="do not fit"):
        found(spark, [(1, [2.0e5] * 64), (2, [0.0] * 64)])


def test_bounds_are_never_above_the_distance_and_rule_most_out():
    rng = np.random.default_rng(1)
    middles = rng.integers(-3000, 3000, (8, 64))
    whole = middles[rng.integers(0, 8, 2000)] + rng.integers(-200, 200, (2000, 64))
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0][:, :16]
    bound = centroids.bounds(*centroids.rotated(whole, axes), *centroids.rotated(middles, axes))
    exact = ((whole[:, None, :] - middles[None, :, :]) ** 2).sum(2)
    assert (bound <= exact).all()
    assert (bound > exact.min(1)[:, None]).sum() > 0.9 * 7 * len(whole)


def test_only_survivors_are_measured(monkeypatch):
    rng = np.random.default_rng(2)
    middles = rng.integers(-3000, 3000, (8, 64))
    whole = middles[np.arange(800) % 8] + rng.integers(-50, 50, (800, 64))
    axes = np.linalg.eigh(np.cov(whole.T))[1][:, ::-1][:, :16]
    best, distance = centroids.nearest(whole, *centroids.rotated(whole, axes), middles, axes)
    assert (best == np.arange(800) % 8).all()
    assert (distance == ((whole - middles[best]) ** 2).sum(1)).all()
