"""Does a sample follow a power law? Empirical CCDF, power-law and lognormal fits.

The data stay in Spark. Only sums over the tail, one row of them, reach the
small numeric helpers at the end. Values are distinct positive finite numbers;
others are ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from flightrank.operators.cumulative import sums_from_top
from flightrank.session import written_once

# Workers get the helpers below by value, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def value_counts(samples: DataFrame, column: str) -> DataFrame:
    """Distinct positive values ``x`` and how many samples have each, ``n``."""
    value = F.col(column).cast("double")
    return (
        samples.select(value.alias("x"))
        .filter((F.col("x") > 0) & (F.col("x") < float("inf")))
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ccdf(samples: DataFrame, column: str) -> DataFrame:
    """P(X >= x) for every distinct value x."""
    values = written_once(value_counts(samples, column), "value-counts")
    share = F.col("from_n") / F.col("total_n").cast("double")
    return sums_from_top(values, "x", ["n"]).select("x", "n", share.alias("p_ge"))


def ln_ratio(x: Column, reference: Column) -> Column:
    """ln(x / reference), exact for neighbours whose logarithms are the same number."""
    near = F.abs(x - reference) < reference / 2
    return F.when(near, F.log1p((x - reference) / reference)).otherwise(F.ln(x / reference))


def powerlaw_alpha(samples: DataFrame, column: str, xmin: float | None = None) -> DataFrame:
    """Exponent of the continuous power law above ``xmin``, by default the least value.

    NULL if no value is above ``xmin``: equal values have no exponent.
    """
    values = value_counts(samples, column)
    if xmin is not None:
        values = values.filter(F.col("x") >= xmin)
    low = values.agg(F.min("x")).scalar() if xmin is None else F.lit(float(xmin))
    excess = F.col("n") * ln_ratio(F.col("x"), low)
    sums = values.agg(
        F.min("x").alias("least"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_tail"),
        F.sum(excess).alias("excess"),
    )
    return sums.select(
        (F.col("least") if xmin is None else F.lit(float(xmin))).alias("xmin"),
        "n_tail",
        (1 + F.try_divide(F.col("n_tail"), F.col("excess"))).alias("alpha"),
    )


FIT = "xmin double, n_tail long, alpha double, d double"
CANDIDATE = "m double, m_ln double, n_tail long, m_below long, alpha double"
# Pairs of a candidate and an end of a cell: more of them are not compared unless the
# candidates were thinned out first.
_FEW_PAIRS = 1 << 26


def powerlaw_fit(
    samples: DataFrame, column: str, cells: int | None = None, spread: int = 16,
    few_pairs: int = _FEW_PAIRS,
) -> DataFrame:
    """The power law that fits best: one row ``xmin, n_tail, alpha, d``.

    Every distinct value but the largest is tried as ``xmin``; the one with the
    least Kolmogorov-Smirnov distance ``d`` wins, the smaller one on a tie.
    Without two distinct values there is no fit and no row.

    The search is exact and does not compare every value with every other. The
    values are cut into cells, about as many as the square root of their number.
    Within a cell the empirical curve keeps within two offsets of its chord, one
    above and one below, and the law, which is concave in ln x, within its
    curvature of its own. Two chords are farthest apart at an end. So the ends of
    a cell and those few numbers bound the distance anywhere inside it, up and
    down. A candidate whose lower bound is above the upper bound of another
    cannot win; of the others only those cells are opened whose bound is above the
    distance that the ends already have. The offsets of a cell shrink faster than
    the distances do, so few candidates and cells are left.

    Where candidates and cells are too many to meet (``few_pairs``), every candidate
    is first held against a few ends in its tail. One whose distance there is above
    the whole distance of another cannot win either; the rest is held against more
    and more ends. So the work grows about as the number of values.
    """
    values = written_once(value_counts(samples, column), "value-counts")
    return _best_fit(values, cells, spread, few_pairs)


def _best_fit(
    values: DataFrame, cells: int | None = None, spread: int = 16, few_pairs: int = _FEW_PAIRS
) -> DataFrame:
    spark = values.sparkSession
    whole = values.agg(
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("samples"),
        F.min("x").alias("least"), F.max("x").alias("largest"),
    ).first()
    if whole["values"] < 2:
        return spark.createDataFrame([], FIT)
    cells = cells or max(32, math.isqrt(whole["values"]))
    points = _points(values, whole, cells)
    grid = _grid(points)
    # Little data but much work on it: a fixed number of tasks, which Spark
    # does not merge by size.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = _candidates(points, whole["largest"])
    some = _thinned(some, whole["values"], points, grid, tasks, spread, few_pairs)
    bounded = written_once(_between(some, grid, tasks), "powerlaw-bounds")
    reach = bounded.agg(F.min("high")).first()[0]
    if reach is None:
        return spark.createDataFrame([], FIT)
    alive = bounded.filter(F.col("low") <= reach).drop("high")
    return _measured(alive, points, grid, tasks, spread).orderBy("d", "xmin").limit(1)


def _thinned(
    some: DataFrame, left: int, points: DataFrame, grid: dict[str, np.ndarray], tasks: int,
    spread: int, few_pairs: int,
) -> DataFrame:
    """Candidates without those whose distance at some ends is above another's whole distance.

    The others come from every size of tail, as small tails lie far off by chance alone
    and a few ends tell little of them: of each octave the one that lies nearest so far.
    """
    ends, looked_at, reach = 2 * len(grid["cell"]), 32, float("inf")
    while looked_at < ends and left * ends > few_pairs:
        seen = written_once(
            some.repartition(tasks, "m").mapInArrow(
                _nearest(grid, looked_at), f"{CANDIDATE}, low double"
            ),
            "powerlaw-low",
        )
        octave = F.floor(F.log2("n_tail")).alias("octave")
        one = F.min_by(F.struct(*seen.drop("low").columns), "low")
        others = seen.groupBy(octave).agg(one.alias("one")).select("one.*")
        others = written_once(_between(others, grid, tasks).drop("high"), "powerlaw-others")
        least = _measured(others, points, grid, tasks, spread).agg(F.min("d")).first()[0]
        if least is None:
            return seen.drop("low")
        reach = min(reach, least + _ROUNDING)
        alive = seen.filter(F.col("low") <= reach)
        some, left, looked_at = alive.drop("low"), alive.count(), 16 * looked_at
    return some


def _between(some: DataFrame, grid: dict[str, np.ndarray], tasks: int) -> DataFrame:
    return some.repartition(tasks, "m").mapInArrow(
        _bounded(grid), f"{CANDIDATE}, low double, high double"
    )


def _points(values: DataFrame, whole: Row, cells: int) -> DataFrame:
    """Every value with the sums from it upwards, the samples below it, and its cell.

    Cells hold like many values, like many samples, as a few values may hold most of
    them, and are alike wide in ln x, as the last values may lie far apart. None holds
    more than a part of the values from it upwards, as small tails would lie within
    one. There are at most three times ``cells`` that have values, and eight for each
    doubling of the values; they rise with the values.
    """
    # Logarithms relative to the largest value: the sums over short tails are then small,
    # and their differences keep their digits.
    logs = values.withColumn("ln", ln_ratio(F.col("x"), F.lit(whole["largest"])))
    logs = logs.withColumns({"n_ln": F.col("n") * F.col("ln"), "one": F.lit(1).cast("bigint")})
    summed = sums_from_top(logs, "x", ["n", "n_ln", "one"])
    below = F.lit(whole["samples"]) - F.col("from_n")
    place = F.floor((F.lit(whole["values"]) - F.col("from_one")) * cells / F.lit(whole["values"]))
    share = F.floor(below * cells / F.lit(whole["samples"]))
    least = F.lit(whole["least"])
    width = F.floor(cells * (1 - F.col("ln") / ln_ratio(least, F.lit(whole["largest"]))))
    rank = F.floor(8 * F.log2(F.lit(whole["values"]) / F.col("from_one")))
    cell = place + (cells + 1) * (share + (cells + 1) * (width + (cells + 1) * rank))
    return written_once(
        summed.select(
            "x", "ln", "from_n", "from_n_ln", below.alias("below"), cell.cast("long").alias("cell")
        ),
        "value-sums",
    )


def _grid(points: DataFrame) -> dict[str, np.ndarray]:
    """The ends of every cell and how far its points lie off the chord between them.

    One row per cell comes to the driver: some times the square root of the values.
    """
    ends = points.groupBy("cell").agg(
        F.min("ln").alias("lo_ln"), F.max("ln").alias("hi_ln"),
        F.min("below").alias("lo_below"), F.max("below").alias("hi_below"),
    )
    slope = F.coalesce(
        F.try_divide(F.col("hi_below") - F.col("lo_below"), F.col("hi_ln") - F.col("lo_ln")), F.lit(0.0)
    )
    sloped = ends.withColumn("slope", slope)
    off = F.col("below") - F.col("lo_below") - F.col("slope") * (F.col("ln") - F.col("lo_ln"))
    rows = (
        points.join(F.broadcast(sloped), "cell")
        .groupBy(*sloped.columns)
        .agg(F.greatest(F.max(off), F.lit(0.0)).alias("above"), F.greatest(F.max(-off), F.lit(0.0)).alias("under"))
        .collect()
    )
    rows.sort(key=lambda r: r["cell"])
    return {c: np.array([r[c] for r in rows]) for c in (*sloped.columns, "above", "under")}


def _candidates(points: DataFrame, largest: float) -> DataFrame:
    tail_ln = F.col("from_n_ln") - F.col("from_n") * F.col("ln")
    return points.filter((F.col("x") < largest) & (tail_ln > 0)).select(
        F.col("x").alias("m"), F.col("ln").alias("m_ln"), F.col("from_n").alias("n_tail"),
        F.col("below").alias("m_below"), (1 + F.col("from_n") / tail_ln).alias("alpha"),
    )


# So many pairs of a candidate and a cell are looked at together.
_PAIRS = 1 << 20
# By so much rounding may move a bound.
_ROUNDING = 1e-12


def _at_cells(some: dict[str, np.ndarray], grid: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distance at the ends of every cell, and the most it can be inside, one row per candidate.

    Cells below a candidate are at -1. Its own cell starts at the candidate itself.
    """
    m_ln, n_tail, m_below, alpha = (some[c][:, None] for c in ("m_ln", "n_tail", "m_below", "alpha"))
    decay = alpha - 1
    inside = grid["lo_below"] < m_below
    start = np.where(inside, m_ln, grid["lo_ln"])
    at_start = grid["lo_below"] - m_below + np.where(inside, grid["slope"] * (m_ln - grid["lo_ln"]), 0.0)
    law_start, law_end = (
        -np.expm1(-decay * np.maximum(ln - m_ln, 0)) for ln in (start, grid["hi_ln"])
    )
    gap_start = at_start / n_tail - law_start
    gap_end = (grid["hi_below"] - m_below) / n_tail - law_end
    ends = np.maximum(np.abs(gap_end), np.where(inside, 0.0, np.abs(gap_start)))
    curve = (decay * (grid["hi_ln"] - start)) ** 2 / 8 * (1 - law_start)
    up = np.maximum(gap_start, gap_end) + grid["above"] / n_tail
    down = np.maximum(-gap_start, -gap_end) + grid["under"] / n_tail + curve
    most = np.maximum(ends, np.maximum(up, down)) + _ROUNDING
    passed = grid["hi_below"] < m_below
    return np.where(passed, -1.0, ends), np.where(passed, -1.0, most)


def _at_ends(some: dict[str, np.ndarray], grid: dict[str, np.ndarray], looked_at: int) -> np.ndarray:
    """The distance at so many ends of cells, spread over the tail of each candidate."""
    ends_ln, ends_below = (np.stack([grid[f"lo_{c}"], grid[f"hi_{c}"]], 1).ravel() for c in ("ln", "below"))
    first = np.searchsorted(ends_below, some["m_below"])[:, None]
    share = np.arange(1, looked_at + 1) / looked_at
    at = np.maximum(first, first + ((len(ends_ln) - first) * share).astype(np.int64) - 1)
    m_ln, n_tail, m_below, alpha = (some[c][:, None] for c in ("m_ln", "n_tail", "m_below", "alpha"))
    gap = (ends_below[at] - m_below) / n_tail + np.expm1((1 - alpha) * (ends_ln[at] - m_ln))
    return np.abs(gap).max(1)


def _chunks(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[dict[str, np.ndarray]]:
    rows = max(1, _PAIRS // cells)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield {n: part.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(part.schema.names)}


def _nearest(grid: dict[str, np.ndarray], looked_at: int):
    """Candidates with the least that their distance can be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches, 8 * looked_at):
            yield pa.RecordBatch.from_pydict({**some, "low": _at_ends(some, grid, looked_at)})

    return run


def _bounded(grid: dict[str, np.ndarray]):
    """Candidates with the least and the greatest that their distance can be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches, len(grid["cell"])):
            ends, most = _at_cells(some, grid)
            yield pa.RecordBatch.from_pydict({**some, "low": ends.max(1), "high": most.max(1)})

    return run


def _open_cells(grid: dict[str, np.ndarray]):
    """Candidates with each cell inside which the distance can be more than at all ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches, len(grid["cell"])):
            _, most = _at_cells(some, grid)
            row, cell = np.nonzero(most > some["low"][:, None])
            yield pa.RecordBatch.from_pydict({**{n: v[row] for n, v in some.items()}, "cell": grid["cell"][cell]})

    return run


def _measured(
    some: DataFrame, points: DataFrame, grid: dict[str, np.ndarray], tasks: int, spread: int
) -> DataFrame:
    """Exact distances. Candidates often share open cells; the salt splits such a cell.

    Only values of open cells are copied, once for each salt that a candidate has there.
    ``some`` was written in ``tasks`` parts by ``m``, so the work on it is spread already.
    """
    opened = some.mapInArrow(_open_cells(grid), f"{CANDIDATE}, low double, cell long")
    salt = F.pmod(F.xxhash64("m"), F.lit(spread)).cast("int").alias("salt")
    salted = written_once(opened.select("*", salt), "powerlaw-open")
    # At most ``spread`` rows per cell.
    wanted = salted.select("cell", "salt").distinct()
    singles = points.join(F.broadcast(wanted), "cell").select("cell", "ln", "below", "salt")
    seen = (F.col("below") - F.col("m_below")) / F.col("n_tail")
    law = 1 - F.exp((1 - F.col("alpha")) * (F.col("ln") - F.col("m_ln")))
    farthest = (
        salted.repartition(tasks, "cell", "salt")
        .join(singles.repartition(tasks, "cell", "salt"), ["cell", "salt"])
        .filter(F.col("below") >= F.col("m_below"))
        .groupBy("m")
        .agg(F.max(F.abs(seen - law)).alias("inner"))
    )
    d = F.greatest("low", F.coalesce("inner", F.lit(0.0)))
    return some.join(farthest, "m", "left").select(F.col("m").alias("xmin"), "n_tail", "alpha", d.alias("d"))


COMPARISON = (
    "xmin double, n_tail long, alpha double, d double, mu double, sigma double, "
    "ratio double, p_value double, favoured string"
)


def lognormal_fit(samples: DataFrame, column: str, cells: int | None = None) -> DataFrame:
    """Power law against lognormal on the same tail, one row.

    ``ratio`` is the normalised log-likelihood ratio; below zero it favours the
    lognormal. ``p_value`` tells how likely a ratio that far from zero is when
    both fit alike. ``favoured`` is ``neither`` without a power law, without a
    lognormal (the best one is then the power law itself, ratio 0) or when the
    ratio is 0.
    """
    values = written_once(value_counts(samples, column), "value-counts")
    found = _compared(values, _best_fit(values, cells).first())
    return values.sparkSession.createDataFrame([found], COMPARISON)


def _compared(values: DataFrame, fit: Row | None) -> tuple:
    if fit is None:
        return (None,) * 8 + ("neither",)
    n, y = F.col("n"), F.col("y")
    tail = values.filter(F.col("x") >= fit.xmin).select("n", ln_ratio(F.col("x"), F.lit(fit.xmin)).alias("y"))
    moments = tail.agg(F.sum(n * y) / F.sum(n), F.sum(n * y * y) / F.sum(n)).first()
    shape = _cut_normal(*moments)
    if shape is None:
        return (*fit, None, None, 0.0, 1.0, "neither")
    mu, sigma, ln_c = shape

    # Log-likelihoods of ln x; the change of variable cancels in the difference.
    law = math.log(fit.alpha - 1) - (fit.alpha - 1) * y
    normal = -math.log(sigma) - 0.5 * math.log(2 * math.pi) - F.pow((y - mu) / sigma, 2) / 2 - ln_c
    gaps = tail.select("n", (law - normal).alias("gap"))
    total = gaps.agg(F.sum(n * F.col("gap"))).first()[0]
    off = F.col("gap") - total / fit.n_tail
    squares = gaps.agg(F.sum(n * off * off)).first()[0]
    ratio = total / math.sqrt(squares) if squares > 0 else 0.0
    favoured = "neither" if ratio == 0 else "lognormal" if ratio < 0 else "power_law"
    p_value = math.erfc(abs(ratio) / math.sqrt(2))
    return (*fit, mu + math.log(fit.xmin), sigma, ratio, p_value, favoured)


def _hazard_excess(a: float) -> tuple[float, float]:
    """(h - a, 1 - a (h - a)) for the hazard h of the standard normal at ``a``.

    Right of 3 both come from a continued fraction, without subtracting near-equal numbers.
    """
    if a < 3:
        h = math.exp(-0.5 * a * a) / (math.sqrt(math.pi / 2) * math.erfc(a / math.sqrt(2)))
        return h - a, 1 - a * (h - a)
    w = 0.0
    for k in range(200, 1, -1):
        w = k / (a + w)
    return 1 / (a + w), w / (a + w)


def _cut_normal(m1: float, m2: float) -> tuple[float, float, float] | None:
    """(mu, sigma, ln c) of the normal, cut off below 0, with these first two moments.

    They are its maximum-likelihood parameters, c being the share above 0. With
    the cut at ``a`` standard deviations, m2 / m1^2 grows from 1 to 2 along
    ``a``, so bisection finds it. At 2 or more there is none: the likelihood
    grows towards the exponential, which is the power law in ln x.
    """

    def spread(a: float) -> float:
        first, second = _hazard_excess(a)
        return second / (first * first)

    low, high = -1e4, 1e4
    if m1 <= 0 or not spread(low) < m2 / (m1 * m1) < spread(high):
        return None
    for _ in range(200):
        a = (low + high) / 2
        low, high = (a, high) if spread(a) < m2 / (m1 * m1) else (low, a)
    first, _ = _hazard_excess(a)
    sigma = m1 / first
    ln_c = (
        math.log(0.5 * math.erfc(a / math.sqrt(2)))
        if a < 3
        else -0.5 * a * a - 0.5 * math.log(2 * math.pi) - math.log(first + a)
    )
    return -a * sigma, sigma, ln_c
