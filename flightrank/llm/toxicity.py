"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models over the letters of words, one of toxic and
one of ordinary texts, give each word a log-likelihood. Letters, not words, so
that forms of an abusive stem that no labelled row holds are known by the stem.
A letter follows up to ``ORDER - 1`` before it, the start of the word among
them. What a class has seen too rarely falls back, in both classes, on one
shared model of continuation counts, so rare expressions decide nothing.

The difference of the two log-likelihoods is normalised by length, over the
whole text, over its worst stretches of ``WINDOWS`` words, since one abuse in a
long text is enough, and over its ``WORST`` words wherever they are. A logistic
curve fitted on rows the counts have not seen turns these into a score, and
those rows choose among ``DISCOUNTS``.

The models are fitted on a bounded sample of labelled rows: the ``MAX_TOXIC``
and ``MAX_ORDINARY`` first by a hash of the id. A word counts once per text.
Strings of letters counted fewer than ``MIN_COUNT`` times are rare; all others are
kept, as sorted 64-bit hashes with a number each, so 16 bytes a string are sent and
the bounded sample bounds the broadcast. Scoring reads every whole text.

Defined results: null and empty texts, and texts without a letter, have
differences of zero and get the score of such a text; ids without a label are
only scored; a repeated label counts as toxic if one of its rows says so; rows
that repeat are each scored, but of an id's rows one is learnt from; without labels of both classes every score is the
share of toxic labels, or about 0 without any; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightrank.llm.recent import Recent
from flightrank.llm.shipping import ship
from flightrank.llm.text import fresh_name, schema_with

MAX_TOXIC = 20_000
MAX_ORDINARY = 40_000
ORDER = 6
MIN_COUNT = 2
KEEP = 150_000  # differences of words that a task keeps while scoring
GROUP = 1 << 18  # letters of the texts whose new words are looked up together
LOOK_UP = 20_000  # words looked up together
WINDOWS = (1, 3, 10)
WORST = 5
DISCOUNTS = (0.75, 2.0, 4.0)
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_START, _END = "^", "$"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def strings_of(word: str) -> list[str]:
    """Each letter of a word, and its end, after the letters before it."""
    marked = f"{_START}{word}{_END}"
    return [marked[max(0, i - ORDER + 1) : i + 1] for i in range(1, len(marked))]


def _hashes(words: list[str], base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all ``strings_of`` the words, in order, the hashes of each and of each without its
    last letter; and where the words start in both.

    A string's hash is the polynomial of its letters in ``base``, modulo 2**64.
    """
    marked = "".join(f"{_START}{w}{_END}" for w in words)
    letters = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(starts, sizes)
    context, power = np.zeros(len(letters), np.uint64), 1
    for k in range(1, min(ORDER, len(letters))):
        context[k:] += np.where(place[k:] >= k, letters[:-k] * np.uint64(power), np.uint64(0))
        power = power * base % (1 << 64)
    string = letters + context * np.uint64(base)
    inside = place > 0
    return string[inside], context[inside], starts - np.arange(len(words))


def _hash(string: str, base: int) -> int:
    found = 0
    for letter in string:
        found = (found * base + ord(letter)) % (1 << 64)
    return found


class Table:
    """A number for each string, by sorted hashes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def get(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the wanted hashes, 0 for others, and which are there."""
        if not len(self.keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        there = self.keys[at] == wanted
        return np.where(there, self.values[at], 0.0), there


class Models:
    """What the two models differ by.

    For a string that neither class keeps, both models give their backoff share
    times the same shared probability, so the difference is that of the shares.
    """

    def __init__(self, strings: Table, contexts: Table, base: int, keep: int = 50_000):
        self.strings, self.contexts, self.base, self.keep = strings, contexts, base, keep
        self.known, self.fresh = Recent(self.difference, keep), {}

    def __getstate__(self):
        return self.strings, self.contexts, self.base, self.keep

    def __setstate__(self, state):
        self.__init__(*state)

    def differences(self, words: list[str]) -> list[float]:
        """Toxic minus ordinary log-likelihood of each word."""
        string, context, starts = _hashes(words, self.base)
        found, there = self.strings.get(string)
        left = np.flatnonzero(~there)
        found[left] = self.contexts.get(context[left])[0]
        return np.add.reduceat(found, starts).tolist()

    def difference(self, word: str) -> float:
        own = self.fresh.get(word)
        return self.differences([word])[0] if own is None else own

    def features(self, texts: Iterable[str | None]) -> Iterator[list[float]]:
        """``_features`` of each text; the new words of some texts are looked up together."""
        group, letters = [], 0
        for text in texts:
            group.append(words_of(text))
            letters += len(text or "")
            if letters >= GROUP:
                yield from self._of_group(group)
                group, letters = [], 0
        yield from self._of_group(group)

    def _of_group(self, group: list[list[str]]) -> Iterator[list[float]]:
        known = self.known
        new = [w for w in set().union(*group) if w not in known and w not in known.older]
        for at in range(0, len(new), LOOK_UP):
            part = new[at : at + LOOK_UP]
            self.fresh.update(zip(part, self.differences(part)))
        yield from map(self._features, group)
        self.fresh.clear()

    def _features(self, words: list[str]) -> list[float]:
        """Length-normalised differences: of the whole text, and of its worst stretches."""
        if not words:
            return [0.0] * FEATURES
        each = np.fromiter(map(self.known.__getitem__, words), float, len(words))
        total = np.concatenate([[0.0], np.cumsum(each)])
        mean = float(total[-1] / len(words))
        worst = [
            float((total[size:] - total[:-size]).max() / size) if len(words) >= size else mean
            for size in WINDOWS
        ]
        # Each word once here: a text may repeat one word a thousand times.
        highest = heapq.nlargest(WORST, map(self.known.__getitem__, set(words)))
        return [mean, *worst, sum(highest) / len(highest), math.log(len(words))]


FEATURES = 3 + len(WINDOWS)


def sampled(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """The bounded sample: ``doc_id, toxic, fit, text``; a fifth is kept from the counts."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    toxic = known.filter("toxic = 1").orderBy("place", "doc_id").limit(MAX_TOXIC)
    ordinary = known.filter("toxic = 0").orderBy("place", "doc_id").limit(MAX_ORDINARY)
    chosen = toxic.unionByName(ordinary).select(
        "doc_id", "toxic", (F.pmod("place", F.lit(5)) != 0).alias("fit")
    )
    # At most MAX_TOXIC + MAX_ORDINARY rows of three short columns.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Of rows that repeat an id, one with a text, the first by a hash of it. Each task reduces
    # its own rows before the shuffle, so an id with many rows sends one a task.
    first = F.min(F.struct(F.col("text").isNull(), F.xxhash64("text"), "text"))["text"]
    return found.groupBy("doc_id", "toxic", "fit").agg(first.alias("text"))


def _words_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, toxic = [], []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = set(words_of(text.as_py()))
            words += own
            toxic += [label] * len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"]
        )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [strings_of(w) for w in batch.column(0).to_pylist()]
        times = np.fromiter(map(len, found), np.int64, len(found))
        counts = [np.repeat(batch.column(i).to_numpy(zero_copy_only=False), times) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for own in found for s in own], pa.string()), *map(pa.array, counts)],
            ["string", "n0", "n1"],
        )


def fit_models(sample: DataFrame) -> list[Models]:
    """Models for each of ``DISCOUNTS``.

    Strings are counted by Spark; the driver gets those that reach ``MIN_COUNT``, some
    25 bytes each.
    """
    words = (
        sample.filter("fit")
        .select("toxic", "text")
        .mapInArrow(_words_once, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum(1 - F.col("toxic")).alias("n0"), F.sum("toxic").alias("n1"))
    )
    strings = (
        words.mapInArrow(_strings, "string string, n0 long, n1 long")
        .groupBy("string")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .filter(F.col("n0") + F.col("n1") >= MIN_COUNT)
    )
    kept = strings.toArrow().sort_by("string")
    counts = np.column_stack([kept[n].to_numpy().astype(float) for n in ("n0", "n1")])
    return _models(kept["string"].to_pylist(), counts, DISCOUNTS)


def _discount(counts: list[float]) -> float:
    """Kneser-Ney's estimate from how many are seen about once and twice."""
    once, twice = sum(n < 1.5 for n in counts), sum(1.5 <= n < 2.5 for n in counts)
    return min(max(once / max(1, once + 2 * twice), 0.1), 0.95)


def _interpolated(counts: dict[str, float], lower: dict[str, float], floor: float) -> dict[str, float]:
    """Of each string, its last letter's probability after the rest."""
    d = _discount(list(counts.values()))
    total, left = defaultdict(float), defaultdict(float)
    for s, n in counts.items():
        total[s[:-1]] += n
        left[s[:-1]] += min(n, d)
    return {
        s: (n - min(n, d) + left[s[:-1]] * lower.get(s[1:], floor)) / total[s[:-1]]
        for s, n in counts.items()
    }


def _shared(strings: list[str]) -> dict[str, float]:
    """The shared model below the strings, of both classes: counts of distinct letters
    before a string."""
    floor = 1 / (len({s[-1] for s in strings}) + 1)
    lower: dict[str, float] = {}
    for length in range(1, ORDER):
        # One length at a time, which holds the fewest strings at once.
        kinds: dict[str, float] = defaultdict(float)
        for end in {s[-length - 1 :] for s in strings if len(s) > length}:
            kinds[end[1:]] += 1
        lower |= _interpolated(kinds, lower, floor)
    return lower


def _hashed(*tables: list[str]) -> tuple[int, *tuple[np.ndarray, ...]]:
    """A base by which no two strings of a table have one hash, and the tables' hashes."""
    for base in range(0x9E3779B97F4A7C15, 1 << 64, 2):
        hashes = [np.fromiter((_hash(s, base) for s in t), np.uint64, len(t)) for t in tables]
        if all(len(np.unique(h)) == len(t) for h, t in zip(hashes, tables)):
            return base, *hashes


def _models(strings: list[str], counts: np.ndarray, discounts: tuple[float, ...]) -> list[Models]:
    """Both classes' models for each discount, over the shared one of the same strings.

    Ordinary counts are scaled to the size of the toxic ones. Otherwise the class
    with fewer texts would leave more to the backoff everywhere, and any new word
    would look like that class.
    """
    size = counts.sum(0)
    counts = counts * (size.min() / np.maximum(size, 1))
    shared = _shared(strings)
    below = np.fromiter((shared[s[1:]] for s in strings), float, len(strings))
    del shared
    number: dict[str, int] = {}
    of = np.fromiter((number.setdefault(s[:-1], len(number)) for s in strings), np.int64, len(strings))
    base, string_hashes, context_hashes = _hashed(strings, list(number))
    by_string, by_context = np.argsort(string_hashes), np.argsort(context_hashes)
    string_keys, context_keys = string_hashes[by_string], context_hashes[by_context]

    def summed(each: np.ndarray) -> np.ndarray:
        """By context and class."""
        return np.column_stack([np.bincount(of, each[:, c], len(number)) for c in (0, 1)])

    total, made = summed(counts), []
    some = np.where(total > 0, total, 1.0)
    for d in discounts:
        backoff = np.where(total > 0, summed(np.minimum(counts, d)) / some, 1.0)
        contexts = np.log(backoff[:, 1]) - np.log(backoff[:, 0])
        p = np.maximum(counts - d, 0) / some[of] + backoff[of] * below[:, None]
        differ = np.log(p[:, 1]) - np.log(p[:, 0])
        # The keys are the same arrays in each, and sent once.
        made.append(Models(Table(string_keys, differ[by_string]), Table(context_keys, contexts[by_context]), base))
    return made


@dataclass
class Curve:
    """A logistic curve over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.c_[(features - self.mean) / self.scale, np.ones(len(features))]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))

    def loss(self, features: np.ndarray, toxic: np.ndarray) -> float:
        p = self.scores(features)
        return float(-np.log(np.where(toxic == 1, p, 1 - p)).sum())


def fit_curve(features: np.ndarray, toxic: np.ndarray, penalty: float = 0.3) -> Curve:
    """Newton steps on the penalised likelihood; few rows and features."""
    width = features.shape[1]
    if not len(features) or toxic.min() == toxic.max():
        rate = min(max(float(toxic.mean()) if len(toxic) else 0.0, 1e-6), 1 - 1e-6)
        flat = np.r_[np.zeros(width), math.log(rate / (1 - rate))]
        return Curve(np.zeros(width), np.ones(width), flat)
    mean, scale = features.mean(0), features.std(0) + 1e-9
    x = np.c_[(features - mean) / scale, np.ones(len(features))]
    weights, ridge = np.zeros(width + 1), np.r_[np.full(width, penalty), 1e-6]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        weights += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return Curve(mean, scale, weights)


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[Models, Curve]:
    """Models and curve. ``learn``: which rows of ``labels`` may be learnt from."""
    ship(docs.sparkSession)
    sample = sampled(docs, labels, learn)
    choices = fit_models(sample)
    sent = docs.sparkSession.sparkContext.broadcast(choices)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [sum(own, []) for own in zip(*(m.features(texts) for m in sent.value))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["toxic", "x"]
            )

    # About a fifth of the bounded sample, a few numbers each.
    rows = (
        sample.filter("not fit").select("toxic", "text").mapInArrow(measure, "toxic int, x array<double>").collect()
    )
    toxic = np.array([r["toxic"] for r in rows], float)
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(choices), FEATURES)
    curves = [fit_curve(x[:, i], toxic) for i in range(len(choices))]
    losses = [c.loss(x[:, i], toxic) for i, c in enumerate(curves)]
    best = int(np.argmin(losses))
    sent.unpersist()
    return choices[best], curves[best]


def with_scores(docs: DataFrame, models: Models, curve: Curve, name: str) -> DataFrame:
    """``docs`` with the score of each whole text in the column ``name``."""
    ship(docs.sparkSession)
    models = Models(models.strings, models.contexts, models.base, KEEP)
    sent = docs.sparkSession.sparkContext.broadcast((models, curve))
    at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, curve = sent.value
        for batch in batches:
            x = np.array(list(models.features(t.as_py() for t in batch.column(at))), float)
            scores = curve.scores(x.reshape(batch.num_rows, FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name]
            )

    return docs.mapInArrow(add, schema_with(docs, name, T.DoubleType()))


def held_out(doc_id: Column) -> Column:
    """Rows kept from all learning: crc32 of the id's digits leaves 1 when divided by 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    models, curve = train(docs, labels, ~held_out(F.col("doc_id")))
    scored = with_scores(docs.select("doc_id", "text"), models, curve, "score")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, with their columns as they are."""
    models, curve = train(docs, labels, ~held_out(F.col("doc_id")))
    name = fresh_name("score", docs.columns)
    return with_scores(docs, models, curve, name).filter(F.col(name) < THRESHOLD).drop(name)
