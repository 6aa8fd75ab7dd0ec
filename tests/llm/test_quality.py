import math
import re
from collections import Counter

import pytest

from flightrank.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def slow_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def found(docs):
    return {r.doc_id: tuple(r[c] for c in BASE) for r in quality.counts(docs).collect()}


TEXTS = {
    1: None,
    2: "",
    3: " \n\t\x0b\r\n ",
    4: "one two three four five six seven",
    5: "one two three four five six seven eight",
    6: "a a a a a a a a a",
    7: "Ä𝒳 ß#*$ |x|\nsame line\n\nsame line\n same line\nsame line",
    8: " ".join(map(str, range(40))) + " " + " ".join(map(str, range(12, 31))) + " end",
    9: "no break is no separator " * 9,
    10: ("the quick brown fox jumps over a lazy dog " * 3 + "\n") * 400,
}


def test_counts_equal_a_brute_force_version(spark, docs):
    assert found(docs(*TEXTS.items())) == {d: slow_counts(t) for d, t in TEXTS.items()}


def test_very_long_texts_and_repeated_windows_that_overlap(spark, docs):
    texts = {1: "x " * 100_000, 2: " ".join(f"w{i % 5000}" for i in range(30_000)), 3: "y" * 500_000}
    assert found(docs(*texts.items())) == {d: slow_counts(t) for d, t in texts.items()}


def test_null_ids_repeated_rows_and_empty_tables(spark, docs):
    text = "plain words of a plain text that goes on for a while and says hardly anything at all to anyone who reads it"
    rows = [(None, text), (7, text), (7, text), (7, None)]
    judged = quality.judge(docs(*rows)).collect()
    assert sorted((r.doc_id is None, r.n_words, r.base_failed) for r in judged) == [
        (False, 0, True), (False, 23, False), (False, 23, False), (True, 23, False)
    ]
    assert quality.judge(docs()).collect() == []
    columns = ["doc_id", *BASE, "base_failed", "posterior", "kept"]
    assert set(columns) <= set(quality.judge(docs()).columns)


def slow_fit(cast):
    """Expectation-maximisation, one document at a time."""
    n_rules = len(quality.RULES)
    share, good, bad = quality.START_SHARE, [quality.START_ON_GOOD] * n_rules, [quality.START_ON_BAD] * n_rules
    weight = quality.PRIOR_WEIGHT
    for _ in range(quality.ROUNDS):
        posteriors = [slow_posterior(v, share, good, bad) for v in cast]
        rate = lambda part, whole, prior: (part + weight * prior) / (whole + weight)
        share = rate(sum(posteriors), len(cast), quality.START_SHARE)
        old_good, old_bad = good, bad
        good, bad = list(old_good), list(old_bad)
        for j in range(n_rules):
            voted = [(p, v[j]) for p, v in zip(posteriors, cast) if v[j] is not None]
            good[j] = rate(sum(p for p, x in voted if x), sum(p for p, _ in voted), quality.START_ON_GOOD)
            bad[j] = rate(sum(1 - p for p, x in voted if not x), sum(1 - p for p, _ in voted), quality.START_ON_BAD)
    return share, good, bad


def slow_posterior(votes, share, good, bad):
    likely, unlikely = share, 1 - share
    for v, g, b in zip(votes, good, bad):
        if v is not None:
            likely *= g if v else 1 - g
            unlikely *= 1 - b if v else b
    return likely / (likely + unlikely)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_fit_equals_a_plain_one(spark, corpus):
    voted = quality.votes(quality.counts(corpus)).cache()
    share, good, bad = slow_fit([r.votes for r in voted.collect()])
    model = quality.fit(voted)
    assert model.share == pytest.approx(share, abs=1e-9)
    assert model.on_good == pytest.approx(good, abs=1e-9) and model.on_bad == pytest.approx(bad, abs=1e-9)
    for r in voted.withColumn("p", quality.posterior(model)).collect():
        assert math.isclose(r.p, slow_posterior(r.votes, share, good, bad), abs_tol=1e-9)


def test_verdicts_agree_with_labels_that_they_never_saw(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter(~quality.base_failed())
    rows = judged.join(labels, "doc_id").collect()
    right = {q: [r.kept for r in rows if r.quality == q] for q in (0, 1)}
    assert sum(right[1]) >= 0.99 * len(right[1])
    assert sum(right[0]) <= 0.1 * len(right[0])


def test_a_document_that_fails_one_rule_can_stay(spark, docs):
    def words(i, n):
        return [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}{'x' * (i % 4)}" for k in range(n)]

    clean = [(i, "\n".join(words(i, 100))) for i in range(40)]
    short = [(50 + i, " ".join(words(i, 25))) for i in range(5)]
    junk = [(100 + i, " ".join(f"AB{k}!!$$" for k in range(100 + i))) for i in range(20)]
    judged = {r.doc_id: r for r in quality.judge(docs(*clean, *short, *junk)).collect()}
    assert all(judged[i].kept for i, _ in clean + short) and not any(judged[i].kept for i, _ in junk)
    assert all(0 in judged[i].votes for i, _ in short)
