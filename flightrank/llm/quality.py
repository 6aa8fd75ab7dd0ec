"""Quality rules by weak supervision: rules vote or abstain, a fitted model weighs the votes.

Each rule votes a document good or bad, or abstains, from whole-number counts of
its text. Nobody labels documents. Expectation-maximisation fits, over the votes
of all documents, the share of good documents and two accuracies of each rule:
how often it votes good on good documents and bad on bad ones, where it votes.
The posterior probability of a good document then decides, so a document can
fail a rule and stay, or pass most and go.

The fit sees one row per combination of votes. There are at most three to the
power of the number of rules, whatever the number of documents. Counts of a text are taken inside its row, so a hot
source or a group of copies is no group here; nothing is shuffled but the counts
of combinations.

Defined results: a null text is empty and has no words; empty texts and those of
under ``MIN_WORDS`` words fail the base rules, as do those in which repeated
passages cover more than ``REPEAT_PERCENT`` of the words; rows that repeat are
judged each; a null id stays; a posterior of exactly ``KEEP`` stays; other
columns of the input are not used; an empty table gives an empty result. A text
is held whole by one row, and a text with repeated windows once more for each
word of a window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightrank.session import written_once

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
KEEP = 0.5
ROUNDS = 40
SYMBOLS = "#*$%&|<>"
SPACE = r"[\x20\x09-\x0D]+"

# Votes are SQL over whole-number counts: bad if the first holds, good if the second does.
# Several rules look at each defect from different sides, so that the fit sees them agree.
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words < 30", "n_words >= 80"),
    "word_length": (
        "word_chars < 3 * n_words OR word_chars > 12 * n_words",
        "word_chars >= 4 * n_words AND word_chars <= 9 * n_words",
    ),
    "symbols": ("10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    "letters": ("10 * n_letters < 9 * word_chars", "100 * n_letters >= 94 * word_chars"),
    "odd_characters": ("10 * n_odd > 3 * n_words", "10 * n_odd <= n_words"),
    "marks": ("10 * n_marks > n_words", "50 * n_marks <= n_words"),
    "capitals": ("10 * n_capitals > 3 * n_letters", "10 * n_capitals <= n_letters"),
    "duplicate_lines": ("10 * n_dup_lines > 3 * n_lines", "n_lines >= 5 AND 20 * n_dup_lines <= n_lines"),
    "repeated_passages": ("10 * n_repeat_words > n_words", "n_words >= 50 AND n_repeat_words = 0"),
    "variety": ("n_words >= 50 AND 5 * n_distinct < n_words", "2 * n_distinct >= n_words"),
}

# Where the fit starts, and what it is held to as by so many documents seen before:
# most documents are good, and a rule is better than chance on either kind.
START_SHARE, START_ON_GOOD, START_ON_BAD = 0.8, 0.9, 0.6
PRIOR_WEIGHT = 10.0


@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule the accuracy on good and on bad ones."""

    share: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _neighbours_alike(ordered: Column) -> Column:
    """The entries ``(key, place)`` of a sorted array whose key another entry has."""

    def alike(entry: Column, i: Column) -> Column:
        before, after = (F.get(ordered, i + step)["key"] for step in (-1, 1))
        return (before == entry["key"]) | (after == entry["key"])

    return F.filter(ordered, alike)


def _covered(places: Column) -> Column:
    """How many words the windows that start at these sorted places cover."""
    reach = F.transform(
        places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))
    )
    return F.aggregate(reach, F.lit(0).cast("long"), lambda total, n: total + n)


def _repeat_words(words: Column, windows: Column) -> Column:
    """Words in windows that are found again. Equal hashes only propose; the words decide."""

    def entries(of: Column, key) -> Column:
        return F.sort_array(F.transform(of, key))

    hashed = entries(windows, lambda h, i: F.struct(h.alias("key"), i.alias("place")))

    def text(entry: Column) -> Column:
        own = F.array_join(F.slice(words, entry["place"] + 1, F.lit(WINDOW)), " ")
        return F.struct(own.alias("key"), entry["place"].alias("place"))

    spelt = _let(hashed, lambda h: entries(_neighbours_alike(h), text))
    repeated = _let(spelt, lambda s: F.array_sort(F.transform(_neighbours_alike(s), lambda e: e["place"])))
    found = _let(repeated, _covered)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.lit(0).cast("long"))


def _once(table: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions use several times; the one-element
    ``inline`` keeps them from being computed anew for each use."""
    row = F.struct(*table.columns, *[c.alias(name) for name, c in columns.items()])
    return table.select(F.inline(F.array(row)))


def counts(docs: DataFrame) -> DataFrame:
    """The counts that rules look at, one row per document, by ``doc_id``."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = F.array_remove(F.split("text", SPACE), "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # What is neither letter nor digit is a small part of most texts: marks are counted there.
    others = F.regexp_replace("text", r"[\p{L}\p{Nd}\x20\x09-\x0D]+", "")
    table = _once(texts, words=words, lines=lines, others=others)
    table = _once(table, hashes=F.transform("words", lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW)
    window = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)])
    )
    enough = F.size("words") >= WINDOW
    table = _once(table, windows=F.when(enough, window).otherwise(F.array().cast("array<bigint>")))

    def of_others(kept: str) -> Column:
        return F.length(F.regexp_replace("others", f"[^{kept}]+", ""))

    word_chars = F.length(F.array_join("words", ""))
    numbers = {
        "n_words": F.size("words"),
        "word_chars": word_chars,
        "n_symbols": of_others(SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(F.col("words"), F.col("windows")),
        "n_lines": F.size("lines"),
        "n_distinct": F.size(F.array_distinct("hashes")),
        "n_letters": word_chars - F.length("others"),
        "n_odd": F.length(F.regexp_replace("others", "[.,;:'-]+", "")),
        "n_marks": of_others("!?"),
        "n_capitals": F.length(F.regexp_replace("text", r"\P{Lu}+", "")),
    }
    return table.select("doc_id", *[c.cast("long").alias(name) for name, c in numbers.items()])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def votes(table: DataFrame) -> DataFrame:
    """Add ``votes``, in the order of ``RULES``: 1 good, 0 bad, null where a rule abstains."""
    cast = [F.when(F.expr(bad), 0).when(F.expr(good), 1) for bad, good in RULES.values()]
    return table.withColumn("votes", F.array(*cast))


def _posterior(cast: Column, prior: Column, on_good: Column, on_bad: Column) -> Column:
    """Probability of a good document, given its votes and a model."""

    def weight(vote: Column, right: Column) -> Column:
        good, bad = right["good"], right["bad"]
        says_good, says_bad = F.ln(good / (1 - bad)), F.ln((1 - good) / bad)
        return F.when(vote == 1, says_good).when(vote == 0, says_bad).otherwise(F.lit(0.0))

    rates = F.zip_with(on_good, on_bad, lambda g, b: F.struct(g.alias("good"), b.alias("bad")))
    weights = F.zip_with(cast, rates, weight)
    log_odds = F.aggregate(weights, F.ln(prior / (1 - prior)), lambda total, w: total + w)
    return 1 / (1 + F.exp(-log_odds))


def posterior(model: Model) -> Column:
    """Probability of a good document, from its ``votes``."""
    return _posterior(
        F.col("votes"),
        F.lit(model.share),
        F.array(*map(F.lit, model.on_good)),
        F.array(*map(F.lit, model.on_bad)),
    )


def fit(voted: DataFrame, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the combinations of votes, as one row of at most
    ``3 ** len(RULES)`` of them; the model alone comes to the driver."""
    combinations = voted.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    # In one order, so that sums come out the same whichever task is first.
    seen = F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("seen")
    start = F.struct(
        F.lit(START_SHARE).alias("share"),
        F.array_repeat(F.lit(START_ON_GOOD), len(RULES)).alias("on_good"),
        F.array_repeat(F.lit(START_ON_BAD), len(RULES)).alias("on_bad"),
    )
    fitted = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, lambda model, _: _next(model, F.col("seen"))
    )
    found = combinations.agg(seen).select(F.inline(F.array(fitted))).first()
    return Model(found.share, tuple(found.on_good), tuple(found.on_bad))


def _next(model: Column, seen: Column) -> Column:
    """The model after one more round."""

    def weigh(row: Column) -> Column:
        good = row["n"] * _posterior(row["votes"], model["share"], model["on_good"], model["on_bad"])
        return F.struct(row["votes"].alias("votes"), good.alias("good"), (row["n"] - good).alias("bad"))

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda sum_, row: sum_ + value(row))

    def rate(part: Column, whole: Column, prior: float) -> Column:
        return (part + PRIOR_WEIGHT * prior) / (whole + PRIOR_WEIGHT)

    def accuracies(rows: Column, kind: str, vote: int, prior: float) -> Column:
        def of_rule(j: Column) -> Column:
            right = total(rows, lambda r: F.when(F.get(r["votes"], j) == vote, r[kind]).otherwise(0.0))
            cast = total(rows, lambda r: F.when(F.get(r["votes"], j).isNotNull(), r[kind]).otherwise(0.0))
            return rate(right, cast, prior)

        return F.transform(F.sequence(F.lit(0), F.lit(len(RULES) - 1)), of_rule)

    def maximised(rows: Column) -> Column:
        good = total(rows, lambda r: r["good"])
        every = total(rows, lambda r: r["good"] + r["bad"])
        return F.struct(
            rate(good, every, START_SHARE).alias("share"),
            accuracies(rows, "good", 1, START_ON_GOOD).alias("on_good"),
            accuracies(rows, "bad", 0, START_ON_BAD).alias("on_bad"),
        )

    return _let(F.transform(seen, weigh), maximised)


def judge(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Counts, ``base_failed``, the ``posterior`` of a good document and ``kept``, one row per
    document. Without a ``model`` it is fitted on these documents."""
    voted = votes(written_once(counts(docs), "quality-counts")).withColumn("base_failed", base_failed())
    model = model or fit(voted)
    good = voted.withColumn("posterior", posterior(model))
    return good.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP))
