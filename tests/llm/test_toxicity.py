import random
import zlib

from pyspark.sql import functions as F

from flightrank.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
SYLLABLES = ["ba", "de", "fi", "go", "lu", "mi", "no", "pe", "ra", "su"]


def corpus(n=900, seed=3):
    """Ordinary words, and in a third of the texts some of two abusive words or a stem."""
    rng = random.Random(seed)

    def word():
        return "".join(rng.choices(SYLLABLES, k=rng.randint(2, 4)))

    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(4):
                bad = rng.choice(["kruzk", "vhmz", "zwart" + word()])
                words[rng.randrange(len(words))] = bad
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark, docs):
    rows, labels = corpus()
    table = spark.createDataFrame(labels, LABELS)
    found = {r.doc_id: r for r in toxicity.score_documents(docs(*rows), table).collect()}
    assert len(found) == len(rows)
    for i, _, toxic in labels:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert found[i].predicted == int(found[i].score >= 0.7)
        assert 0 <= found[i].score <= 1
    held = [(found[i].score, toxic) for i, _, toxic in labels if found[i].held_out]
    right = sum((s >= 0.7) == bool(t) for s, t in held)
    assert right >= 0.97 * len(held)


def test_labels_of_held_out_rows_change_nothing(spark, docs):
    rows, labels = corpus(300)

    def scores(own):
        found = toxicity.score_documents(docs(*rows), spark.createDataFrame(own, LABELS))
        return {r.doc_id: r.score for r in found.collect()}

    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    assert scores(labels) == scores(flipped)


def test_nulls_long_texts_and_repeated_rows(spark, docs):
    rows, labels = corpus(300)
    odd = [(1000, None), (1001, ""), (1002, "... 123 !"), (None, "badego kruzk"), (5, rows[5][1])]
    odd += [(1003, "badego " * 50_000 + "kruzk vhmz zwartba"), (1003, "badego")]
    table = spark.createDataFrame([*labels, (None, 1, 1), (7, 1, None), (5, 0, 0)], LABELS)
    found = toxicity.score_documents(docs(*rows, *odd), table).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[1000] == by_id[1001] == by_id[1002]
    assert [r.held_out for r in found if r.doc_id is None] == [False]


def test_without_labels_and_without_documents(spark, docs):
    none = spark.createDataFrame([], LABELS)
    found = toxicity.score_documents(docs((1, "a"), (2, None)), none).collect()
    assert [r.predicted for r in found] == [0, 0]
    one_class = spark.createDataFrame([(2, 1, 0)], LABELS)
    assert toxicity.score_documents(docs((1, "a"), (2, "b")), one_class).count() == 2
    assert toxicity.score_documents(docs((1, "a")).limit(0), one_class).collect() == []


def test_keep_ordinary_keeps_the_columns(spark, docs):
    rows, labels = corpus(400)
    table = docs(*rows)
    kept = toxicity.keep_ordinary(table, spark.createDataFrame(labels, LABELS))
    assert kept.schema == table.schema
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & {i for i, _, t in labels if not t}) >= 0.98 * 266
    assert len(ids & {i for i, _, t in labels if t}) <= 10


def test_shared_model_is_a_distribution():
    strings = sorted({s for w in ("abba", "abc", "bca", "caab") for s in toxicity.strings_of(w)})
    shared = toxicity._shared(strings)
    letters = {s[-1] for s in strings}
    for context in ("", "a", "b"):
        total = sum(shared.get(context + c, 0) for c in letters)
        assert 0 < total <= 1 + 1e-9


def test_strings_are_anchored_at_the_start_of_a_word():
    assert toxicity.strings_of("ab") == ["^a", "^ab", "^ab$"]
    assert toxicity.strings_of("abcdef")[-1] == "bcdef$"


def test_held_out_of_a_missing_id(spark):
    row = spark.range(1).select(toxicity.held_out(F.lit(None).cast("long")).alias("h")).first()
    assert row.h is None


def test_rare_toxic_strings_stay_among_many_frequent_ordinary_ones(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxy"
    # Some 200,000 strings of count 3, before the toxic word's of count 2.
    ordinary = " ".join("".join(rng.choices(letters, k=8)) for _ in range(40_000))
    rows = [(0, True, ordinary)] * 3 + [(1, True, "zkrzvelz")] * 2
    sample = spark.createDataFrame(rows, "toxic int, fit boolean, text string")
    assert toxicity.fit_models(sample)[0].difference("zkrzvelz") > 1


def test_the_sample_has_one_row_per_id(spark, docs):
    rows, labels = corpus(60)
    table = spark.createDataFrame(labels, LABELS)
    repeated = rows + [(0, text) for _, text in rows] + [(0, None)] * 20
    for partitions in (1, 5):
        own = docs(*repeated, partitions=partitions)
        sample = toxicity.sampled(own, table, F.lit(True)).collect()
        assert sorted(r.doc_id for r in sample) == [i for i, _ in rows]
        assert {r.doc_id: r.toxic for r in sample} == {i: t for i, _, t in labels}
        texts = {r.doc_id: r.text for r in sample}
        assert {i: t for i, t in texts.items() if i} == dict(rows[1:])
        kept = texts[0] if partitions == 1 else kept
        assert kept is not None and texts[0] == kept
