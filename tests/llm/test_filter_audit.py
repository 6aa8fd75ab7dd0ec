import itertools
import re
from collections import defaultdict

import pytest

from flightrank.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, part string, n string"


def slow(rows, labels):
    """Every document through every order, one at a time."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    least = {}
    for d, text, _ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    out = defaultdict(lambda: [0] * 6)
    for d, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": d is not None and d > least[text],
        }
        for order in itertools.permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                count = out[source or "", "".join(order), step]
                count[0] += not gone and not fails[f]
                count[1] += not gone and fails[f]
                count[2] += gone and fails[f]
                count[3] += fails[f] and sum(fails.values()) == 1
                count[4] += not gone and fails[f] and d in good
                count[5] += not gone and fails[f] and d in toxic
                gone = gone or fails[f]
    shapley = defaultdict(int)
    for (part, order, step), count in out.items():
        shapley[part, order[step - 1]] += count[1]
    return sorted((*key, *count, shapley[key[0], key[1][key[2] - 1]]) for key, count in out.items())


def frame(spark, rows):
    full = [(d, t, s, "x", 3, True) for d, t, s in rows]
    schema = "doc_id long, text string, source string, part string, n int, first boolean"
    return spark.createDataFrame(full, schema).repartition(4)


def found(spark, rows, labels):
    given = spark.createDataFrame([(*x, "y", "z") for x in labels], LABELS)
    return sorted(map(tuple, filter_audit.audit(frame(spark, rows), given).collect()))


LONG = " ".join(f"w{i}" for i in range(250))


def test_equals_brute_force(spark):
    texts = ["", None, "short", LONG, LONG + " #", "Same " * 300, "SHOUT " * 250, LONG.upper(), "tab\x0bvt | x", "ß" * 40]
    rows = [(i, texts[i % 10], ["a", "b", None, ""][i % 4]) for i in range(60)]
    rows += [(7, LONG, "a"), (7, LONG, "a"), (7, LONG, "b"), (None, LONG, "a"), (None, "new", None)]
    labels = [(i, i % 3, i % 2) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1), (8, None, None)]
    assert found(spark, rows, labels) == slow(rows, labels)


def test_copies_are_found_across_parts_and_a_hot_part_is_counted_whole(spark):
    rows = [(i, "copy", "hot") for i in range(500)] + [(600, "copy", "cold"), (601, "other", "cold")]
    assert found(spark, rows, [(0, 1, 1), (600, 1, 0)]) == slow(rows, [(0, 1, 1), (600, 1, 0)])


def test_repeated_rows_of_the_least_id_all_pass(spark):
    rows = [(1, "x", "s")] * 30 + [(2, "x", "s")]
    assert found(spark, rows, []) == slow(rows, [])


def test_no_documents_and_very_long_texts(spark):
    assert found(spark, [], [(1, 1, 1)]) == []
    rows = [(1, "long text " * 60_000, "s"), (2, "x" * 400_000, "s")]
    assert found(spark, rows, []) == slow(rows, [])


@pytest.mark.parametrize("mask", [0, 1, 5, 31])
def test_fields_hold_large_sums_side_by_side(mask):
    packed = filter_audit.Packed("ABCDE")
    most = 2**63 - 1
    counts = packed.counts(most * packed.number(mask, True, False))
    one = packed.fields(mask, True, False)
    assert counts.ravel().tolist() == [most * x for x in one]
    assert packed.steps == 600
