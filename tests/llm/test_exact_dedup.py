import hashlib

from pyspark.sql import functions as F

from flightrank.llm import exact_dedup

LONG = "Word " * 40_000
ROWS = [
    (1, "Same"), (2, "sAME"), (3, "same "), (4, None), (5, ""), (6, "É"), (7, "é"), (None, "Same"),
    (9, LONG), (8, LONG.lower()), (10, "twice"), (10, "Twice"), (None, "alone"), (None, "alone"),
]


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(fold(t), []).append(i)
    out, seen = [], set()
    for i, t in rows:
        own = groups[fold(t)]
        keep = max((x for x in own if x is not None), default=None)
        first = (i, fold(t)) not in seen
        seen.add((i, fold(t)))
        out.append((i, keep, len(own), i == keep and first, hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force(docs):
    assert found(exact_dedup.exact_copies(docs(*ROWS))) == expected(ROWS)


def test_texts_that_share_a_digest_are_told_apart_by_content(docs):
    def weak(text):
        return F.unhex(F.hex(F.length(text) % 3))

    assert found(exact_dedup.exact_copies(docs(*ROWS), digest=weak)) == expected(ROWS)
    kept = exact_dedup.keep_last(docs(*ROWS), digest=weak)
    assert sorted(fold(r.text) for r in kept.collect()) == sorted({fold(t) for _, t in ROWS})


def test_a_third_of_all_rows_are_copies(docs):
    rows = [(i, "Hot text" if i % 3 == 0 else f"text {i}") for i in range(600)]
    assert found(exact_dedup.exact_copies(docs(*rows, partitions=5), salts=4)) == expected(rows)


def test_one_row_of_each_text_stays_with_its_columns(docs):
    table = docs(*ROWS)
    kept = exact_dedup.keep_last(table)
    assert kept.schema == table.schema
    by_text = {fold(r.text): r.doc_id for r in kept.collect()}
    assert kept.count() == len(by_text) == len({fold(t) for _, t in ROWS})
    assert by_text["same"] == 2 and by_text["twice"] == 10 and by_text[fold(LONG)] == 9


def test_empty_table(docs):
    empty = docs((1, "x")).limit(0)
    assert found(exact_dedup.exact_copies(empty)) == []
    assert exact_dedup.keep_last(empty).collect() == []


def test_runs_without_python_on_the_executors(docs, capsys):
    exact_dedup.exact_copies(docs(*ROWS)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
