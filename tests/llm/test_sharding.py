import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from flightrank.llm import sharding


def key(value):
    return int(hashlib.sha256(value.encode()).hexdigest()[:15], 16)


def slow(rows, shards, percent):
    """Every element in order, with the bytes before it."""
    size = {}
    own = [(key(t or ""), key("" if i is None else str(i)), len((t or "").encode()) + 8, i, t) for i, t in rows]
    total = sum(r[2] for r in own)
    groups = Counter()
    for h, _, n, _, _ in own:
        groups[h] += n
    for h, r, n, _, _ in own:
        e = (h, r if groups[h] * shards * 100 > total * percent else 0)
        size[e] = size.get(e, 0) + n
    before, shard = 0, {}
    for e in sorted(size):
        shard[e] = before * shards // total
        before += size[e]
    return sorted(
        ((i, t, shard[(h, r) if (h, r) in size and (h, 0) not in size else (h, 0)]) for h, r, _, i, t in own), key=repr
    )


def some_rows(n=400, hot=True, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(f"w{rng.randrange(999)}" for _ in range(rng.randint(0, 60)))) for i in range(n)]
    if hot:
        rows = [(i, "hot é text of a large group " * 4 if i % 3 == 0 else t) for i, t in rows]
    return rows + [(None, None), (None, "no id"), (7, None), (8, ""), (9, "x" * 3000), (9, "x" * 3000)]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("shards", [1, 5, 24])
def test_equals_sorting_everything(docs, hot, shards):
    rows = some_rows(hot=hot)
    found = sharding.shard_by_bytes(docs(*rows), shards, cell_bytes=2_000).collect()
    assert sorted(((r.doc_id, r.text, r.shard) for r in found), key=repr) == slow(rows, shards, 1)


def test_law_and_slots(docs):
    rows = some_rows(600)
    table = docs(*rows)
    out = sharding.shard_by_bytes(table, 24, cell_bytes=500)
    assert out.columns == [*table.columns, "size", "shard", "slot"]
    found = out.collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        assert r["size"] == len((r.text or "").encode()) + 8
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    mean = sum(sizes.values()) / 24
    largest = 2 * 3008  # two rows that repeat id and text stay together
    assert all(abs(n - mean) <= largest for n in sizes.values())


def test_small_groups_of_copies_stay_whole(docs):
    rows = [(i, f"copy of text {i // 3} " * 5) for i in range(900)]
    found = sharding.shard_by_bytes(docs(*rows), tolerance_percent=10).collect()
    shards = defaultdict(set)
    for r in found:
        shards[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    assert {r.shard for r in found} == set(range(24))


def test_probes_are_refined_until_one_element_is_left(spark):
    """Keys that agree in all but their last bits need every round."""
    rows = [((1 << 59) + i, 0, 10) for i in range(40)]
    keys = spark.createDataFrame(rows, "text_key long, id_key long, size long")
    assert sharding.splitters(keys, 4, 400, []) == [((1 << 59) + 10 * i, 0) for i in (1, 2, 3)]
    one = spark.createDataFrame([(5, (1 << 50) + i, 10) for i in range(40)], keys.schema)
    assert sharding.splitters(one, 4, 400, [5]) == [(5, (1 << 50) + 10 * i) for i in (1, 2, 3)]


def test_few_rows_empty_table_and_clashing_names(docs, spark):
    assert sharding.shard_by_bytes(docs((1, "a")).limit(0)).collect() == []
    [row] = sharding.shard_by_bytes(docs((1, "a"))).collect()
    assert (row.slot, 0 <= row.shard < 24) == (0, True)
    clash = docs((1, "a"), (2, "b")).withColumnsRenamed({"lang": "shard", "source": "SIZE", "digest": "cell"})
    out = sharding.shard_by_bytes(clash)
    assert out.columns == [*clash.columns, "_size", "_shard", "slot"] and out.count() == 2


def test_runs_without_python_on_the_executors(docs, capsys):
    sharding.shard_by_bytes(docs(*some_rows(30))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_crc_of_a_text_is_that_of_its_bytes(spark):
    row = spark.sql("SELECT crc32('é') AS c").first()
    assert row.c == zlib.crc32("é".encode())
