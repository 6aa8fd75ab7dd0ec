import random
import re

import numpy as np
import pytest
import xxhash

from flightrank.llm import components, simhash


def slow_print(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    size = min(shingle, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42)
        for i in range(len(words) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def slow_components(rows):
    """(doc_id, fingerprint) to the smallest id reachable, by comparing all with all."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if bin((a ^ rows[j][1]) & (2**64 - 1)).count("1") <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


TEXTS = [
    "", " \t\n", None, "one", "One two", "a b c d", "a b c d e f", "É é\x85x y z q", "x" * 50_000,
    "w " * 30_000, " ".join(f"w{i % 97}" for i in range(40_000)), "\x0b\x0c a\x1cb c d\x1f e",
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == signed(slow_print(text))


def near_texts(rng, n):
    words = [f"w{rng.randrange(4000)}" for _ in range(160)]
    out = []
    for _ in range(n):
        own = list(words)
        own[rng.randrange(160)] = f"z{rng.randrange(10_000)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("list_rows", [512, 3])
def test_equals_comparing_all_with_all(docs, list_rows):
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(near_texts(rng, 60) + near_texts(rng, 25))]
    rows += [(200 + i, f"plain {i} text number {i * 7} of many") for i in range(40)]
    rows += [(300, ""), (299, None), (None, ""), (None, "only without an id at all"), (5, rows[5][1])]
    found = simhash.near_duplicates(docs(*rows), list_rows=list_rows).collect()
    prints = [(d, slow_print(t)) for d, t in rows]
    expected = sorted(zip([d for d, _ in rows], slow_components(prints)), key=repr)
    assert sorted(((r.doc_id, r.component_id) for r in found), key=repr) == expected
    assert sorted(r.fp for r in found) == sorted(signed(p) for _, p in prints)


def test_every_pair_in_reach_is_linked(spark):
    """Random centres with neighbours at 1 to 4 bits, and pairs at 5 bits that must not be."""
    rng = random.Random(9)
    prints, near, far = set(), [], []
    for k in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 1 + k % 5):
            b ^= 1 << bit
        prints |= {a, b}
        (near if k % 5 < 4 else far).append((a, b))
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.links(table)).collect()}
    assert all(roots[signed(a)] == roots[signed(b)] for a, b in near)
    assert all(roots.get(signed(a), a) != roots.get(signed(b), b) for a, b in far)


def test_a_posting_list_tallies_before_it_verifies():
    a = np.array([0], np.int64)
    five_bytes_apart = np.array([sum(1 << (8 * i) for i in range(5))], np.int64)
    four_bits_apart = np.array([0b1111], np.int64)
    assert not simhash.linked(a, five_bytes_apart, 4)[0, 0]
    assert simhash.linked(a, four_bits_apart, 4)[0, 0]


def test_a_long_chain_has_one_root(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in components.components(edges).collect()}
    assert roots == {**dict.fromkeys(range(201), 0), 900: 900, 901: 900}


def test_one_document_of_each_group_stays(docs):
    texts = near_texts(random.Random(1), 20)
    rows = [(i + 3, t) for i, t in enumerate(texts)] + [(1, "something else"), (2, None), (2, None), (2, "other words here")]
    table = docs(*rows)
    kept = simhash.keep_first(table)
    assert kept.schema == table.schema
    groups = slow_components([(d, slow_print(t)) for d, t in rows])
    first = sorted({g for g in groups} | {2}) + [2]  # two texts of document 2 are groups of their own
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first)


def test_empty_table(docs):
    empty = docs((1, "x")).limit(0)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_first(empty).collect() == []
