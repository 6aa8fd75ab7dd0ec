"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Fingerprints that differ in at most ``MAX_BITS``
= 4 bits differ in at most four bytes, so they share at least four positional
bytes: the guaranteed minimum. A list per single (position, byte) would hold
1/256 of all fingerprints, so a posting names three positions with their bytes.
Of the 56 such triples the 20 of ``TRIPLES`` meet every set of four positions,
so each linked pair shares a posting. Within a posting the shared positional
bytes are tallied, pairs below the minimum go, and the rest is verified bit by bit.

A posting list gives the links of a spanning forest, not all its pairs. A list
of more than ``LIST_ROWS`` fingerprints is not compared pairwise at all: its
members that lie within two bits of a common centre are within four bits of
each other, and each pair within four bits has such a centre, so members are
grouped by centre and linked to the smallest. Both ways are exact.

Defined results: null is the empty text, whose fingerprint is zero and is linked
like any other; a null ``doc_id`` is never the smallest; a component of null ids
alone has a null id; repeated rows are linked; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightrank.llm.components import components
from flightrank.llm.shipping import ship
from flightrank.llm.text import fresh_name, schema_with
from flightrank.session import written_once

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LIST_ROWS = 512
PIECE = 1 << 15  # shingles whose bits are counted at once

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _triples() -> list[tuple[int, int, int]]:
    """Triples of byte positions such that any four positions hold one of them.

    The positions are dealt to three classes in a ring; a triple is taken if it
    lies in one class, or has two positions in one class and one in the next.
    """
    ring = [i % 3 for i in range(8)]

    def taken(triple: tuple[int, ...]) -> bool:
        c = sorted(ring[i] for i in triple)
        if c[0] == c[2]:
            return True
        if len(set(c)) == 3:
            return False
        two, one = c[1], c[0] + c[1] + c[2] - 2 * c[1]
        return one == (two + 1) % 3

    return [t for t in combinations(range(8), 3) if taken(t)]


TRIPLES = _triples()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text, as a signed number."""
    words = _WORD.findall((text or "").encode("utf-8", "replace").translate(_LOWER))
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + PIECE], stops[at : at + PIECE])],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    over = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(over.view("<i8")[0])


def with_fingerprints(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each text in the column ``name``."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints, pa.int64())], [*batch.schema.names, name]
            )

    return docs.mapInArrow(add, schema_with(docs, name, T.LongType()))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per fingerprint and triple: the triple's number and its three bytes in one key."""
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
        parts = prints.view(np.uint8).reshape(-1, 8).astype(np.int32)
        keys = [
            (k << 24) | (parts[:, a] << 16) | (parts[:, b] << 8) | parts[:, c]
            for k, (a, b, c) in enumerate(TRIPLES)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys)), pa.array(np.tile(prints, len(TRIPLES)))], ["key", "fp"]
        )


def linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of two arrays' fingerprints are linked: the tally of shared bytes, then the bits."""
    apart = a[:, None] ^ b[None, :]
    shared = (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(2)
    row, col = np.nonzero(shared >= 8 - max_bits)
    near = np.bitwise_count(apart[row, col].view(np.uint64)) <= max_bits
    out = np.zeros(apart.shape, bool)
    out[row[near], col[near]] = True
    return out


def _forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join what is linked within one list: at most one per fingerprint."""
    near = linked(prints, prints, max_bits)
    if near.sum() == len(prints):
        return []
    left, links = np.ones(len(prints), bool), []
    for start in range(len(prints)):
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front:
            at = front.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            links += [(int(prints[at]), int(prints[i])) for i in new]
            front += new.tolist()
    return links


def _within_lists(max_bits: int, list_rows: int):
    """Rows sorted by key to links; of a list beyond ``list_rows`` the members, with a null partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(a: list, b: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        key, held, long = None, np.empty(0, np.int64), False

        def close() -> list[tuple[int, int]]:
            return [] if long or len(held) < 2 else _forest(held, max_bits)

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            prints = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, stops = np.r_[0, cuts], np.r_[cuts, len(keys)]
            a: list[int] = []
            b: list[int | None] = []
            for start, stop in zip(starts.tolist(), stops.tolist()):
                if keys[start] != key:
                    for x, y in close():
                        a.append(x)
                        b.append(y)
                    key, held, long = keys[start], np.empty(0, np.int64), False
                if stop - start == 1 and stop < len(keys) and not len(held) and not long:
                    continue  # alone in its list
                held = np.concatenate([held, prints[start:stop]])
                if long or len(held) > list_rows:
                    a += held.tolist()
                    b += [None] * len(held)
                    held, long = held[:0], True
            yield table(a, b)
        rest = close()
        yield table([x for x, _ in rest], [y for _, y in rest])

    return run


def _centres(max_bits: int):
    """Each fingerprint with every centre within half of ``max_bits`` bits."""
    reach = max_bits // 2
    masks = [0]
    for n in range(1, reach + 1):
        masks += [sum(1 << i for i in c) for c in combinations(range(64), n)]
    flips = np.array(masks, np.uint64).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 64):
                some = prints[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((some[:, None] ^ flips[None, :]).ravel()), pa.array(np.repeat(some, len(flips)))],
                    ["centre", "fp"],
                )

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, list_rows: int = LIST_ROWS) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints ``fp`` that join all that are linked."""
    if max_bits != 4:
        raise ValueError("the triples are chosen for four differing bits")
    ship(prints.sparkSession)
    lists = prints.select("fp").mapInArrow(_postings, "key int, fp long").repartition("key")
    met = written_once(
        lists.sortWithinPartitions("key").mapInArrow(
            _within_lists(max_bits, list_rows), "a long, b long"
        ),
        "met",
    )
    pairs = met.filter("b is not null")
    crowded = met.filter("b is null").select(F.col("a").alias("fp")).distinct()
    # At most 1 + 64 + 2016 fingerprints lie around a centre, so the set is bounded.
    around = (
        crowded.mapInArrow(_centres(max_bits), "centre long, fp long")
        .groupBy("centre")
        .agg(F.collect_set("fp").alias("near"))
        .filter(F.size("near") > 1)
    )
    stars = around.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
    return pairs.unionByName(stars.filter("a <> b")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, fp`` (signed), ``component_id`` and ``root``, the
    component's smallest fingerprint."""
    texts = docs.select("doc_id", "text")
    prints = written_once(with_fingerprints(texts, "fp", shingle).drop("text"), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(distinct, max_bits, list_rows))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    places = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return prints.join(places, "fp").select("doc_id", "fp", "component_id", "root")


def hex_digits(fp: str):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per group, the one with the smallest ``doc_id``, with its columns as they are.

    Fingerprints are made anew instead of shuffling them with the texts, so that a
    repeated ``doc_id`` with another text is told apart.
    """
    found = near_duplicates(docs, shingle, max_bits)
    first = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id")
        .agg(F.min("fp").alias("fp"))
        .select("doc_id", "fp")
    )
    name, again = fresh_name("fp", docs.columns), fresh_name("again", docs.columns)
    rows = with_fingerprints(docs, name, shingle)
    meet = rows["doc_id"].eqNullSafe(first["doc_id"]) & (rows[name] == first["fp"])
    order = Window.partitionBy("doc_id", name).orderBy("text")
    return (
        rows.join(first, meet, "left_semi")
        .withColumn(again, F.row_number().over(order))
        .filter(F.col(again) == 1)
        .select(*docs.columns)
    )
