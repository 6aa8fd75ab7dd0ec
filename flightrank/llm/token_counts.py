"""Token counts by byte-pair merging over a heap and a linked list.

A piece of text starts as its bytes. The adjacent pair of lowest rank is popped
from the heap, the leftmost of equals first, and merged, until no pair has a
rank. The count is the bytes less the merges; no identifiers are made. A piece
of n bytes takes n log n steps, however long it is.

A special string inside a text is one token. A text is cut before every space
that no other space follows, since a piece always starts there. Each different
part of a batch is counted once, and the counts of parts and pieces seen lately
are kept, a bounded number of them.

Which characters are letters and numbers is asked of the tokenizer library, whose
version of Unicode is another than that of the module that splits.

Defined results: null is the empty text, of no bytes and no tokens; a null id
stays; rows that repeat are each counted; other columns of the input are not
used; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from flightrank.llm.parts import before_spaces, numbered_parts, sums
from flightrank.llm.recent import Recent
from flightrank.llm.shipping import ship

LIMIT = 512
TEXTS = 8192  # counted at once

# Fixed value: how a byte-level vocabulary of this kind splits a text before merging,
# with its classes of letters and numbers to be put in.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+"
KINDS = ("L", "N")  # letters and numbers


def _kinds() -> dict[str, str]:
    """All characters but white space, as this module's tables class them; the rest at ``""``."""
    every = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    found = {k: "".join(regex.findall(rf"\p{{{k}}}", every)) for k in KINDS}
    return found | {"": "".join(regex.findall(r"[^\s\p{L}\p{N}]", every))}


def library_kinds(own: dict[str, str]) -> dict[tuple[str, str], str]:
    """The characters that the tokenizer library classes otherwise: by our kind and by its kind.

    Its tables are of another version of Unicode. It puts neighbours of one kind into
    one piece, so a few calls tell the kinds of all characters.
    """
    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str

    def kind(c: str) -> str:
        for name, one in zip(KINDS, "x1"):
            if len(split(one + c)) == 1:
                return name
        return ""

    otherwise: dict[tuple[str, str], str] = {}
    for name, chars in own.items():
        for _, (start, end) in split(chars):
            theirs = kind(chars[start])
            if theirs != name:
                key = (name, theirs)
                otherwise[key] = otherwise.get(key, "") + chars[start:end]
    return otherwise


def _ranges(chars: str) -> str:
    """Characters as the ranges of a set of a pattern."""
    places = np.array([ord(c) for c in chars])
    cuts = np.flatnonzero(np.diff(places) != 1) + 1
    return "".join(rf"\U{run[0]:08x}-\U{run[-1]:08x}" for run in np.split(places, cuts))


@functools.lru_cache(maxsize=1)
def split_pattern() -> str:
    """``SPLIT`` with the classes that the library has; made once per process."""
    otherwise = library_kinds(_kinds())
    classes = {}
    for name in KINDS:
        less = "".join(chars for (ours, _), chars in otherwise.items() if ours == name)
        more = "".join(chars for (_, theirs), chars in otherwise.items() if theirs == name)
        own = rf"[\p{{{name}}}--[{_ranges(less)}]]" if less else rf"\p{{{name}}}"
        classes[name] = f"[{own}{_ranges(more)}]" if more else own
    return SPLIT.replace("{L}", classes["L"]).replace("{N}", classes["N"])


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such a vocabulary's file.

    Printable bytes stand for themselves, the others for letters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


Ranks = dict[int, tuple[int, int]]


def pair_key(left: int, right: int) -> int:
    return left << 32 | right


def merge_ranks(merges: list[tuple[bytes, bytes]]) -> Ranks:
    """Of each pair of symbols its rank and what it becomes; the first 256 symbols are the bytes."""
    symbols = {bytes([b]): b for b in range(256)}
    for left, right in merges:
        symbols.setdefault(left + right, len(symbols))
    return {
        pair_key(symbols[left], symbols[right]): (rank, symbols[left + right])
        for rank, (left, right) in enumerate(merges)
    }


def merges_made(piece: bytes, ranks: Ranks) -> int:
    """How many merges byte-pair encoding makes in a piece."""
    size = len(piece)
    parts = list(piece)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    found = ranks.get
    # An entry is rank * size + place, so the least is the lowest rank farthest left.
    heap = []
    for i in range(size - 1):
        pair = found(parts[i] << 32 | parts[i + 1])
        if pair is not None:
            heap.append(pair[0] * size + i)
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = divmod(heapq.heappop(heap), size)
        j = after[i]
        if j >= size or parts[i] < 0:
            continue
        pair = found(parts[i] << 32 | parts[j])
        if pair is None or pair[0] != rank:
            continue  # one of the two was merged meanwhile
        merges += 1
        merged = parts[i] = pair[1]
        parts[j] = -1
        j = after[i] = after[j]
        if j < size:
            before[j] = i
            pair = found(merged << 32 | parts[j])
            if pair is not None:
                heapq.heappush(heap, pair[0] * size + i)
        j = before[i]
        if j >= 0:
            pair = found(parts[j] << 32 | merged)
            if pair is not None:
                heapq.heappush(heap, pair[0] * size + j)
    return merges


class Counter:
    """Counts tokens for one vocabulary file."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            parts = json.load(file)
        model, split = parts["model"], parts["pre_tokenizer"]
        plain = {"prefix": bool(split.get("add_prefix_space")), "rules": parts["normalizer"]}
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or any(plain.values()):
            raise ValueError(f"{vocabulary}: not a plain byte-level vocabulary")
        letters = byte_letters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = merge_ranks([tuple(bytes(letters[c] for c in side) for side in pair) for pair in merges])
        special = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cuts = not any(" " in s for s in special)
        self.split = regex.compile(split_pattern(), regex.V1)
        self.pieces = Recent(self._piece, 400_000)
        self.known = Recent(self._part)

    def _piece(self, piece: str) -> int:
        data = piece.encode("utf-8", "replace")
        return len(data) - merges_made(data, self.ranks)

    def _part(self, text: str) -> int:
        plain = self.special.split(text) if self.special else [text]
        known = self.pieces
        return len(plain) - 1 + sum([known[p] for part in plain for p in self.split.findall(part)])

    def counts(self, texts: list[str]) -> np.ndarray:
        """The tokens of each text."""
        if not self.cuts:
            return np.array([self._part(t) for t in texts], np.int64)
        different, codes, starts = numbered_parts(texts, before_spaces)
        return sums(list(map(self.known.__getitem__, different)), codes, starts)


@functools.lru_cache(maxsize=2)
def counter(vocabulary: str) -> Counter:
    """One counter per worker and vocabulary, with what it knows."""
    return Counter(vocabulary)


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_bytes, n_tokens``.

    ``vocabulary``: path of the vocabulary's file, the same on every executor.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary).counts
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                rows = batch.slice(at, TEXTS)
                found = counts(rows.column(2).fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(found, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", size, "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
