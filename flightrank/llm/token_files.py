"""Token ids as flat binary files.

Documents are range-partitioned and sorted by ``doc_id``, and each partition
writes its own files:

``part-N.ids``
    ids of all its documents, end to end, as little-endian unsigned integers of
    16 bits if every id of the vocabulary fits, else of 32
``part-N.offsets``
    signed 64-bit: where each document starts in ``part-N.ids``, in ids, and the end
``part-N.docs``
    signed 64-bit: the document's id; then, a byte each, whether it has one

A partition's base, the ids of all documents before it, is the prefix sum over
the partitions, kept in the manifest (Parquet, in the same folder), so a
document starts at base plus offset. A task writes under a name of its own and
then renames, and a part always holds the same bytes, so a task may run twice.
Readers map the files into memory.

Defined results: null is the empty text, which has the end id alone; a null id
sorts first; documents with one id are in the order of their texts; an empty
table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import array
import functools
import json
import os
import sys
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightrank.llm.parts import before_spaces, joined, numbered_parts, sums
from flightrank.llm.shipping import ship
from flightrank.llm.token_counts import byte_letters

END_ID = 0
KNOWN = 300_000
KNOWN_LENGTH = 64
TEXTS = 4096  # encoded at once
SIGNS = ".,;:!?"


def _is_word(part: str) -> bool:
    """Whether a part is letters, after a space or not, which the vocabulary's split leaves whole.

    Only scripts whose letters have been settled for long are looked at.
    """
    letters = part[1:] if part[:1] == " " else part
    return letters.isalpha() and (letters.isascii() or max(letters) < "\u0530")


class Encoder:
    """Whole texts to ids with the tokenizers library.

    A piece of a text starts at every space that something else follows, so a text
    may be cut there, and a word ends before a sign. The library encodes each such
    part once; the ids of short parts are kept, a bounded number of them.
    """

    def __init__(self, vocabulary: str, keep: int = KNOWN, only_count: bool = False):
        """``only_count``: keep how many ids a part has, not the ids."""
        self.keep, self.only_count = keep, only_count
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        largest = max(self.library.get_vocab().values())
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        special = self.library.get_added_tokens_decoder().values()
        self.cuts = not any(" " in t.content or t.lstrip or t.rstrip for t in special)
        rules = json.loads(self.library.to_str())
        split = rules["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True)
        # Whether the library's model may be given a word itself, spelt as the file spells bytes.
        self.plain = plain and not split.get("add_prefix_space") and not rules["normalizer"]
        self.spelling = str.maketrans({chr(b): letter for letter, b in byte_letters().items()})
        self.signs = dict(zip(SIGNS, self._bytes(list(SIGNS))))
        self.known: dict[str, bytes | int] = {}
        self.older: dict[str, bytes | int] = {}

    def _packed(self, ids: list[int]) -> bytes | int:
        if self.only_count:
            return len(ids)
        packed = array.array("H" if self.kind.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _bytes(self, texts: list[str]) -> Iterator[bytes | int]:
        for found in self.library.encode_batch_fast(texts, add_special_tokens=False):
            yield self._packed(found.ids)

    def _words(self, words: list[str]) -> Iterator[bytes | int]:
        tokenize, spelling, space = self.library.model.tokenize, self.spelling, self.spelling[32]
        for word in words:
            if word.isascii() and word[0] == " ":
                spelt = space + word[1:]
            else:
                spelt = word.encode().decode("latin-1").translate(spelling)
            yield self._packed([token.id for token in tokenize(spelt)])

    def _learn(self, parts: list[str]) -> None:
        """Make the ids of these parts known, which are not."""
        if len(self.known) > self.keep:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        signed, words, others = [], [], []
        for part in parts:
            found = older.get(part)
            if found is not None:
                known[part] = found
            elif not self.plain:
                others.append(part)
            elif _is_word(part):
                words.append(part)
            elif part[-1:] in self.signs and _is_word(part[:-1]):
                signed.append(part)
            else:
                others.append(part)
        known.update(zip(others, self._bytes(others)))
        known.update(zip(words, self._words(words)))
        bare = list({part[:-1] for part in signed} - known.keys())
        known.update(zip(bare, map(older.get, bare)))
        new = [word for word in bare if known[word] is None]
        known.update(zip(new, self._words(new)))
        for part in signed:
            known[part] = known[part[:-1]] + self.signs[part[-1]]

    def _known(self, different: list[str]) -> list[bytes | int]:
        """The ids of the different parts of some texts; those of long parts are not kept."""
        found = list(map(self.known.get, different))
        missing = [i for i, ids in enumerate(found) if ids is None]
        self._learn([different[i] for i in missing])
        for i in missing:
            part = different[i]
            found[i] = self.known[part]
            if len(part) > KNOWN_LENGTH:
                del self.known[part]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        if not self.cuts:
            return list(self._bytes(texts))
        different, codes, starts = numbered_parts(texts, before_spaces)
        return joined(self._known(different), codes, starts)

    def counts(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has, for ``only_count``."""
        if not self.cuts:
            return np.array(list(self._bytes(texts)), np.int64)
        different, codes, starts = numbered_parts(texts, before_spaces)
        return sums(self._known(different), codes, starts)


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


@functools.lru_cache(maxsize=1)
def id_counter(vocabulary: str) -> Encoder:
    """Smaller than an encoder: counting shares its workers with other stages."""
    return Encoder(vocabulary, KNOWN // 2, only_count=True)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    place = urlparse(folder)
    if place.scheme in ("", "file"):
        return fs.LocalFileSystem(), place.path
    return fs.FileSystem.from_uri(folder)


def _save(files: fs.FileSystem, path: str, chunks: Iterator[bytes]) -> None:
    own = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        for chunk in chunks:
            out.write(chunk)
    files.move(own, path)


def _load(files: fs.FileSystem, path: str, kind: np.dtype) -> np.ndarray:
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with files.open_input_file(path) as source:
        return np.frombuffer(source.readall(), kind)


def count_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens`` per row of ``docs``: how many ids the files hold of it, the end id
    not counted."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = id_counter(vocabulary).counts
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS // 2):
                rows = batch.slice(at, TEXTS // 2)
                found = counts(rows.column(1).fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(found, pa.int64())], ["doc_id", "n_tokens"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long")


def write_token_files(docs: DataFrame, vocabulary: str, folder: str) -> DataFrame:
    """Write the files and return the manifest: ``part n_docs n_ids width base first_doc``."""
    spark = docs.sparkSession
    ship(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        files, base = _opened(folder)
        name = f"{base}/part-{TaskContext.get().partitionId():06d}"
        files.create_dir(base)
        ids: list[int] = []
        has_id: list[bool] = []
        lengths: list[int] = []

        end = np.array([END_ID], encode.kind).tobytes()

        def chunks() -> Iterator[bytes]:
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    texts = batch.column(1).slice(at, TEXTS).fill_null("").to_pylist()
                    for found in encode.encode(texts):
                        lengths.append(len(found) // encode.kind.itemsize + 1)
                        yield found + end
                ids.extend(batch.column(0).fill_null(0).to_pylist())
                has_id.extend(batch.column(0).is_valid().to_pylist())

        _save(files, f"{name}.ids", chunks())
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype="<i8")]).astype("<i8")
        _save(files, f"{name}.offsets", iter([offsets.tobytes()]))
        _save(files, f"{name}.docs", iter([np.array(ids, "<i8").tobytes(), np.array(has_id, "u1").tobytes()]))
        row = (TaskContext.get().partitionId(), len(ids), int(offsets[-1]), encode.kind.itemsize)
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in row], ["part", "n_docs", "n_ids", "width"]
        )

    # The hash splits documents that share an id, if there are many.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    written = ordered.mapInArrow(write, "part long, n_docs long, n_ids long, width long")
    written.write.mode("overwrite").parquet(f"{folder}/written")
    # One short row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{folder}/written").filter("n_docs > 0").select(
        "*",
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("first_doc"),
    )
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document, from the files: ``doc_id start n_tokens ids_crc32``."""
    ship(spark)
    manifest = spark.read.parquet(f"{folder}/manifest")
    parts = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = _opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name, n = f"{place}/part-{row['part']:06d}", row["n_docs"]
                ids = _load(files, f"{name}.ids", np.dtype(f"<u{row['width']}"))
                offsets = _load(files, f"{name}.offsets", np.dtype("<i8"))
                both = _load(files, f"{name}.docs", np.dtype("u1"))
                doc_ids, has_id = both[: 8 * n].view("<i8"), both[8 * n :]
                for at in range(0, n, 4096):
                    cut = offsets[at : min(at + 4096, n) + 1]
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cut, cut[1:])]
                    own = slice(at, at + len(sums))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[own], pa.int64(), mask=has_id[own] == 0),
                            pa.array(cut[:-1] + row["base"], pa.int64()),
                            pa.array(np.diff(cut), pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # One task per file; a keyless repartition of the manifest's rows deals them evenly.
    return manifest.repartition(parts).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
