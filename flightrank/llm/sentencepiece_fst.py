"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is compiled from a model file and composed with each input:

* the normaliser's arcs put the space mark before a text and write it for each space;
* the lexicon's arcs read a piece's letters and write the piece;
* the byte arcs read a letter that is no piece and write one byte piece per byte.

The encoding is the shortest path in the tropical semiring (sums along a path,
the least of all paths). In a unigram model an arc weighs the piece's negative
log-probability. In a byte-pair model every arc weighs nothing and the weight
lies on the junction of two pieces: nothing if merging the letters of both gives
just these two, else infinite. A text's byte-pair encoding is the only path all
of whose junctions are free, so no weight per piece is needed, which could not
express the order of merges.

Where no piece spans two letters the text may be cut, and the paths of parts that
came before are kept, a bounded number of them.

Defined results: null is the empty text, which has no pieces; rows that repeat
are each encoded; ids that are no pieces are left out when decoding, as are
control pieces; bytes that are no UTF-8 decode to the replacement character; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import codecs
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flightrank.llm.parts import BREAK, joined, numbered_parts
from flightrank.llm.recent import Recent
from flightrank.llm.shipping import ship

SPACE = "▁"  # fixed value: the mark that stands for a space
JUNCTIONS = 400_000
TEXTS = 1024  # encoded at once
UNKNOWN_PENALTY = 10.0  # fixed value: what an unknown letter costs beyond the rarest piece

# Kinds of pieces and of models in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2

_RUN = re.compile(f"{SPACE}+")

# While decoding, bytes are letters of a private plane that no piece holds.
_BYTE_MARK = 0x10FE00
_END_OF_BYTES = chr(_BYTE_MARK + 256)
_BYTES = re.compile(f"[{chr(_BYTE_MARK)}-{chr(_BYTE_MARK + 255)}]+")

codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class Transducer:
    """Compiled from a model file."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError(f"{model_file}: its normaliser rewrites more than spaces")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError(f"{model_file}: neither a unigram nor a byte-pair model")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.unigram = model.trainer_spec.model_type == UNIGRAM
        self.names = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        self.special = np.array([k in (BYTE, CONTROL) for k in self.kinds])
        self.texts = [" ⁇ " if i == self.unknown else n for i, n in enumerate(self.names)]
        self.byte = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, self.kinds)) if k == BYTE}
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {i: p.score for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.unknown_weight = UNKNOWN_PENALTY - min(self.score.values())
        self.pieces = normal
        # The lexicon as a tree: a state is its arcs by letter and whether a piece ends there.
        self.lexicon: list = [{}, False]
        for name in normal:
            state = self.lexicon
            for letter in name:
                state = state[0].setdefault(letter, [{}, False])
            state[1] = True
        spanned = {name[k : k + 2] for name in normal for k in range(len(name) - 1)}
        self.spanned = spanned
        self.cuts = not any(pair[0] != SPACE and pair[1] == SPACE for pair in spanned)
        self.junctions: dict[tuple[str, str], bool] = {}
        self.whole = {name: True for name in normal if len(name) == 1}
        self.segments = Recent(self._segment, 350_000)
        self.parts = Recent(self._ids, 350_000)

    # Weights

    def _merged(self, letters: str) -> list[str]:
        """Byte-pair merging by score, leftmost first; for the few letters of two pieces."""
        parts = list(letters)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                piece = self.pieces.get(parts[k] + parts[k + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def free(self, left: str, right: str) -> bool:
        """Whether the junction of two neighbours weighs nothing."""
        found = self.junctions.get((left, right))
        if found is None:
            if len(self.junctions) > JUNCTIONS:
                self.junctions.clear()
            found = self.junctions[left, right] = self._merged(left + right) == [left, right]
        return found

    def _starts(self, piece: str) -> bool:
        """Whether a piece may come first: whether merging its own letters gives it."""
        found = self.whole.get(piece)
        if found is None:
            found = self.whole[piece] = self._merged(piece) == [piece]
        return found

    # Composition and shortest path

    def _ends(self, text: str, start: int) -> list[int]:
        """Where the arcs from a state end, the nearest first."""
        state, ends = self.lexicon, []
        for end in range(start, len(text)):
            state = state[0].get(text[end])
            if state is None:
                break
            if state[1]:
                ends.append(end + 1)
        if not ends or ends[0] != start + 1:
            ends.insert(0, start + 1)  # the byte arcs of a single letter
        return ends

    def _lightest(self, text: str) -> list[str]:
        """The shortest path by weights of pieces, as the letters that each arc reads."""
        weight = [0.0] + [float("inf")] * len(text)
        came = [0] * (len(text) + 1)
        for start in range(len(text)):
            for end in self._ends(text, start):
                piece = self.pieces.get(text[start:end])
                own = self.unknown_weight if piece is None else -self.score[piece]
                if weight[start] + own < weight[end]:
                    weight[end], came[end] = weight[start] + own, start
        path, end = [], len(text)
        while end:
            path.append(text[came[end] : end])
            end = came[end]
        return path[::-1]

    def _free_path(self, text: str) -> list[str]:
        """The path all of whose junctions weigh nothing, as the letters that each arc reads.

        All finite paths weigh the same, so the first one found is the shortest:
        depth first, the longest arc first. An arc from which the end cannot be
        reached is not tried again, so a text takes at most one try per pair of
        neighbouring arcs.
        """
        path: list[str] = []
        starts, todo, dead = [0], [self._ends(text, 0)], set()
        while starts[-1] < len(text):
            start = starts[-1]
            while todo[-1]:
                end = todo[-1].pop()
                piece = text[start:end]
                if (start, end) not in dead and (
                    self.free(path[-1], piece) if path else len(piece) == 1 or self._starts(piece)
                ):
                    path.append(piece)
                    starts.append(end)
                    todo.append(self._ends(text, end) if end < len(text) else [])
                    break
            else:
                if not path:
                    return self._merged(text)  # no model whose pieces come from merging gets here
                dead.add((starts[-2], start))
                for held in (path, starts, todo):
                    held.pop()
        return path

    def _path(self, text: str) -> list[str]:
        """The shortest path over one part of a text."""
        return self._lightest(text) if self.unigram else self._free_path(text)

    def _segment(self, segment: str) -> bytes:
        """The ids of the shortest path over a segment, as little-endian 32-bit integers."""
        found: list[int] = []
        for piece in self._path(segment):
            own = self.pieces.get(piece)
            if own is not None:
                found.append(own)
            elif self.byte:
                found += [self.byte[b] for b in piece.encode("utf-8", "replace")]
            else:
                found.append(self.unknown)
        return np.array(found, "<i4").tobytes()

    def _ids(self, part: str) -> bytes:
        """The ids of a part of a normalised text, cut where no piece spans two letters."""
        spanned = self.spanned
        cuts = [0, *(k for k in range(1, len(part)) if part[k - 1 : k + 1] not in spanned), len(part)]
        return b"".join([self.segments[part[a:b]] for a, b in zip(cuts, cuts[1:])])

    def _marked(self, normal: str) -> str:
        """A normalised text with a break before every run of space marks but the first."""
        if SPACE * 2 in normal:
            return _RUN.sub(lambda run: f"{BREAK}{run[0]}" if run.start() else run[0], normal)
        return normal[:1] + normal[1:].replace(SPACE, BREAK + SPACE)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        normal = [self.prefix + t.replace(" ", SPACE) if t else "" for t in texts]
        if self.cuts:
            different, codes, starts = numbered_parts(normal, self._marked)
            found = joined(list(map(self.parts.__getitem__, different)), codes, starts)
        else:
            found = map(self._ids, normal)
        return [np.frombuffer(ids, "<i4") for ids in found]

    # The transducer read the other way

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids."""
        known = ids[(ids >= 0) & (ids < len(self.names))]
        out: list[str] = []
        at = 0
        # The places of byte and control pieces cut the sequence; what lies between is only joined.
        for place in [*np.flatnonzero(self.special[known]).tolist(), len(known)]:
            if place > at:
                out += map(self.texts.__getitem__, known[at:place].tolist())
            if place < len(known):
                out.append(self._byte_mark(int(known[place])))
            at = place + 1
        text = _BYTES.sub(lambda run: bytes(ord(c) - _BYTE_MARK for c in run[0]).decode("utf-8", "each_byte"), "".join(out))
        text = text.replace(_END_OF_BYTES, "")
        if self.prefix and text.startswith(self.prefix):
            text = text[len(self.prefix) :]
        return text.replace(SPACE, " ")

    def _byte_mark(self, i: int) -> str:
        """A byte piece as a letter of a private range; a control piece ends a run of bytes."""
        return chr(_BYTE_MARK + int(self.names[i][3:5], 16)) if self.kinds[i] == BYTE else _END_OF_BYTES


@functools.lru_cache(maxsize=2)
def transducer(model_file: str) -> Transducer:
    return Transducer(model_file)


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """A row per row of ``docs``: ``doc_id ids``. ``model_file``: the same on every executor."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = transducer(model_file).encode
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                rows = batch.slice(at, TEXTS)
                found = encode(rows.column(1).fill_null("").to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                values = np.concatenate([*found, np.empty(0, "<i4")])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """A row per row of ``docs``: ``doc_id n_pieces ids_crc32 decoded_crc32``, of the ids, as
    little-endian 32-bit integers, and of the text that they decode to, in UTF-8.

    Encodes and decodes in one task, so the ids and texts need not leave it.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                rows = batch.slice(at, TEXTS)
                all_ids = machine.encode(rows.column(1).fill_null("").to_pylist())
                decoded = [zlib.crc32(machine.decode(ids).encode()) for ids in all_ids]
                columns = (
                    [len(ids) for ids in all_ids],
                    [zlib.crc32(ids.tobytes()) for ids in all_ids],
                    decoded,
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                    ["doc_id", "n_pieces", "ids_crc32", "decoded_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pieces long, ids_crc32 long, decoded_crc32 long"
    )


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """A row per row of ``encoded``: ``doc_id n_pieces ids_crc32 text``."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = transducer(model_file).decode
        for batch in batches:
            all_ids = [np.array(x.values if x.is_valid else [], "<i4") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in all_ids], pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in all_ids], pa.int64()),
                    pa.array([decode(x) for x in all_ids], pa.string()),
                ],
                ["doc_id", "n_pieces", "ids_crc32", "text"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, n_pieces long, ids_crc32 long, text string"
    )
