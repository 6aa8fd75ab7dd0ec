import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

from flightrank.llm import sentencepiece_fst as fst

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OURS = fst.Transducer(PATH)
PARTS = ["▁", " ", "  ", "\n", "aaaa", "hello", "world", "é", " ", "漢", "😀", "!!", "\t", "the ", "ing", "0", "12"]


@given(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    ids = LIBRARY.encode(text)
    assert OURS.encode([text])[0].tolist() == ids
    assert OURS.decode(np.array(ids, int)) == LIBRARY.decode(ids)


@given(st.lists(st.sampled_from(PARTS), max_size=20).map("".join))
@settings(max_examples=300, deadline=None)
def test_spaces_and_letters_without_a_piece(text):
    assert OURS.encode([text])[0].tolist() == LIBRARY.encode(text)


@given(st.lists(st.integers(0, 400) | st.integers(0, 31_999), max_size=12))
@settings(max_examples=300, deadline=None)
def test_decoding_any_ids(ids):
    assert OURS.decode(np.array(ids, int)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["a" * 3_000, "word " * 30_000, " " * 500 + "x", "ab漢" * 800])
def test_very_long_texts(text):
    assert OURS.encode([text])[0].tolist() == LIBRARY.encode(text)


def unigram_model(tmp_path):
    """A model with given pieces and weights; nothing is trained."""
    model = pb.ModelProto()
    model.trainer_spec.model_type = fst.UNIGRAM
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = True
    pieces = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -4.5, "ba": -5.0, "aba": -9.0, "▁ab": -6.5}
    model.pieces.add(piece="<unk>", type=fst.UNKNOWN)
    for piece, score in pieces.items():
        model.pieces.add(piece=piece, score=score, type=fst.NORMAL)
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path), pieces


def test_unigram_weights_give_the_shortest_path(tmp_path):
    path, pieces = unigram_model(tmp_path)
    ours = fst.Transducer(path)

    def cheapest(text):
        if not text:
            return 0.0
        return min(
            -pieces[text[:k]] + cheapest(text[k:]) for k in range(1, len(text) + 1) if text[:k] in pieces
        )

    for text in ["ab", "abab", "ba aba", "aaab b", "bbb"]:
        found = [ours.names[i] for i in ours.encode([text])[0]]
        normal = "▁" + text.replace(" ", "▁")
        assert "".join(found) == normal
        assert -sum(pieces[p] for p in found) == pytest.approx(cheapest(normal))


def test_junctions():
    assert OURS.free("▁t", "s") == (OURS._merged("▁ts") == ["▁t", "s"])
    assert not OURS.free("a", "n")


def test_table_round_trip(docs):
    rows = [(1, "Hello  world\n"), (2, None), (3, ""), (None, " x"), (4, "漢😀"), (4, "漢😀"), (5, "y " * 50_000)]
    encoded = fst.encode_documents(docs(*rows), PATH)
    back = fst.decode_documents(encoded, PATH)
    expected = [
        (i, len(ids := LIBRARY.encode(t or "")), zlib.crc32(np.array(ids, "<i4").tobytes()), t or "") for i, t in rows
    ]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(expected, key=repr)
    both = fst.round_trip(docs(*rows), PATH)
    expected = [(*r[:3], zlib.crc32(r[3].encode())) for r in expected]
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(expected, key=repr)
    assert fst.round_trip(docs((1, "a")).limit(0), PATH).collect() == []
    assert fst.encode_documents(docs((1, "a")).limit(0), PATH).collect() == []
