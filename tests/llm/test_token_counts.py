import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flightrank.llm import recent, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = token_counts.Counter(PATH)
PARTS = ["<|endoftext|>", " ", "  ", "\n", "a", "'s", "'ll", "1", "é", " ", "　", "\x1c", "\x85", "!", " word", "\t"]


def library_count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    assert COUNTER.counts([text]).tolist() == [library_count(text)]


@given(st.lists(st.sampled_from(PARTS), max_size=20).map("".join))
@settings(max_examples=300, deadline=None)
def test_spaces_and_special_strings(text):
    assert COUNTER.counts([text]).tolist() == [library_count(text)]


@pytest.mark.parametrize("text", ["x" * 20_000, "ab" * 9_000 + " " + "é" * 500, " " * 3_000, "word " * 20_000])
def test_very_long_texts(text):
    assert COUNTER.counts([text]).tolist() == [library_count(text)]


def test_merges_by_rank_not_by_place():
    def merges(piece, *pairs):
        return token_counts.merges_made(piece, token_counts.merge_ranks(list(pairs)))

    assert merges(b"abc", (b"b", b"c"), (b"a", b"b"), (b"a", b"bc")) == 2
    assert merges(b"abc", (b"a", b"b"), (b"b", b"c"), (b"a", b"bc")) == 1
    assert merges(b"abab", (b"a", b"b")) == 2
    assert merges(b"aaaaa", (b"a", b"a")) == 2
    assert merges(b"aaaa", (b"a", b"a"), (b"aa", b"aa")) == 3
    assert merges(b"a", (b"a", b"a")) == 0


def test_table(docs):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices(PARTS, k=12))) for i in range(50)] + [(50, None), (51, ""), (None, "é"), (3, "x"), (3, "x")]
    found = token_counts.count_tokens(docs(*rows), PATH).collect()
    expected = [(i, len((t or "").encode()), library_count(t or "")) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert token_counts.count_tokens(docs((1, "a")).limit(0), PATH).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_recent_results_are_bounded():
    made = []
    known = recent.Recent(lambda k: made.append(k) or k * 2, size=3, longest=4)
    assert [known[k] for k in ("a", "b", "c", "a", "d", "a")] == ["aa", "bb", "cc", "aa", "dd", "aa"]
    assert made == ["a", "b", "c", "d"]
    for i in range(50):
        known[f"{i}"], known["too long"]
    assert len(known) + len(known.older) <= 6 and "too long" not in known


def test_every_character_is_of_the_kind_that_the_library_has_for_it():
    """Before an ending, after a digit and after a space."""
    texts = []
    for start in range(0, 0x110000, 512):
        chars = [chr(i) for i in range(start, start + 512) if not 0xD800 <= i < 0xE000]
        texts.append("\n".join(f"{c}'s 1{c} {c}" for c in chars))
    expected = [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert COUNTER.counts(texts).tolist() == expected


def test_kinds_that_differ_either_way():
    own = token_counts._kinds()
    moved = {"L": own["L"].replace("q", "") + "!", "N": own["N"], "": own[""].replace("!", "") + "q"}
    found = token_counts.library_kinds(moved)
    assert found["L", ""].endswith("!") and found["", "L"] == "q"


def test_columns_of_the_input_with_names_of_the_result(spark, docs):
    table = docs((1, "some text"), (None, None)).withColumnRenamed("digest", "n_tokens")
    rows = token_counts.count_tokens(table, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == [(0, 0, 0), (1, 9, 2)]
