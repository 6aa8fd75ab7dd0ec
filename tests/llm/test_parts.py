import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flightrank.llm import parts

TEXTS = ["", "a b a", " a", "a  b", "x\0 y", "a \n b", "a ", "b a b"]


@given(st.lists(st.text(alphabet="ab \0\n", max_size=12), max_size=8))
@settings(max_examples=200, deadline=None)
def test_parts_make_up_their_texts(texts):
    different, codes, starts = parts.numbered_parts(texts, parts.before_spaces)
    assert len(set(different)) == len(different)
    found = ["".join(different[c] for c in codes[a:b]) for a, b in zip(starts, starts[1:])]
    assert found == texts
    lengths = parts.sums([len(p) for p in different], codes, starts)
    assert lengths.tolist() == [len(t) for t in texts]
    assert parts.joined([p.encode() for p in different], codes, starts) == [t.encode() for t in texts]


@pytest.mark.parametrize(
    "text, cut", [("a b", ["a", " b"]), ("a  b", ["a ", " b"]), (" a", ["", " a"]), ("a \n b ", ["a \n", " b "])]
)
def test_cuts(text, cut):
    assert parts.before_spaces(text).split(parts.BREAK) == cut


def test_no_texts():
    different, codes, starts = parts.numbered_parts([], parts.before_spaces)
    assert (different, len(codes)) == ([], 0)
    assert parts.sums([], codes, starts).tolist() == [] and parts.joined([], codes, starts) == []
    assert isinstance(codes, np.ndarray)
