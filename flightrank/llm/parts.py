"""Texts cut into parts that a tokenizer treats alike wherever they are.

A batch of texts is cut and its parts are numbered in one pass over the bytes,
so that each different part of a batch is looked at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BREAK = "\x00"  # marks the cuts; a text that holds it is one part

_SPACE_BEFORE_SPACE = re.compile(r" \s| $")
_CUT = re.compile(r" (?=\S)")


def before_spaces(text: str) -> str:
    """``text`` with a break before every space that no other space follows."""
    if _SPACE_BEFORE_SPACE.search(text):
        return _CUT.sub(f"{BREAK} ", text)
    return text.replace(" ", f"{BREAK} ")


def numbered_parts(
    texts: list[str], marked: Callable[[str], str]
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different parts of some texts, their numbers in order, and where each text's start.

    ``marked`` puts breaks into a text without one.
    """
    broken = pa.array([t if BREAK in t else marked(t) for t in texts], pa.large_string())
    cut = pc.split_pattern(broken, BREAK)
    whole = [i for i, t in enumerate(texts) if BREAK in t]
    if whole:
        lists = cut.to_pylist()
        for i in whole:
            lists[i] = [texts[i]]
        cut = pa.array(lists, cut.type)
    parts = cut.flatten().dictionary_encode()
    codes = parts.indices.to_numpy(zero_copy_only=False)
    return parts.dictionary.to_pylist(), codes, cut.offsets.to_numpy()


def sums(of_part: list[int], codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each text the sum over its parts."""
    each = np.asarray(of_part, np.int64)[codes] if len(codes) else np.empty(0, np.int64)
    total = np.concatenate([[0], np.cumsum(each)])
    return total[starts[1:]] - total[starts[:-1]]


def joined(of_part: list[bytes], codes: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Of each text the bytes of its parts, end to end."""
    each = pa.array(of_part, pa.large_binary()).take(pa.array(codes, pa.int64()))
    of_text = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), each)
    return pc.binary_join(of_text, pa.scalar(b"", pa.large_binary())).to_pylist()
