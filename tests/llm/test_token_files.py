import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flightrank.llm import token_files
from flightrank.session import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def some_rows():
    rng = random.Random(6)
    words = ["the", "é", "<|endoftext|>", " ", "\n", "don't", "123", "漢字", "x" * 90]
    rows = [(i * 7 % 1009, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(200)]
    return rows + [(2000, None), (2001, ""), (None, "no id"), (-5, "before all"), (3000, "long " * 60_000)]


def test_files_read_back(docs, spark):
    rows = some_rows()
    folder = shared_folder(spark, "test-tokens")
    manifest = token_files.write_token_files(docs(*rows), PATH, folder).orderBy("part").collect()
    found = token_files.read_token_files(spark, folder).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected(rows)
    bases = np.cumsum([0, *(m.n_ids for m in manifest)])
    assert [m.base for m in manifest] == bases[:-1].tolist()


def test_files_are_flat_and_can_be_mapped(docs, spark):
    rows = some_rows()
    folder = shared_folder(spark, "test-tokens")
    ids, offsets, ends = [], [], []
    for m in token_files.write_token_files(docs(*rows), PATH, folder).orderBy("part").collect():
        name = f"{folder}/part-{m.part:06d}"
        own = np.memmap(f"{name}.ids", "<u2", "r")
        cut = np.fromfile(f"{name}.offsets", "<i8")
        assert m.width == 2 and len(own) == m.n_ids == cut[-1] and len(cut) == m.n_docs + 1
        ids.append(np.asarray(own))
        offsets += (cut[:-1] + m.base).tolist()
        ends += [own[e - 1] for e in cut[1:]]
    flat = np.concatenate(ids).tolist()
    want = [x for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for x in [*LIBRARY.encode(t or "").ids, 0]]
    assert flat == want and set(ends) == {0}
    assert offsets == [r[1] for r in expected(rows)]


def test_writing_again_replaces_the_files(docs, spark):
    folder = shared_folder(spark, "test-tokens")
    for _ in range(2):
        token_files.write_token_files(docs(*some_rows()), PATH, folder)
    found = token_files.read_token_files(spark, folder).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected(some_rows())


def test_documents_with_one_id(docs, spark):
    rows = [(1, f"text {i % 4}") for i in range(60)] + [(0, "a"), (2, "b")]
    folder = shared_folder(spark, "test-tokens")
    token_files.write_token_files(docs(*rows), PATH, folder)
    found = sorted(map(tuple, token_files.read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [0] + [1] * 60 + [2]
    starts = np.cumsum([0, *(r[2] for r in found)])
    assert [r[1] for r in found] == starts[:-1].tolist()
    assert sorted(r[3] for r in found) == sorted(r[3] for r in expected(rows))


def test_empty_table(docs, spark):
    folder = shared_folder(spark, "test-tokens")
    token_files.write_token_files(docs((1, "x")).limit(0), PATH, folder)
    assert token_files.read_token_files(spark, folder).collect() == []


def test_counts_are_those_of_the_files(docs):
    rows = some_rows()
    found = token_files.count_ids(docs(*rows), PATH).collect()
    expected = [(i, len(LIBRARY.encode(t or "").ids)) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("text", ["word. word, wörd! 1. é.", "a\0b c", "a  b", " a", "a ", "a \n b", "<|endoftext|> <|endoftext|>", "", " ", "a　b \x85 c"])
def test_cutting_at_spaces_changes_no_id(text):
    [found] = token_files.Encoder(PATH).encode([text])
    assert np.frombuffer(found, "<u2").tolist() == LIBRARY.encode(text).ids
