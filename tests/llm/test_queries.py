"""The package's queries on the given tables: against SQL, or else against a brute-force version."""

import importlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from compare import connect, oracle_rows, spark_rows
from test_simhash import slow_components, slow_print
from tokenizers import Tokenizer

from flightrank.llm import licenses
from flightrank.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TEXTS = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


def test_names():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    columns, found = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(connect(SF_DIR), ORACLES[name])
    assert columns == expected_columns and found == expected and found


def collected(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF_DIR).collect()))


def test_simhash_query(spark):
    prints = [(d, slow_print(t)) for d, t in TEXTS]
    expected = sorted((d, f"{p:016x}", c) for (d, p), c in zip(prints, slow_components(prints)))
    assert collected(spark, "op3_simhash_dedup") == expected


def test_token_file_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, expected = 0, []
    for d, t in TEXTS:
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert collected(spark, "op6_token_files") == expected


def test_sentencepiece_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = []
    for d, t in TEXTS:
        ids = library.encode(t)
        expected.append((d, len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()), zlib.crc32(library.decode(ids).encode())))
    assert collected(spark, "op7_sentencepiece") == expected


def test_token_count_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = [len(library.encode(t, add_special_tokens=False).ids) for _, t in TEXTS]
    expected = [(d, len(t.encode()), n, n > 512) for (d, t), n in zip(TEXTS, counts)]
    assert collected(spark, "op10_token_counts") == expected


def test_licence_query(spark):
    notices = {t: f for f, own in licenses.TEMPLATES.items() for t in own}
    expected = {
        (d, k): notices[line.strip()]
        for d, t in TEXTS
        for k, line in enumerate(t.split("\n"))
        if line.strip() in notices
    }
    found = QUERIES["op8_license_scan"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.paragraph): r.family for r in found} == expected and expected


def test_toxicity_query(spark):
    rows = QUERIES["op1_toxicity"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == [d for d, _ in TEXTS]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_packing_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = {}
    for r in QUERIES["op9_packing"](spark, SF_DIR).collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in TEXTS}


def test_pipeline_equals_a_brute_force_version(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = pipeline.drop_toxic(spark, docs, SF_DIR)
    assert clean.schema == docs.schema
    left = sorted((r.doc_id, r.text) for r in clean.collect())
    last = {}
    for d, t in left:
        last["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)] = (d, t)
    unique = sorted(last.values())
    groups = slow_components([(d, slow_print(t)) for d, t in unique])
    expected = {d for (d, _), g in zip(unique, groups) if d == g}
    packed = pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == expected
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in unique if d in expected}
    found = {}
    for r in packed:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == tokens
    assert [name for name, _ in importlib.import_module("corpus_pipeline").STAGES] == [
        "toxicity", "exact_dedup", "simhash_dedup", "packing"
    ]


def test_toxicity_query_tells_held_out_labels_apart(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = QUERIES["op1_toxicity"](spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    toxic, ordinary = (np.array([r.score for r in scored if r.toxic == t]) for t in (1, 0))
    auc = np.mean((toxic[:, None] > ordinary) + (toxic[:, None] == ordinary) / 2)
    assert auc >= 0.95 and np.mean(toxic >= 0.7) >= 0.8 and np.mean(ordinary >= 0.7) <= 0.01
