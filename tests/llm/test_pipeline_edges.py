"""The whole pipeline on tables with nulls, repeated rows, long texts, columns of clashing names, and on none."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

pipeline = pytest.importorskip("corpus_pipeline")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, length int"
LABELS = "doc_id long, quality int, toxic int"


def run(spark, folder, rows, labels):
    full = [(d, t, None, "s", None, 5, 0.5, 9) for d, t in rows]
    spark.createDataFrame(full, DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return pipeline.run(spark, str(folder))


def words(n, start=0):
    return " ".join(f"word{start + i}" for i in range(n))


def test_nulls_repeats_ties_and_very_long_texts(spark, tmp_path):
    rows = [(1, words(50)), (1, words(50)), (2, words(50).upper()), (3, None), (4, ""), (None, words(40, 500)),
            (5, words(30_000, 1000)), (6, "x" * 100_000), (7, words(60, 90_000)), (7, words(60, 90_000))]
    labels = [(1, 1, 0), (5, 1, 0), (99, 0, 1), (None, 0, 1), (7, None, None)]
    packed = run(spark, tmp_path, rows, labels).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {}
    for r in packed:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    stays = {2: words(50).upper(), 4: "", None: words(40, 500), 5: words(30_000, 1000), 6: "x" * 100_000,
             7: words(60, 90_000)}
    assert tokens == {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in stays.items()}


def test_no_documents_and_no_labels(spark, tmp_path):
    assert run(spark, tmp_path / "none", [], []).collect() == []
    left = run(spark, tmp_path / "unlabelled", [(1, words(30)), (2, words(30, 400))], []).collect()
    assert {r.doc_id for r in left} == {1, 2}


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    run(spark, tmp_path, [(1, words(30)), (2, words(30, 400))], [(1, 1, 0)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.schema.names == [c.split()[0] for c in DOCUMENTS.split(", ")]
