import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp long, SCORE int"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(*rows, partitions=3):
        full = [(i, t, None, "src", None, "x", 7, None) for i, t in rows]
        return spark.createDataFrame(full, EXTRA).repartition(partitions)

    return make
