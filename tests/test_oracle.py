"""Every query against its SQL on the given tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, oracle_rows, spark_rows

from flightrank.plans.catalog import QUERIES
from flightrank.plans.oracles import ORACLES
from flightrank.session import shared_base

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_only_the_search_on_a_likelihood_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"lognormal_fit"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    columns, found = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(db, ORACLES[name])
    assert columns == expected_columns
    assert len(found) == len(expected)
    assert found == expected
    assert found, "an empty result proves nothing"


def test_lognormal_fit_gives_one_row(spark):
    [row] = QUERIES["lognormal_fit"](spark, SF_DIR).collect()
    assert row.n_tail > 0 and 0 <= row.p_value <= 1


def test_the_rest_works_without_the_training_data_package(tmp_path):
    """A copy of the repository without ``llm`` and the pipeline still registers its own queries."""
    root = Path(__file__).resolve().parents[1]
    ignored = shutil.ignore_patterns("llm", ".git", "spark-warehouse", "__pycache__")
    shutil.copytree(root / "flightrank", tmp_path / "flightrank", ignore=ignored)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], run.stderr


@pytest.mark.parametrize("absent", ["public_tokenizers", "tokenizers"])
def test_the_rest_works_without_a_library_of_the_training_data_package(absent):
    root = Path(__file__).resolve().parents[1]
    code = f"import sys; sys.modules['{absent}'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert int(run.stdout) in (len(QUERIES), len(QUERIES) + 14), run.stderr


class Fake:
    """A session with these settings, as far as the shared folder asks for them."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, *rest: conf.get(key, rest and rest[0]))})


def test_a_cluster_gets_no_folder_of_one_machine():
    own, shared = "file:/home/me/spark-warehouse", "hdfs://store/warehouse"
    conf = "spark.sql.warehouse.dir"
    assert shared_base(Fake("local[8]", **{conf: own})).startswith(own)
    assert shared_base(Fake("yarn", **{conf: shared})).startswith(shared)
    assert shared_base(Fake("yarn", **{conf: own, "spark.checkpoint.dir": "s3://b/c/"})) == "s3://b/c"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_base(Fake(master, **{conf: own}))


def test_no_other_module_imports_the_training_data_package():
    root = Path(__file__).resolve().parents[1] / "flightrank"
    outside = [p for p in root.rglob("*.py") if "llm" not in p.parts]
    assert outside and not [p for p in outside if "flightrank.llm" in p.read_text()]
