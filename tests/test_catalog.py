"""Every registered query against its SQL oracle on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as entry_points
from millrace import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_the_driver_gets_every_query():
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


def test_entry_without_the_training_data_operators(tmp_path):
    """The library and the entry point work where the optional package is absent."""
    root = Path(entry_points.__file__).parent
    hidden = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(root / "millrace", tmp_path / "millrace", ignore=hidden)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.stdout.strip() == str(len(QUERIES)), run.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    rows, problem = differences(spark, connection, SF_DIR, QUERIES[name], ORACLES[name])
    assert rows > 0
    assert not problem


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["word", "n"]
