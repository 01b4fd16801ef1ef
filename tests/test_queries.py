"""Every registered query against its SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from foliozone.checks.oracles import ORACLES
from foliozone.checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(autouse=True, scope="module")
def generated_code(spark):
    """Queries run as they do outside the tests, with code generation."""
    usual = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {key: spark.conf.get(key) for key in usual}
    for key, value in usual.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_core_queries_load_where_corpus_operators_do_not():
    code = "import sys; sys.modules['foliozone.llm'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES) and sorted(e.oracle_sql()) == sorted(e.ORACLES))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(contract.__file__).parent)
    assert done.stdout.strip() == "True", done.stderr


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    outcome = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert outcome.startswith("ok ") and "types differ" not in outcome, outcome
