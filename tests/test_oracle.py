"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import ast
import inspect
from collections import Counter

import pytest

import __spark_entry__ as contract
from harness import compare as harness
from harness import queries, telemetry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return harness.connect(SF)


@pytest.mark.parametrize("module", [queries, telemetry])
def test_no_name_is_bound_twice(module):
    names = Counter()
    for node in ast.parse(inspect.getsource(module)).body:
        if isinstance(node, (ast.FunctionDef, ast.ClassDef)):
            names[node.name] += 1
        elif isinstance(node, ast.Assign):
            names.update(t.id for t in node.targets if isinstance(t, ast.Name))
    assert [n for n, times in names.items() if times > 1] == []


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.count() > 0 and "health_score_pct" in df.columns


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    equal, note = harness.compare(spark, con, SF, name)
    assert equal, note
