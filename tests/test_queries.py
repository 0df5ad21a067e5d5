"""Each registered query of the library against its DuckDB SQL."""

from importlib import import_module

import pytest

import __spark_entry__ as entry
from tests.helpers import SF, assert_same, duck

OWN = {k: (f, m.ORACLES.get(k)) for m in (import_module(f"tallyspark.{x}") for x in entry.MODULES) for k, f in m.QUERIES.items()}


@pytest.mark.parametrize("name", OWN)
def test_query(spark, name):
    query, sql = OWN[name]
    if sql is None:
        assert query(spark, SF).toArrow().num_rows > 0  # compared with plain versions in test_rules
    else:
        assert_same(query(spark, SF), sql)


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert duck("SELECT count(*) AS n FROM orders")["n"][0].as_py() > 0
