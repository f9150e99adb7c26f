"""Every registered query against its DuckDB oracle (row count, columns, values).

Runs at sf0.001 for speed; the driver repeats it at sf0.01
(``python tests/oracle_check.py`` does the same locally at any scale).
"""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from subledger.plans import registry

from conftest import SF001

# the training-data queries, where present, are checked in tests/llm
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, SF001, verbose=True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 21
    assert df.count() >= 0
