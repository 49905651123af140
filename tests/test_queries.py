"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402

from casewatch.plans import oracle, registry  # noqa: E402

STATEMENTS = oracle.statements()


@pytest.fixture(scope="module")
def connection(folder):
    return check_oracle.connect(folder)


def test_statements_belong_to_queries():
    assert set(STATEMENTS) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_sql(spark, connection, folder, name):
    assert check_oracle.compare(spark, connection, name, STATEMENTS[name], folder) == ""


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(STATEMENTS)))
def test_gives_rows(spark, folder, name):
    assert registry.QUERIES[name](spark, folder).count() > 0


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
