"""Every query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entries
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entries.queries()
ORACLES = entries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    columns, _, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, _, expected = sql_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_flagship(spark):
    row = entries.entry(spark).first()
    assert row["eval_rows"] > 0 and 0 <= row["roc_auc"] <= 1
