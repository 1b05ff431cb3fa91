"""Every registered query against its SQL, on whole tables."""

import re

import pytest

import __spark_entry__ as entry
from compare import differences

# The training-data queries are tested in tests/llm.
QUERIES = {k: v for k, v in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, name):
    assert differences(QUERIES[name](spark, data), data, SQL[name]) == []


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_a_wrong_result_is_noticed(spark, data):
    wrong = QUERIES["year_report_cc_first"](spark, data)
    assert differences(wrong, data, SQL["year_report_cc_lag2"])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
