"""Every registered query next to its SQL, on the smallest tables."""

import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sql, name):
    count, extra, missing = differences(QUERIES[name](spark, SF_DIR), sql, ORACLES[name])
    assert not extra and not missing
    assert count > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    answers = entry.entry(spark)
    assert answers.columns == ["query_id", "query", "prompt", "result"]
    assert answers.count() == 40
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
