"""Every query against its SQL, over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, spark_result, sql_result

from tallyweave.plans.catalog import QUERIES
from tallyweave.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    result = spark_result(QUERIES[name](spark, SF_DIR))
    assert result[1]
    if name in ORACLE:
        assert result == sql_result(con, ORACLE[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).columns == ["b1", "b2", "sim"]
