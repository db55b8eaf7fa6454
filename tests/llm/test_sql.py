"""Registered queries against their SQL, over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, spark_result, sql_result

from tallyweave.llm.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    columns, expected = sql_result(connect(sf_dir), ORACLE[name])
    assert spark_result(QUERIES[name](spark, sf_dir)) == (columns, expected) and expected
