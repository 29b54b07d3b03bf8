"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "CSQ" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF, [name], verbose=False) == []
