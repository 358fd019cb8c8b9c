"""Every query against its SQL on DuckDB."""

import pytest

import compare
from tidemark.plans import oracles, registry


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracles.RESULTS)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_matches_sql(spark, tiny, name):
    got = compare.from_spark(registry.QUERIES[name](spark, tiny))
    want = compare.from_duck(compare.duck(tiny), oracles.oracle(name))
    assert compare.difference(got, want) is None


def test_entry(spark):
    import __spark_entry__ as entry
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["wallet"] == "0xm00000006"
