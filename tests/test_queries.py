"""Every registered query against its SQL, on whole tables at the smallest scale."""

import pytest

import check
from tidemark.plans.registry import load

QUERIES = load()


@pytest.fixture(scope="module")
def con(sf):
    return check.database(sf)


def test_every_query_has_a_callable_and_most_have_sql():
    assert len(QUERIES) > 150
    assert sum(q.sql is not None for q in QUERIES.values()) >= len(QUERIES) - 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, sf, name):
    q = QUERIES[name]
    ok, message, rows, _ = check.compare(spark, con, name, q.run, q.sql, sf)
    assert ok, message
    assert rows > 0


def test_entry(spark):
    from __spark_entry__ import entry

    out = entry(spark)
    assert out.columns == ["stt", "edt", "cur_date", "province_id", "order_count", "order_amount", "province_name"]
    assert out.count() > 0
