"""Every query that has SQL gives the SQL's rows; the others give rows."""

import pytest
from oracle import connect, same

from presswork import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()

#: Queries whose parameters were once outside the data; the smallest tables lack the pair of countries
#: that others ask for.
NEVER_EMPTY = {"claim_selection", "packed_export", "suffix_domains", "outbox_export", "download_index_stream", "worker_liveness_stream", "lease_requests", "structured_articles", "continuation_links", "manifest_objects"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, small, con, name):
    found = QUERIES[name](spark, small)
    same(con, found, SQL[name])
    assert name not in NEVER_EMPTY or found.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
