"""Every registered query with SQL agrees with it on the smallest tables."""

import pytest
from compare import compare, connect

from tallyfold.plans import registry

registry.load_all()
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, duck, name):
    assert compare(registry.QUERIES[name](spark, SF_DIR), duck, registry.SQL[name]) == []


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 80
