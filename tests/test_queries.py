"""Every registered query against its SQL twin, and the driver contract."""

import pytest

import __spark_entry__ as entry
import check_queries
from instrel.plans import catalog, oracle


@pytest.fixture(scope="module")
def connection(sf):
    return check_queries.oracle_connection(sf)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, sf, connection, name):
    assert check_queries.compare(spark, connection, name, sf) == ""


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.ORACLE)
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_label_classes(spark):
    rows = {r["label_class"]: r["count"] for r in entry.entry(spark).collect()}
    assert rows["overall"] == rows["positive"] + rows["negative"] > 0
