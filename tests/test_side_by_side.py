"""Every registered query of the sales library against its SQL on the given tables."""

import pytest

from __spark_entry__ import entry
from side_by_side import connect, differences
from stallkeep.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.callables()) == set(catalog.check_sql())


@pytest.mark.parametrize("name", sorted(catalog.callables()))
def test_query(spark, connection, name):
    assert differences(catalog.run(name, spark, FOLDER), connection, catalog.check_sql()[name]) == []


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 11
    assert "OUTROS" in {r["product_category_name"] for r in rows}
