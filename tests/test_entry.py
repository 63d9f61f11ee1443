import pytest

import __spark_entry__ as entry
from textpack.plans import catalog
from tools import check

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_a_statement():
    assert set(catalog.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["block_id", "tokens"] and rows.count() > 0


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_same_as_sql(spark, con, name):
    assert check.differences(spark, con, FOLDER, name) == []
