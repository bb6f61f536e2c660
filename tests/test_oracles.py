"""Every registered query against its SQL, over the whole smallest tables."""

import pytest

import __spark_entry__ as entry
from sightline import plans
from tools import check_oracle

SF_DIR = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    return check_oracle.duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "entity", "capture_time", "last_captured"]


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    rows = entry.queries()[name](spark, SF_DIR)
    assert check_oracle.difference(duck, entry.oracle_sql()[name], rows) is None
