"""Every registered query against its SQL twin, and the driver's contract."""

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with duck(SF) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, connection, name):
    assert spark_rows(entry.queries()[name](spark, SF)) == duck_rows(connection, entry.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert "attributed_campaign" in frame.columns
