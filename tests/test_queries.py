"""Every registered query of the lakehouse against its SQL on the smallest test tables."""

import __spark_entry__ as registered
import compare
import pytest

from ledgerlake.oracles import ORACLES
from ledgerlake.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(registered.queries())
    assert set(ORACLES) <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, name):
    assert compare.spark_rows(QUERIES[name](spark, folder)) == compare.duck_rows(ORACLES[name], folder)


def test_entry(spark):
    assert registered.entry(spark).count() > 0
