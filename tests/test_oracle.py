"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"

# the smallest tables have too few pairs a month for a decision, and no station passes the size gate
MAY_BE_EMPTY = {"m10_retrain_candidates", "f8_keep_sized"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query(spark, con, name):
    assert oracle.check(spark, con, name, SF_DIR, name in MAY_BE_EMPTY) == ""


def test_entry(spark):
    assert driver.entry(spark).count() == 6


def test_twins_have_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())
