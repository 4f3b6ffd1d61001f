"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__
from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.run import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    verdict, _ = compare(spark, SF, name)
    assert verdict.startswith("same"), verdict


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 80
