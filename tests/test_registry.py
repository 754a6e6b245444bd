"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from episodica.plans.registry import REGISTRY
from tests.compare import differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_as_sql(spark, name):
    assert differences(entry.queries()[name], entry.oracle_sql()[name], spark, FOLDER) == []


def test_every_query_has_sql():
    assert REGISTRY.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    found = entry.entry(spark)
    assert len(found.columns) == 27 and found.count() > 0
