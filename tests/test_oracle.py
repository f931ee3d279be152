"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from skyledger.plans.oracle import ORACLE
from skyledger.plans.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    differs = compare(spark, db, QUERIES[name], ORACLE[name], SF_DIR)
    assert not differs, differs


def test_entry(spark):
    assert contract.entry(spark).count() > 0
