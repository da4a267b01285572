"""Every registered query beside its SQL."""

from __future__ import annotations

import pytest
from oracle_check import compare, duck

import __spark_entry__ as registered
from candlewick.oracle import ORACLE
from candlewick.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_same_keys():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    message, rows = compare(QUERIES[name](spark, SF), connection, ORACLE[name])
    assert not message, message
    assert rows > 0


def test_entry(spark):
    streams = registered.entry(spark)
    assert streams.count() == 378
    assert streams.select("symbol", "stream_no").distinct().count() == 77
