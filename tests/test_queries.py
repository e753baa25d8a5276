"""Every registered query against its SQL in DuckDB."""

import pathlib
import sys

import pytest

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parent)]

import __spark_entry__ as entry
from oracle import compare
from roomledger.plans.queries import QUERIES, SQL


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, name):
    _, _, problem = compare(spark, QUERIES[name], SQL[name], sf)
    assert problem is None, problem
