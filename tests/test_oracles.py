"""Every registered query against its SQL on the same tables, types included."""

from __future__ import annotations

import os

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as contract
from tests.helpers import SF, SF_SMALL
from txnstar.plans.oracles import ORACLES as LIBRARY_ORACLES
from txnstar.plans.queries import QUERIES as LIBRARY_QUERIES

TABLES = ["orders", "customer", "nation"]
QUERIES = LIBRARY_QUERIES
ORACLES = LIBRARY_ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    ours = QUERIES[name](spark, SF).toArrow()
    expected = duck.execute(ORACLES[name]).to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(ours.column_names) == columns
    ours, expected = ours.select(columns), expected.select(columns)
    plain = {pa.large_string(): pa.string()}
    for field_a, field_b in zip(ours.schema, expected.schema):
        a, b = plain.get(field_a.type, field_a.type), plain.get(field_b.type, field_b.type)
        assert a == b, field_a.name
    assert ours.num_rows == expected.num_rows
    for left, right in [("ours", "expected"), ("expected", "ours")]:
        con = duckdb.connect()
        con.register("ours", ours)
        con.register("expected", expected)
        extra = con.execute(f"SELECT count(*) FROM (FROM {left} EXCEPT ALL FROM {right})")
        assert extra.fetchone()[0] == 0
        con.close()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1321
    assert os.path.isdir(SF_SMALL)
