"""Dimensions and fact: invariants, NULL members, reruns, session settings."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import SF_SMALL, raw_rows, sorted_rows
from txnstar import (
    build_dim_account,
    build_dim_date,
    build_dim_merchant,
    build_dim_transaction_type,
    build_fact,
    clean_transactions,
    read_staged,
    stage_star,
)
from txnstar.plans.fixture import raw_transactions
from txnstar.schema import STAR_SCHEMAS, STAR_TABLES
from txnstar.sources.workdir import fresh_dir


def _star(spark, raw):
    root = fresh_dir(spark, "test-star")
    stage_star(raw, root)
    return {name: read_staged(spark, root, name) for name in STAR_TABLES}


@pytest.fixture(scope="module")
def star(spark):
    return _star(spark, raw_transactions(spark, SF_SMALL))


@pytest.mark.parametrize("table", STAR_TABLES)
def test_schema(star, table):
    found = [(f.name, f.dataType) for f in star[table].schema]
    assert found == [(f.name, f.dataType) for f in STAR_SCHEMAS[table]]


def test_counts(star):
    assert {name: df.count() for name, df in star.items()} == {
        "dim_date": 1001,
        "dim_account": 150,
        "dim_merchant": 90,
        "dim_transaction_type": 3,
        "fact_transactions": 1321,
    }


@pytest.mark.parametrize(
    ("table", "key"),
    [
        ("dim_date", "date"),
        ("dim_date", "date_id"),
        ("dim_account", "account_id"),
        ("dim_merchant", "merchant_id"),
        ("dim_transaction_type", "transaction_type"),
        ("dim_transaction_type", "type_id"),
    ],
)
def test_keys_are_unique(star, table, key):
    assert star[table].select(key).distinct().count() == star[table].count()


@pytest.mark.parametrize(
    ("table", "key"),
    [
        ("dim_date", "date_id"),
        ("dim_account", "account_id"),
        ("dim_merchant", "merchant_id"),
        ("dim_transaction_type", "type_id"),
    ],
)
def test_fact_keys_are_in_the_written_dimension(star, table, key):
    fact = star["fact_transactions"].filter(F.col(key).isNotNull())
    assert fact.count() > 0
    assert fact.join(star[table], key, "left_anti").count() == 0


def test_fact_values(star):
    fact = star["fact_transactions"]
    found = fact.select(
        F.count_if(F.col("type_id").isNull()),
        F.count_if(F.col("date_id").isNull()),
        F.count_if(F.col("is_suspicious").isNull()),
        F.count_if(F.col("amount") < 0),
    ).first()
    assert tuple(found) == (193, 0, 0, 0)
    by_date = fact.join(star["dim_date"], "date_id")
    assert by_date.filter(F.to_date("transaction_date") != F.col("date")).count() == 0


@pytest.mark.parametrize("parts", [1, 37])
def test_same_star_whatever_the_partitioning(spark, star, parts):
    raw = raw_transactions(spark, SF_SMALL).orderBy(F.rand(parts)).repartition(parts)
    again = _star(spark, raw)
    for name in STAR_TABLES:
        assert sorted_rows(again[name]) == sorted_rows(star[name]), name


@pytest.mark.parametrize(
    ("key", "value"),
    [
        ("spark.sql.session.timeZone", "America/New_York"),
        ("spark.sql.ansi.enabled", "false"),
        ("spark.sql.adaptive.enabled", "false"),
        ("spark.sql.autoBroadcastJoinThreshold", "-1"),
        ("spark.sql.shuffle.partitions", "3"),
        ("spark.sql.codegen.wholeStage", "false"),
    ],
)
def test_same_star_whatever_the_session(spark, conf, star, key, value):
    expected = {name: sorted_rows(star[name]) for name in STAR_TABLES}
    conf(key, value)
    again = _star(spark, raw_transactions(spark, SF_SMALL))
    for name in STAR_TABLES:
        assert sorted_rows(again[name]) == expected[name], name


def test_same_star_beyond_the_broadcast_bound(spark, star):
    root = fresh_dir(spark, "test-star")
    stage_star(raw_transactions(spark, SF_SMALL), root, small_file_bytes=0)
    for name in STAR_TABLES:
        assert sorted_rows(read_staged(spark, root, name)) == sorted_rows(star[name]), name


def test_counts_are_those_of_the_written_tables(spark):
    root = fresh_dir(spark, "test-star")
    counts = stage_star(raw_transactions(spark, SF_SMALL), root)
    assert counts == {
        "raw": 1530,
        "deduplicated": 1500,
        "required": 1395,
        "clean": 1321,
        "null_dates": 74,
    } | {name: read_staged(spark, root, name).count() for name in STAR_TABLES}


def test_latest_transaction_speaks_for_account_and_merchant(spark):
    raw = raw_rows(
        spark,
        {"TransactionID": "T1", "TransactionDate": "2023-01-02", "AccountBalance": "1"},
        {"TransactionID": "T2", "TransactionDate": "1/3/2023", "AccountBalance": "2",
         "Location": "Giza", "Channel": "Branch"},
        {"TransactionID": "T0", "TransactionDate": "2023-01-03", "AccountBalance": "3"},
        {"TransactionID": "T9", "TransactionDate": "never", "AccountBalance": "4"},
    )
    clean = clean_transactions(raw)
    assert build_dim_account(clean).collect() == [("A1", 30, "Doctor", 2.0)]
    assert build_dim_merchant(clean).collect() == [("M1", "Giza", "Branch")]


def test_null_members(spark):
    raw = raw_rows(
        spark,
        {"TransactionID": "T1", "TransactionType": None, "MerchantID": None},
        {"TransactionID": "T2", "TransactionType": "Debit"},
        {"TransactionID": "T3", "TransactionType": "Credit"},
    )
    clean = clean_transactions(raw)
    types = build_dim_transaction_type(clean)
    assert sorted_rows(types) == sorted([("Credit", 1), ("Debit", 2), (None, 3)], key=repr)
    assert sorted_rows(build_dim_transaction_type(clean, drop_null_keys=True)) == [
        ("Credit", 1),
        ("Debit", 2),
    ]
    assert build_dim_merchant(clean).count() == 2
    assert build_dim_merchant(clean, drop_null_keys=True).count() == 1
    fact = build_fact(clean, build_dim_date(clean), types)
    ids = {r.transaction_id: r.type_id for r in fact.collect()}
    assert ids == {"T1": None, "T2": 2, "T3": 1}


def test_dim_date_row(spark):
    clean = clean_transactions(raw_rows(spark, {"TransactionDate": "2023-04-16 05:00:00"}))
    assert build_dim_date(clean).collect() == [
        (dt.date(2023, 4, 16), 2023, 4, 16, 1, "Sunday", "April", 2, 20230416)
    ]


def test_repeated_transaction_ids_stay(spark):
    """Rows that differ anywhere are different transactions, whatever their ID."""
    clean = clean_transactions(raw_rows(spark, {}, {"Channel": "Online"}, {"Channel": "Online"}))
    fact = build_fact(clean, build_dim_date(clean), build_dim_transaction_type(clean))
    assert fact.count() == 2
