from __future__ import annotations

from pyspark.sql import DataFrame

from txnstar.schema import RAW_COLUMNS, RAW_SCHEMA

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"

DEFAULTS = {
    "TransactionID": "T1",
    "AccountID": "A1",
    "TransactionAmount": "10.5",
    "TransactionDate": "2023-04-11",
    "TransactionType": "Debit",
    "Location": "Cairo",
    "DeviceID": "D1",
    "IP Address": "10.0.0.1",
    "MerchantID": "M1",
    "Channel": "ATM",
    "CustomerAge": "30",
    "CustomerOccupation": "Doctor",
    "TransactionDuration": "60",
    "LoginAttempts": "1",
    "AccountBalance": "100.25",
}


def raw_rows(spark, *overrides: dict) -> DataFrame:
    """Raw rows that differ from ``DEFAULTS`` as each dict says."""
    rows = [tuple({**DEFAULTS, **o}[c] for c in RAW_COLUMNS) for o in overrides]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def sorted_rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
