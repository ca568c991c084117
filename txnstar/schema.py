"""Names, types and default parameters of the data model.

Nothing here touches Spark's runtime: these are the column lists that every
other module is written against.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Column names, date patterns and thresholds that decide results. They are part
# of the data contract with the producers and consumers of the tables.
RAW_COLUMNS = [
    "TransactionID",
    "AccountID",
    "TransactionAmount",
    "TransactionDate",
    "TransactionType",
    "Location",
    "DeviceID",
    "IP Address",
    "MerchantID",
    "Channel",
    "CustomerAge",
    "CustomerOccupation",
    "TransactionDuration",
    "LoginAttempts",
    "AccountBalance",
]
REQUIRED_COLUMNS = ["TransactionID", "AccountID", "TransactionAmount", "TransactionDate"]
DATE_FORMATS = [
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
]
# Raw (or looked-up) column -> star column, in table order.
ACCOUNT_COLUMNS = {
    "AccountID": "account_id",
    "CustomerAge": "customer_age",
    "CustomerOccupation": "occupation",
    "AccountBalance": "account_balance",
}
MERCHANT_COLUMNS = {
    "MerchantID": "merchant_id",
    "Location": "location",
    "Channel": "channel",
}
FACT_COLUMNS = {
    "TransactionID": "transaction_id",
    "AccountID": "account_id",
    "MerchantID": "merchant_id",
    "date_id": "date_id",
    "type_id": "type_id",
    "TransactionAmount": "amount",
    "AccountBalance": "balance",
    "TransactionDuration": "duration_seconds",
    "LoginAttempts": "login_attempts",
    "DeviceID": "device_id",
    "IP Address": "ip_address",
    "TransactionDate": "transaction_date",
    "is_suspicious": "is_suspicious",
}
SUSPICIOUS_AMOUNT = 10000
SUSPICIOUS_LOGINS = 3
# --- End of fixed values ----------------------------------------------------

DOUBLE_COLUMNS = ["TransactionAmount", "AccountBalance"]
INTEGER_COLUMNS = ["CustomerAge", "TransactionDuration", "LoginAttempts"]

# Columns the raw zone adds to a row. They say where a row came from, so they are
# never part of what makes two rows equal.
INGEST_DATE = "ingest_date"
LINEAGE_COLUMNS = [INGEST_DATE]


def text_schema(columns: list[str]) -> T.StructType:
    """All columns as text: a value reaches the cleaning steps as it was written."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


RAW_SCHEMA = text_schema(RAW_COLUMNS)
RAW_ZONE_SCHEMA = text_schema(RAW_COLUMNS).add(INGEST_DATE, T.DateType())

STAR_SCHEMAS = {
    "dim_date": T.StructType()
    .add("date", T.DateType())
    .add("year", T.IntegerType())
    .add("month", T.IntegerType())
    .add("day", T.IntegerType())
    .add("day_of_week", T.IntegerType())
    .add("day_name", T.StringType())
    .add("month_name", T.StringType())
    .add("quarter", T.IntegerType())
    .add("date_id", T.LongType()),
    "dim_account": T.StructType()
    .add("account_id", T.StringType())
    .add("customer_age", T.IntegerType())
    .add("occupation", T.StringType())
    .add("account_balance", T.DoubleType()),
    "dim_merchant": T.StructType()
    .add("merchant_id", T.StringType())
    .add("location", T.StringType())
    .add("channel", T.StringType()),
    "dim_transaction_type": T.StructType()
    .add("transaction_type", T.StringType())
    .add("type_id", T.LongType()),
    "fact_transactions": T.StructType()
    .add("transaction_id", T.StringType())
    .add("account_id", T.StringType())
    .add("merchant_id", T.StringType())
    .add("date_id", T.LongType())
    .add("type_id", T.LongType())
    .add("amount", T.DoubleType())
    .add("balance", T.DoubleType())
    .add("duration_seconds", T.IntegerType())
    .add("login_attempts", T.IntegerType())
    .add("device_id", T.StringType())
    .add("ip_address", T.StringType())
    .add("transaction_date", T.TimestampNTZType())
    .add("is_suspicious", T.BooleanType()),
}
STAR_TABLES = list(STAR_SCHEMAS)

# Staged beside the star: deduplicated, typed rows, unparsable dates still in.
STANDARD_TABLE = "standard_transactions"


def warehouse_schema(table: str) -> T.StructType:
    """Warehouse form of a star table: upper-case names, timestamps as text."""
    out = T.StructType()
    for field in STAR_SCHEMAS[table]:
        is_timestamp = isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))
        out.add(field.name.upper(), T.StringType() if is_timestamp else field.dataType)
    return out
