"""DuckDB SQL with the same results as ``plans.queries``, written independently of it."""

from __future__ import annotations

RAW = """
b AS (
 SELECT o.*, c.*, n.n_name, o_orderkey % 10 AS k10,
  o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS ts
 FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey),
t AS (
 SELECT
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
   ELSE concat('TX', lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) END AS TransactionID,
  concat('AC', lpad(CAST(o_custkey AS VARCHAR), 7, '0')) AS AccountID,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL
   ELSE concat(CASE WHEN o_orderkey % 5 = 0 THEN '-' ELSE '' END,
    CAST(CAST(floor(o_totalprice / 20) AS BIGINT) AS VARCHAR), '.',
    lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')) END AS TransactionAmount,
  CASE WHEN k10 < 3 THEN strftime(ts, '%-m/%-d/%Y %-H:%M')
   WHEN k10 = 3 THEN strftime(ts, '%-m/%-d/%Y')
   WHEN k10 = 4 THEN strftime(ts, '%m/%d/%Y %H:%M')
   WHEN k10 = 5 THEN strftime(ts, '%m/%d/%Y')
   WHEN k10 IN (6,7) THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
   WHEN k10 = 8 THEN strftime(ts, '%Y-%m-%d')
   WHEN o_orderkey % 20 = 9 THEN '13/45/2023' ELSE NULL END AS TransactionDate,
  CASE o_orderstatus WHEN 'F' THEN 'Debit' WHEN 'O' THEN 'Credit'
   ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Debit' END END AS TransactionType,
  n_name AS Location,
  concat('D', lpad(CAST(o_orderkey % 700 AS VARCHAR), 6, '0')) AS DeviceID,
  concat('10.0.', CAST(o_orderkey % 251 AS VARCHAR), '.',
   CAST(o_custkey % 251 AS VARCHAR)) AS "IP Address",
  concat('M', lpad(CAST(o_orderkey % 100 AS VARCHAR), 3, '0')) AS MerchantID,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'ATM' WHEN '2-HIGH' THEN 'Branch'
   ELSE 'Online' END AS Channel,
  CAST(18 + o_custkey % 63 AS VARCHAR) AS CustomerAge,
  c_mktsegment AS CustomerOccupation,
  CAST(10 + o_orderkey % 291 AS VARCHAR) AS TransactionDuration,
  CASE WHEN o_orderkey % 83 = 0 THEN 'n/a'
   ELSE CAST(1 + o_orderkey % 5 AS VARCHAR) END AS LoginAttempts,
  concat(CAST(CAST(floor(c_acctbal) AS BIGINT) + o_orderkey % 500 AS VARCHAR), '.',
   lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')) AS AccountBalance,
  o_orderkey AS _k
 FROM b),
raw AS (
 SELECT * EXCLUDE (_k) FROM t
 UNION ALL SELECT * EXCLUDE (_k) FROM t WHERE _k % 50 = 1)"""

_PARSED = (
    "try_strptime(TransactionDate,"
    " ['%m/%d/%Y %H:%M','%m/%d/%Y','%Y-%m-%d %H:%M:%S','%Y-%m-%d'])"
)
_AMOUNT = "abs(TRY_CAST(TransactionAmount AS DOUBLE))"
_REQUIRED = """TransactionID IS NOT NULL AND AccountID IS NOT NULL
 AND TransactionAmount IS NOT NULL AND TransactionDate IS NOT NULL"""


def _int(column: str) -> str:
    return f"CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INTEGER)"


_SUSPICIOUS = f"coalesce({_AMOUNT} > 10000 OR {_int('LoginAttempts')} > 3, false)"

_TYPED = f"""{_PARSED} AS TransactionDate, {_AMOUNT} AS TransactionAmount,
 TRY_CAST(AccountBalance AS DOUBLE) AS AccountBalance, {_int("CustomerAge")} AS CustomerAge,
 {_int("TransactionDuration")} AS TransactionDuration, {_int("LoginAttempts")} AS LoginAttempts"""

_CALENDAR = f"""CAST(year({_PARSED}) AS INTEGER) AS txn_year,
 CAST(month({_PARSED}) AS INTEGER) AS txn_month, CAST(day({_PARSED}) AS INTEGER) AS txn_day,
 CAST(hour({_PARSED}) AS INTEGER) AS txn_hour, CAST({_PARSED} AS DATE) AS txn_date"""

CLEAN = f"""{RAW},
required AS (SELECT DISTINCT * FROM raw WHERE {_REQUIRED}),
clean AS (
 SELECT * REPLACE ({_TYPED}), {_SUSPICIOUS} AS is_suspicious, {_CALENDAR}
 FROM required WHERE {_PARSED} IS NOT NULL)"""

_DIM_DATE = """SELECT DISTINCT txn_date AS date, txn_year AS year, txn_month AS month,
 txn_day AS day, CAST(dayofweek(txn_date) + 1 AS INTEGER) AS day_of_week,
 dayname(txn_date) AS day_name, monthname(txn_date) AS month_name,
 CAST(quarter(txn_date) AS INTEGER) AS quarter,
 CAST(strftime(txn_date, '%Y%m%d') AS BIGINT) AS date_id FROM clean"""

_DIM_ACCOUNT = """SELECT AccountID AS account_id, CustomerAge AS customer_age,
 CustomerOccupation AS occupation, AccountBalance AS account_balance FROM clean
QUALIFY row_number() OVER (PARTITION BY AccountID ORDER BY TransactionDate DESC,
 TransactionID DESC, CustomerAge DESC NULLS LAST, CustomerOccupation DESC NULLS LAST,
 AccountBalance DESC NULLS LAST) = 1"""

_DIM_MERCHANT = """SELECT MerchantID AS merchant_id, Location AS location, Channel AS channel
FROM clean QUALIFY row_number() OVER (PARTITION BY MerchantID ORDER BY TransactionDate DESC,
 TransactionID DESC, Location DESC NULLS LAST, Channel DESC NULLS LAST) = 1"""

_DIM_TYPE = """SELECT transaction_type,
 row_number() OVER (ORDER BY transaction_type ASC NULLS LAST) AS type_id
FROM (SELECT DISTINCT TransactionType AS transaction_type FROM clean)"""

STAR = f"""{CLEAN},
dim_date AS ({_DIM_DATE}),
dim_account AS ({_DIM_ACCOUNT}),
dim_merchant AS ({_DIM_MERCHANT}),
dim_transaction_type AS ({_DIM_TYPE}),
fact_transactions AS (
 SELECT TransactionID AS transaction_id, AccountID AS account_id, MerchantID AS merchant_id,
  d.date_id, y.type_id, TransactionAmount AS amount, AccountBalance AS balance,
  TransactionDuration AS duration_seconds, LoginAttempts AS login_attempts,
  DeviceID AS device_id, "IP Address" AS ip_address, TransactionDate AS transaction_date,
  is_suspicious
 FROM clean c LEFT JOIN dim_date d ON c.txn_date = d.date
  LEFT JOIN dim_transaction_type y ON c.TransactionType = y.transaction_type)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _star(table: str) -> str:
    return _with(STAR, f"SELECT * FROM {table}")


_RAW_ROWS = _with(RAW, "SELECT * FROM raw")

_FACT_LOADED = """SELECT transaction_id AS TRANSACTION_ID, account_id AS ACCOUNT_ID,
 merchant_id AS MERCHANT_ID, date_id AS DATE_ID, type_id AS TYPE_ID, amount AS AMOUNT,
 balance AS BALANCE, duration_seconds AS DURATION_SECONDS, login_attempts AS LOGIN_ATTEMPTS,
 device_id AS DEVICE_ID, ip_address AS IP_ADDRESS,
 strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS TRANSACTION_DATE,
 is_suspicious AS IS_SUSPICIOUS FROM fact_transactions"""

_TABLES = ["dim_date", "dim_account", "dim_merchant", "dim_transaction_type", "fact_transactions"]


def _loaded(table: str, columns: str) -> str:
    names = columns.split()
    return _with(STAR, f"SELECT {', '.join(f'{n} AS {n.upper()}' for n in names)} FROM {table}")


_STAGES = {
    "raw": "raw",
    "deduplicated": "(SELECT DISTINCT * FROM raw)",
    "required": "required",
    "clean": "clean",
}
_NULL_DATES = {"null_dates": f"(SELECT 1 FROM required WHERE {_PARSED} IS NULL)"}


def _counts(stages: dict[str, str]) -> str:
    stages = stages | {table: table for table in _TABLES}
    return "\nUNION ALL ".join(
        f"SELECT '{stage}' AS stage, count(*) AS row_count FROM {rows}"
        for stage, rows in stages.items()
    )


ORACLES = {
    "scan_raw_csv": _RAW_ROWS,
    "scan_quoted_csv": _with(
        RAW,
        """SELECT * REPLACE (
 concat('say "', DeviceID, '", ok, ', Location, '"') AS DeviceID) FROM raw""",
    ),
    "scan_broken_rows": _with(
        RAW,
        """SELECT TransactionID, LoginAttempts FROM raw
 UNION ALL SELECT 'broken', CAST(2 * count(*) AS VARCHAR) FROM raw""",
    ),
    "ingest_landing": _RAW_ROWS,
    "ingest_redelivered": _RAW_ROWS,
    "ingest_late_files": _RAW_ROWS,
    "ingest_archive": _RAW_ROWS,
    "ingest_bad_file": _RAW_ROWS,
    "ingest_many_files": _RAW_ROWS,
    "ingest_new_column": _with(
        RAW,
        """SELECT *, CASE WHEN CAST(right(AccountID, 1) AS INTEGER) % 2 = 1
 THEN concat('seen at ', Location) END AS Note FROM raw""",
    ),
    "clean_dedup": _with(RAW, "SELECT DISTINCT * FROM raw"),
    "clean_required": _with(RAW, f"SELECT * FROM raw WHERE {_REQUIRED}"),
    "clean_required_numbers": _with(
        RAW,
        f"""SELECT TransactionID, DeviceID, TransactionAmount FROM (
 SELECT * REPLACE (CASE right(DeviceID, 1) WHEN '3' THEN 'NaN' WHEN '5' THEN 'nan'
  WHEN '7' THEN 'Infinity' ELSE TransactionAmount END AS TransactionAmount) FROM raw)
WHERE {_REQUIRED} AND lower(TransactionAmount) <> 'nan'""",
    ),
    "clean_mixed_dates": _with(
        RAW,
        f"SELECT TransactionID, TransactionDate AS raw_date, {_PARSED} AS TransactionDate FROM raw",
    ),
    "clean_casts": _with(
        RAW,
        f"""SELECT TransactionID, {_AMOUNT} AS TransactionAmount,
 TRY_CAST(AccountBalance AS DOUBLE) AS AccountBalance, {_int("CustomerAge")} AS CustomerAge,
 {_int("TransactionDuration")} AS TransactionDuration,
 {_int("LoginAttempts")} AS LoginAttempts FROM raw""",
    ),
    "clean_suspicious": _with(
        RAW,
        f"""SELECT TransactionID, {_AMOUNT} AS TransactionAmount,
 {_int("LoginAttempts")} AS LoginAttempts, {_SUSPICIOUS} AS is_suspicious FROM raw""",
    ),
    "clean_calendar": _with(
        RAW,
        f"SELECT TransactionID, {_PARSED} AS TransactionDate, {_CALENDAR} FROM raw",
    ),
    "clean_valid_dates": _with(
        RAW,
        f"SELECT TransactionID, {_PARSED} AS TransactionDate FROM raw WHERE {_PARSED} IS NOT NULL",
    ),
    "clean_transactions": _with(CLEAN, "SELECT * FROM clean"),
    "dim_date": _star("dim_date"),
    "dim_account": _star("dim_account"),
    "dim_merchant": _star("dim_merchant"),
    "dim_transaction_type": _star("dim_transaction_type"),
    "lookup_date_key": _with(
        STAR,
        """SELECT TransactionID AS transaction_id, txn_date, d.date_id
FROM clean c LEFT JOIN dim_date d ON c.txn_date = d.date""",
    ),
    "lookup_type_key": _with(
        STAR,
        """SELECT TransactionID AS transaction_id, TransactionType AS transaction_type, y.type_id
FROM clean c LEFT JOIN dim_transaction_type y ON c.TransactionType = y.transaction_type""",
    ),
    "dense_key_by_range": _with(
        RAW,
        """SELECT AccountID, row_number() OVER (ORDER BY AccountID) AS account_key
FROM (SELECT DISTINCT AccountID FROM raw)""",
    ),
    "lookup_by_shuffle": _with(
        f"""{CLEAN},
k AS (SELECT TransactionID, CASE TransactionType WHEN 'Debit' THEN 'debits'
  WHEN 'Credit' THEN AccountID END AS key_text FROM clean),
n AS (SELECT key_text AS name, row_number() OVER (ORDER BY key_text NULLS LAST) AS key_id
 FROM (SELECT DISTINCT key_text FROM k))""",
        """SELECT TransactionID AS transaction_id, key_text, key_id
FROM k LEFT JOIN n ON key_text = name""",
    ),
    "fact_transactions": _star("fact_transactions"),
    "staged_versions": _star("fact_transactions"),
    "staged_roundtrip": _star("fact_transactions"),
    "transform_job": _star("fact_transactions"),
    "load_projection": _with(STAR, _FACT_LOADED),
    "warehouse_replace": _with(STAR, _FACT_LOADED),
    "warehouse_failed_load": _with(STAR, _FACT_LOADED),
    "warehouse_dim_date": _loaded(
        "dim_date", "date year month day day_of_week day_name month_name quarter date_id"
    ),
    "warehouse_dim_account": _loaded(
        "dim_account", "account_id customer_age occupation account_balance"
    ),
    "warehouse_dim_merchant": _loaded("dim_merchant", "merchant_id location channel"),
    "warehouse_dim_transaction_type": _loaded("dim_transaction_type", "transaction_type type_id"),
    "landing_to_warehouse": _with(STAR, _FACT_LOADED),
    "pipeline_audit": _with(
        STAR, _counts(_STAGES | _NULL_DATES | {f"loaded_{table}": table for table in _TABLES})
    ),
    "audit_row_counts": _with(STAR, _counts(_STAGES)),
    "audit_null_dates": _with(
        CLEAN, f"SELECT count(*) AS null_dates FROM required WHERE {_PARSED} IS NULL"
    ),
    "audit_load_counts": _with(STAR, _counts({})),
    "transform_audit": _with(STAR, _counts(_STAGES | _NULL_DATES)),
}
