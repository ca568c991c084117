"""The four dimensions and the fact, from clean transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnstar import functions as X
from txnstar.operators.keys import assign_key, lookup_key, one_per_key
from txnstar.schema import ACCOUNT_COLUMNS, FACT_COLUMNS, MERCHANT_COLUMNS

# The later transaction speaks for the account or merchant.
LATEST = ["TransactionDate", "TransactionID"]


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def build_dim_date(clean: DataFrame) -> DataFrame:
    """All attributes follow from the day, so only the days are shuffled."""
    day = F.col("date")
    attributes = {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "date_id": X.date_key(day),
    }
    return _renamed(clean, {"txn_date": "date"}).distinct().withColumns(attributes)


def _latest(clean: DataFrame, names: dict[str, str], drop_null_keys: bool) -> DataFrame:
    key, *attributes = names
    rows = clean.filter(F.col(key).isNotNull()) if drop_null_keys else clean
    return _renamed(one_per_key(rows, [key], LATEST, attributes), names)


def build_dim_account(clean: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    return _latest(clean, ACCOUNT_COLUMNS, drop_null_keys)


def build_dim_merchant(clean: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    return _latest(clean, MERCHANT_COLUMNS, drop_null_keys)


def transaction_types(clean: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """The distinct types, to be numbered."""
    values = _renamed(clean, {"TransactionType": "transaction_type"}).distinct()
    return values.filter(F.col("transaction_type").isNotNull()) if drop_null_keys else values


def build_dim_transaction_type(clean: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """Types numbered by name in one task; the transform job numbers very many in ranges."""
    return assign_key(transaction_types(clean, drop_null_keys), "transaction_type", "type_id")


def build_fact(
    clean: DataFrame,
    dim_date: DataFrame,
    dim_type: DataFrame,
    small_dates: bool = True,
    small_types: bool = True,
    hot_types: DataFrame | None = None,
) -> DataFrame:
    """One row per clean row, with the keys of the *written* date and type dimensions.

    Accounts and merchants are carried by their natural keys. See ``lookup_key`` for
    dimensions that are not small.
    """
    keyed = lookup_key(clean, dim_date, [("txn_date", "date")], "date_id", small_dates)
    on_type = [("TransactionType", "transaction_type")]
    keyed = lookup_key(keyed, dim_type, on_type, "type_id", small_types, hot_types)
    return _renamed(keyed, FACT_COLUMNS)
