"""Raw transactions made from the order tables, for queries, tests and the bench.

Orders stand for transactions. The rows carry what real drops carry: repeated rows,
missing values, six ways to write a date and some that cannot be read, signs, text in
number columns. All of it derives from the given tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnstar.plans.sizing import compiled
from txnstar.schema import RAW_COLUMNS


def _padded(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _written_date(ts: Column, key: Column) -> Column:
    """The time in one of six layouts by key; built from its parts, so in no zone.

    ``ts`` is to be a column that rows have already: each part would compute it anew.
    """
    year, month, day = F.year(ts), F.month(ts), F.dayofmonth(ts)
    hour, minute, second = F.hour(ts), F.minute(ts), F.second(ts)
    month2, day2, hour2, minute2 = (_padded(c, 2) for c in (month, day, hour, minute))
    short_day = F.concat_ws("/", month, day, year)
    long_day = F.concat_ws("/", month2, day2, year)
    iso_day = F.concat_ws("-", _padded(year, 4), month2, day2)
    layout = key % 10
    return (
        F.when(layout < 3, F.concat(short_day, F.lit(" "), F.concat_ws(":", hour, minute2)))
        .when(layout == 3, short_day)
        .when(layout == 4, F.concat(long_day, F.lit(" "), F.concat_ws(":", hour2, minute2)))
        .when(layout == 5, long_day)
        .when(
            layout.isin(6, 7),
            F.concat(
                iso_day, F.lit(" "), F.concat_ws(":", hour2, minute2, _padded(second, 2))
            ),
        )
        .when(layout == 8, iso_day)
        .when(key % 20 == 9, F.lit("13/45/2023"))
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    compiled(spark)
    orders, customer, nation = (
        spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation")
    )
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(
        nation, customer["c_nationkey"] == nation["n_nationkey"]
    )
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    copies = F.when(key % 50 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    # Repeated while they are short, so that the long rows are made once and copied by nobody.
    rows = rows.select(
        *["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
        *["n_name", "c_mktsegment", "c_acctbal"],
        F.timestamp_add("MINUTE", key % 1440, F.col("o_orderdate")).alias("_ts"),
        F.explode(copies).alias("_copy"),
    )
    cents = _padded(key % 100, 2)
    status = F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    columns = {
        "TransactionID": F.when(key % 97 != 0, F.concat(F.lit("TX"), _padded(key, 9))),
        "AccountID": F.concat(F.lit("AC"), _padded(cust, 7)),
        "TransactionAmount": F.when(
            key % 89 != 0,
            F.concat(
                F.when(key % 5 == 0, "-").otherwise(""),
                F.floor(F.col("o_totalprice") / 20).cast("string"),
                F.lit("."),
                cents,
            ),
        ),
        "TransactionDate": _written_date(F.col("_ts"), key),
        "TransactionType": F.when(status == "F", "Debit")
        .when(status == "O", "Credit")
        .when(key % 2 == 0, "Debit"),
        "Location": F.col("n_name"),
        "DeviceID": F.concat(F.lit("D"), _padded(key % 700, 6)),
        "IP Address": F.concat_ws(".", F.lit("10.0"), key % 251, cust % 251),
        "MerchantID": F.concat(F.lit("M"), _padded(key % 100, 3)),
        "Channel": F.when(priority == "1-URGENT", "ATM")
        .when(priority == "2-HIGH", "Branch")
        .otherwise("Online"),
        "CustomerAge": (18 + cust % 63).cast("string"),
        "CustomerOccupation": F.col("c_mktsegment"),
        "TransactionDuration": (10 + key % 291).cast("string"),
        "LoginAttempts": F.when(key % 83 == 0, "n/a").otherwise((1 + key % 5).cast("string")),
        "AccountBalance": F.concat(
            (F.floor("c_acctbal") + key % 500).cast("string"), F.lit("."), cents
        ),
    }
    return rows.select(*[columns[c].alias(c) for c in RAW_COLUMNS])
