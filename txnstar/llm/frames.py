"""Small helpers on data frames that several operators use."""

from __future__ import annotations

import os

import txnstar
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A side of a join is broadcast when its rows, counted, take at most so many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
# Parts in which a group's rows are ranked before the group is.
PARTS = 64
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 * 1024 * 1024,
}


def prepare(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did, and bound their batches.

    A batch of texts is held several times over on its way to Python, so few rows and few bytes
    make one, however long the texts are.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(txnstar.__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))
    for name, most in BATCH_LIMITS.items():
        now = spark.conf.get(name, None)
        if now is None or not 0 < int(now.rstrip("b")) <= most:
            spark.conf.set(name, most)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under internal names; whatever else ``df`` has plays no part."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A *written* side of a join, marked for broadcast when its counted rows are few.

    Beyond the limit the join shuffles both sides, and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def packed(df: DataFrame, **beside: Column) -> DataFrame:
    """Whole rows in one column ``row``, so that columns beside it clash with none of theirs."""
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in beside.items()])


def first_rows(
    df: DataFrame, group: str, spread: Column, order: list[Column], most: int, name: str
) -> DataFrame:
    """The ``most`` first rows of each group by ``order``, numbered from 1 in ``name``.

    Rows are first ranked in ``PARTS`` parts of their group, by the hash of ``spread``, so the one
    task that ranks a group gets ``PARTS * most`` rows at most, however large the group is and
    however many tasks send to it.
    """
    part = F.pmod(F.xxhash64(spread), F.lit(PARTS)).alias("_part")
    rows = df.select("*", part)
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    rows = rows.withColumn(name, within).filter(F.col(name) <= most).drop("_part")
    among = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn(name, among.cast("bigint")).filter(F.col(name) <= most)
