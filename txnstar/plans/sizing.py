"""Session options for a given amount of raw data."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1024 * 1024
GIB = 1024 * MIB
# Maps and reducers grow with the data up to these, so that blocks stay worth a read.
MAX_SPLIT, MAX_REDUCER = GIB, 4 * GIB
MIN_SPLIT, MIN_REDUCER = 128 * MIB, 512 * MIB
TASKS = 10_000
# The JVM never compiles a method of more bytes of code; it interprets it, many times slower.
COMPILED_BYTES = 8000
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
# Rows whose width stands for that of all.
MEASURED_ROWS = 20_000


def _between(least: int, value: int, most: int) -> int:
    return max(least, min(most, value))


def session_conf(raw_bytes: int, partitions: int = 200) -> dict[str, str]:
    """Options under which the transform's one wide shuffle fits its tasks.

    The shuffle carries about as many compressed bytes as the raw text has. Up to about 1 TB
    splits have 128 MiB and reducers 512 MiB; beyond, both grow, up to 1 GiB and 4 GiB, which
    a task sorts by spilling. 100 TB then has 95,000 maps and 24,000 reducers, and a block
    between the two 46 KB. Adaptive execution merges reducers that get less; it never makes
    more of them, so there are never fewer than ``partitions``.
    """
    split = _between(MIN_SPLIT, raw_bytes // TASKS, MAX_SPLIT)
    reducer = _between(MIN_REDUCER, raw_bytes // TASKS, MAX_REDUCER)
    return {
        "spark.sql.shuffle.partitions": str(max(partitions, math.ceil(raw_bytes / reducer))),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(max(64 * MIB, reducer // 4)),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def compiled(spark: SparkSession) -> None:
    """Let Spark run long projections as short methods, which the JVM compiles.

    A stage whose columns make one method too long for that runs operator by operator instead,
    each column in methods of its own. The option stays set, as frames run after their query returns.
    """
    if int(spark.conf.get(HUGE_METHOD)) > COMPILED_BYTES:
        spark.conf.set(HUGE_METHOD, COMPILED_BYTES)


def text_bytes(df: DataFrame, measured: int = MEASURED_ROWS) -> int:
    """About the bytes that written rows of text have as CSV, however well they are compressed.

    Their number comes from the footers; the width is the mean over some rows.
    """
    width = F.lit(0)
    for col in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{col}`").cast("string")), F.lit(0)) + 1
    mean = df.limit(measured).agg(F.avg(width)).first()[0]
    return int(df.count() * mean) if mean else 0


@contextmanager
def sized_for(spark: SparkSession, raw_bytes: int) -> Iterator[None]:
    """The session with options for ``raw_bytes``, and as it was before afterwards."""
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = session_conf(raw_bytes, now)
    if raw_bytes // TASKS <= MIN_SPLIT:  # the session's own splits do
        wanted = {k: v for k, v in wanted.items() if k == "spark.sql.shuffle.partitions"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
