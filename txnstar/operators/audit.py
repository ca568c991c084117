"""Counts that say what each stage kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """``(stage, row_count)``: one query over all stages, in place of a job for each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_dates(df: DataFrame, col: str = "TransactionDate") -> DataFrame:
    """How many rows have no readable date; ask before ``drop_unparsed``."""
    return df.filter(F.col(col).isNull()).agg(F.count(F.lit(1)).alias("null_dates"))
