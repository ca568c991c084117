"""Shape a staged table for the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnstar import functions as X


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def timestamps_to_text(df: DataFrame) -> DataFrame:
    """Timestamps become ``yyyy-MM-dd HH:mm:ss``; dates and all else stay as they are."""
    times = [
        f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    return df.withColumns({c: X.timestamp_text(F.col(f"`{c}`")) for c in times})


def load_projection(df: DataFrame) -> DataFrame:
    return df.transform(upper_columns).transform(timestamps_to_text)
