"""One row per key, surrogate keys, and fetching a surrogate from a dimension.

Nothing here runs a job: the caller, who knows what is written and how large it is, says
whether a table is small.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A key with more than this share of the rows is hot; fewer than 1/share keys can be.
HOT_SHARE = 1 / 1000


def one_per_key(
    df: DataFrame, keys: list[str], order: list[str], attributes: list[str]
) -> DataFrame:
    """For each key the attributes of its last row by ``order``.

    Ties go to the greatest attributes, so the choice is the same whatever the
    partitioning. A maximum merges inside each map task: a hot key sends one row per
    task, where a window would send all of them to one task. NULL keys form a group.

    Spark sorts the rows of a task to merge text maxima. A hash in front of the keys lets
    that sort compare numbers; keys that share their first letters take a third less time.
    """
    ranking = F.struct(*order, *[a for a in attributes if a not in order])
    last = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.max(ranking).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{a}").alias(a) for a in attributes])


def assign_key(df: DataFrame, col: str, name: str) -> DataFrame:
    """Number the distinct values of ``col`` 1..n, NULL last; reruns reproduce it.

    One task numbers all values. For more than a task holds, use ``in_ranges``, write its
    result, and give that to ``assign_key_in_ranges``; the numbers are the same.
    """
    by_value = Window.orderBy(F.col(col).asc_nulls_last())
    return df.withColumn(name, F.row_number().over(by_value).cast("bigint"))


def in_ranges(df: DataFrame, col: str) -> DataFrame:
    """``df`` with a ``_range`` for each row, such that greater ranges hold greater values.

    The ranges are drawn from a sample, so write the result before it is read twice.
    """
    by_value = F.col(col).asc_nulls_last()
    return df.repartitionByRange(by_value).withColumn("_range", F.spark_partition_id())


def assign_key_in_ranges(ranged: DataFrame, col: str, name: str) -> DataFrame:
    """Number within ranges of values, then shift by the sizes of the lower ranges."""
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition, whatever the data holds.
    shift = (
        ranged.groupBy("_range")
        .count()
        .select("_range", F.coalesce(F.sum("count").over(lower), F.lit(0)).alias("_shift"))
    )
    by_value = F.col(col).asc_nulls_last()
    within = F.row_number().over(Window.partitionBy("_range").orderBy(by_value))
    columns = [c for c in ranged.columns if c != "_range"]
    return (
        ranged.withColumn("_within", within)
        .join(F.broadcast(shift), "_range")
        .select(*columns, (F.col("_within") + F.col("_shift")).cast("bigint").alias(name))
    )


def hot_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """The values of ``cols`` that more than ``HOT_SHARE`` of the rows have, in those columns.

    There are fewer than ``1 / HOT_SHARE`` of them, however the data looks. Rows with a NULL
    count among all rows but are not hot. One aggregate gives the counts and their total.
    """
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg((F.sum("_n") * HOT_SHARE).alias("_limit"))
    keyed = reduce(and_, [F.col(c).isNotNull() for c in cols])
    many = F.col("_n") > F.col("_limit")
    return counts.filter(keyed).join(F.broadcast(total), many).select(*cols)


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    on: list[tuple[str, str]],
    key: str,
    small: bool = True,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left-join ``key`` from ``dim``, whose ``on`` columns are unique.

    A NULL matches nothing. A ``small`` dimension is broadcast and ``df`` is not shuffled. One
    that is not is joined by shuffle, but rows whose key is NULL or among the ``hot`` ones
    skip the shuffle: pass ``hot_keys`` of ``df``, written, lest it be computed twice.
    """
    lookup = dim.select(*[F.col(d).alias(f"_{d}") for _, d in on], key)
    pairs = [(left, f"_{right}") for left, right in on]
    if small:
        return _left_lookup(df, F.broadcast(lookup), pairs, key)
    hot = hot_keys(df, [left for left, _ in on]) if hot is None else hot
    return _lookup_by_shuffle(df, lookup, pairs, key, hot)


def _left_lookup(
    df: DataFrame, lookup: DataFrame, pairs: list[tuple[str, str]], key: str
) -> DataFrame:
    match = reduce(and_, [df[left] == lookup[right] for left, right in pairs])
    return df.join(lookup, match, "left").select(*[df[c] for c in df.columns], lookup[key])


def _lookup_by_shuffle(
    df: DataFrame, lookup: DataFrame, pairs: list[tuple[str, str]], key: str, hot: DataFrame
) -> DataFrame:
    """Shuffle only rows whose key is neither NULL nor hot; hot keys are a bounded few."""
    rights = [right for _, right in pairs]
    no_key = reduce(or_, [F.col(left).isNull() for left, _ in pairs])
    named = [F.col(left).alias(right) for left, right in pairs]
    hot = hot.select(*named, F.lit(True).alias("_hot"))
    hot_lookup = lookup.join(F.broadcast(hot), rights, "left_semi")
    marked = _left_lookup(df, F.broadcast(hot), pairs, "_hot")
    apart = F.col("_hot").isNotNull() | no_key
    unshuffled = _left_lookup(marked.filter(apart), F.broadcast(hot_lookup), pairs, key)
    shuffled = _left_lookup(marked.filter(~apart), lookup, pairs, key)
    return unshuffled.unionByName(shuffled).drop("_hot")
