"""Staged Parquet tables, one directory each, and versions of a star that change hands at once.

A version is a folder of tables under the staged root. It counts once an empty file bears its
name among the committed ones, so a reader sees all tables of one run, or all of another.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from txnstar.sources.store import Store

VERSIONS = "_versions"
COMMITTED = "_committed"
# The current version and those before it that readers may still have open.
KEPT = 2


def write_staged(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{name}")


def current_root(spark: SparkSession, root: str) -> str:
    """Where the tables of the last committed version are; ``root`` itself if it has none."""
    committed = Store(spark).names(f"{root}/{COMMITTED}")
    return f"{root}/{VERSIONS}/{committed[-1]}" if committed else root


def read_staged(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current version. Take ``current_root`` once to read several alike."""
    return spark.read.parquet(f"{current_root(spark, root)}/{name}")


@contextmanager
def new_version(spark: SparkSession, root: str) -> Iterator[str]:
    """A folder to write all tables of a run into; it becomes the current one at the end.

    If the run fails the version before stays, and so it does if the process dies: the next
    run removes what that left. Versions older than the last ``KEPT`` are removed.
    """
    store = Store(spark)
    name = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    last = max(store.names(f"{root}/{COMMITTED}"), default="")
    if name <= last:  # the clock went back
        name = f"{last}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/{VERSIONS}/{name}"
    try:
        yield folder
    except BaseException:
        store.delete(folder)
        raise
    store.touch(f"{root}/{COMMITTED}/{name}")
    committed = store.names(f"{root}/{COMMITTED}")
    for old in committed[:-KEPT]:
        store.delete(f"{root}/{COMMITTED}/{old}")
    for old in set(store.names(f"{root}/{VERSIONS}")) - set(committed[-KEPT:]):
        if old < name:
            store.delete(f"{root}/{VERSIONS}/{old}")
