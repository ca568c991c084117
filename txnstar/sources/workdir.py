"""Tables written between two stages, in storage every executor can reach."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from txnstar.sources.store import Store

_scratch: ContextVar[str | None] = ContextVar("txnstar_scratch", default=None)


@functools.lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="txnstar-")


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. A local session without one gets a folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_dir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder, or the run's scratch, that nobody else uses."""
    return f"{_scratch.get() or shared_dir(spark)}/txnstar-{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for what a run writes between its stages, removed when the run is over.

    Frames that read from it are of no use afterwards: write the results elsewhere, under a
    path named before. A failed run leaves nothing either; it starts anew.
    """
    folder = fresh_dir(spark, "scratch")
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        Store(spark).delete(folder)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: computed once, and safe from lost executors."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
