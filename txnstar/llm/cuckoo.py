"""Exact duplicates by a cuckoo-filter index over digests of whole texts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnstar.llm.frames import only, packed, sized
from txnstar.llm.words import to_bytes
from txnstar.sources.workdir import materialise

SLOTS = 4
MAX_KICKS = 200
# Live digests one task's index holds before it passes on what it has.
LOCAL_DIGESTS = 200_000
# A text of more than this share of all rows is joined apart; fewer than 1 / share can be.
HOT_SHARE = 0.001


class CuckooIndex:
    """Live digests in buckets of four slots, each found by a 16-bit fingerprint.

    A digest may lie in two buckets, the second reached from the first by the hash of the
    fingerprint alone. A fingerprint that matches is only a hit: the digest stored with its
    slot (with SHA-256 the whole text's identity) decides. When an insertion has moved
    ``MAX_KICKS`` fingerprints in vain, the table doubles and is filled from the stored
    digests. Deletion frees the slot of a live digest.
    """

    def __init__(self, capacity: int = 1024):
        self._allot(max(1, capacity // SLOTS))
        self._free: list[int] = []
        self.digests: list[bytes | None] = []

    def _allot(self, buckets: int) -> None:
        size = 1 << (buckets - 1).bit_length()
        self.mask = size - 1
        self.prints = [0] * (size * SLOTS)
        self.entries = [-1] * (size * SLOTS)

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        value = int.from_bytes(digest[:8], "little")
        mark = (value & 0xFFFF) or 1
        first = (value >> 16) & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def find(self, digest: bytes) -> int:
        """Slot of a live digest, or -1."""
        mark, first, second = self._place(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.digests[self.entries[slot]] == digest:
                    return slot
        return -1

    def insert(self, digest: bytes) -> tuple[int, bool]:
        """The digest's entry number, and whether it is new."""
        slot = self.find(digest)
        if slot >= 0:
            return self.entries[slot], False
        if self._free:
            entry = self._free.pop()
            self.digests[entry] = digest
        else:
            entry = len(self.digests)
            self.digests.append(digest)
        if not self._settle(digest, entry):
            self._grow()
        return entry, True

    def _settle(self, digest: bytes, entry: int) -> bool:
        mark, bucket, second = self._place(digest)
        for b in (bucket, second):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.entries[slot] = mark, entry
                    return True
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + (kick + mark) % SLOTS
            self.prints[slot], mark = mark, self.prints[slot]
            self.entries[slot], entry = entry, self.entries[slot]
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.entries[slot] = mark, entry
                    return True
        return False

    def _grow(self) -> None:
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._allot(buckets)
            if all(self._settle(d, e) for e, d in enumerate(self.digests) if d is not None):
                return

    def delete(self, digest: bytes) -> bool:
        slot = self.find(digest)
        if slot < 0:
            return False
        entry = self.entries[slot]
        self.prints[slot], self.entries[slot] = 0, -1
        self.digests[entry] = None
        self._free.append(entry)
        return True

    def __len__(self) -> int:
        return len(self.digests) - len(self._free)

    def live(self) -> list[bytes]:
        return [d for d in self.digests if d is not None]


def _same(text: str) -> str:
    return text


def _digests(normalise: Callable[[str], str]) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [
                hashlib.sha256(to_bytes(normalise(t.as_py() or ""))).digest()
                for t in batch.column(1)
            ]
            yield pa.record_batch(
                {"doc": batch.column(0), "digest": pa.array(digests, pa.binary())}
            )

    return rows


class _Totals:
    """Rows and greatest id of each live digest of an index."""

    def __init__(self):
        self.index, self.rows, self.last = CuckooIndex(), [], []

    def add(self, digest: bytes, rows: int, last: int | None) -> None:
        entry, new = self.index.insert(digest)
        if new:
            self.rows.append(rows)
            self.last.append(last)
            return
        self.rows[entry] += rows
        if last is not None and (self.last[entry] is None or last > self.last[entry]):
            self.last[entry] = last

    def batches(self) -> Iterator[pa.RecordBatch]:
        step = 10_000
        for low in range(0, len(self.rows), step):
            yield pa.record_batch(
                {
                    "digest": pa.array(self.index.digests[low : low + step], pa.binary()),
                    "n": pa.array(self.rows[low : low + step], pa.int64()),
                    "keep": pa.array(self.last[low : low + step], pa.int64()),
                }
            )


def _local(limit: int) -> Callable:
    """Copies within a task meet in its index; one row per live digest goes on."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _Totals()
        for batch in batches:
            for doc, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                totals.add(digest, 1, doc)
                if len(totals.rows) >= limit:
                    yield from totals.batches()
                    totals = _Totals()
        yield from totals.batches()

    return rows


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = _Totals()
    for batch in batches:
        for digest, n, keep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            totals.add(digest, n, keep)
    yield from totals.batches()


def digest_table(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[str], str] = _same,
) -> DataFrame:
    """``(doc, digest)``: SHA-256 of each whole normalised text; NULL text is empty."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("bigint"))
    return texts.mapInArrow(_digests(normalise), "doc bigint, digest binary")


def live_groups(digests: DataFrame, local_digests: int = LOCAL_DIGESTS) -> DataFrame:
    """``(digest, n, keep)``: every live digest with its rows and their greatest id.

    Each task first merges its own copies in an index of at most ``local_digests``, so a
    text that is a third of all rows sends a few rows per task to the digest's partition.
    A partition holds its digests in memory, about 200 bytes each.
    """
    schema = "digest binary, n bigint, keep bigint"
    merged = digests.mapInArrow(_local(local_digests), schema)
    return merged.repartition("digest").mapInArrow(_merge, schema)


def hot_groups(groups: DataFrame) -> DataFrame:
    """The groups of more than ``HOT_SHARE`` of all rows, of which there are few by that."""
    limit = groups.agg((F.sum("n") * HOT_SHARE).alias("_limit"))
    return groups.join(F.broadcast(limit), F.col("n") > F.col("_limit")).drop("_limit")


def exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    Rows with equal text form a group, and its greatest id stays. Texts are held equal when
    their SHA-256 is. A row whose id repeats the greatest is kept as well, and so is every
    row of a group without ids, whose ``keep_id`` is NULL; ``drop_exact_copies`` leaves one
    of them. Options are those of ``digest_table``. Copies of a text that is more than
    ``HOT_SHARE`` of all rows are not shuffled, so no task gets them all.
    """
    digests = materialise(digest_table(docs, **options), "digests")
    groups = materialise(live_groups(digests), "groups")
    # Rows of hot texts find their groups where they are; the others meet theirs by a shuffle.
    hot = F.broadcast(materialise(hot_groups(groups), "hot"))
    cold = digests.join(hot, "digest", "left_anti").join(groups, "digest")
    return digests.join(hot, "digest").union(cold).select(
        F.col("doc").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each distinct text.

    Of rows that share both the text and the greatest id, any one stays.
    """
    digests = materialise(digest_table(docs, id_col, text_col), "digests")
    groups = materialise(live_groups(digests).filter("n > 1"), "groups")
    tied = (
        digests.join(groups, "digest")
        .filter(F.col("doc").eqNullSafe(F.col("keep")))
        .groupBy("digest")
        .agg(F.count("*").alias("_at_most"))
        .filter("_at_most > 1")
    )
    groups = groups.join(tied, "digest", "left").select(
        F.col("digest").alias("_digest"),
        F.col("keep").alias("_keep"),
        F.coalesce("_at_most", F.lit(1)).alias("_ties"),
    )
    groups = sized(materialise(groups, "groups"), 80)
    doc = F.col(f"`{id_col}`").cast("bigint")
    marked = packed(docs, own=_sha256(F.col(f"`{text_col}`")), doc=doc)
    marked = marked.join(groups, F.col("own") == F.col("_digest"), "left")
    stays = marked.filter(F.col("_digest").isNull() | F.col("doc").eqNullSafe(F.col("_keep")))
    single = stays.filter(F.coalesce("_ties", F.lit(1)) == 1)
    ties = stays.filter("_ties > 1").dropDuplicates(["own"])
    return single.select("row.*").union(ties.select("row.*"))


# The index as a table, for corpora that change.
INDEX_SCHEMA = "shard int, digests binary"


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def update_index(
    index: DataFrame | None,
    inserts: DataFrame | None = None,
    deletes: DataFrame | None = None,
    shards: int = 64,
) -> DataFrame:
    """The index ``(shard, digests)`` after deleting and then inserting digests.

    ``inserts`` and ``deletes`` have a column ``digest``; repeated and unknown ones change
    nothing. A shard stores its live digests end to end and rebuilds its filter from them;
    choose ``shards`` so that one fits a task, and keep it for the life of the index.
    """
    changes = [
        df.select("digest").distinct().withColumn("insert", F.lit(added))
        for df, added in ((inserts, True), (deletes, False))
        if df is not None
    ]
    if not changes:
        raise ValueError("nothing to insert or delete")
    change = changes[0] if len(changes) == 1 else changes[0].union(changes[1])
    spark = change.sparkSession
    index = spark.createDataFrame([], INDEX_SCHEMA) if index is None else index
    change = change.select(_shard(shards), "digest", "insert")

    def apply(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        found = CuckooIndex(2 * len(new) + 1024)
        for stored in old["digests"]:
            for low in range(0, len(stored), 32):
                found.insert(stored[low : low + 32])
        for digest in new.loc[~new["insert"], "digest"]:
            found.delete(bytes(digest))
        for digest in new.loc[new["insert"], "digest"]:
            found.insert(bytes(digest))
        return pd.DataFrame({"shard": np.int32([key[0]]), "digests": [b"".join(found.live())]})

    return (
        index.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(apply, INDEX_SCHEMA)
    )


def lookup_index(index: DataFrame, queries: DataFrame, shards: int = 64) -> DataFrame:
    """``(digest, live)`` for the distinct digests of ``queries``."""
    asked = queries.select("digest").distinct().select(_shard(shards), "digest")

    def apply(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        found = CuckooIndex()
        for stored in old["digests"]:
            for low in range(0, len(stored), 32):
                found.insert(stored[low : low + 32])
        asked = [bytes(d) for d in new["digest"]]
        return pd.DataFrame({"digest": asked, "live": [found.find(d) >= 0 for d in asked]})

    return (
        index.groupBy("shard")
        .cogroup(asked.groupBy("shard"))
        .applyInPandas(apply, "digest binary, live boolean")
    )
