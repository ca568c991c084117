"""Document fingerprints: quartile digests of hashed byte triplets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnstar.llm.frames import only
from txnstar.llm.words import to_bytes
from txnstar.sources.workdir import materialise

BUCKETS = 256
# Triplets are taken from windows of five bytes: the first and any two of the others.
WINDOW = 5
PICKS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
# A difference of so much, what two unrelated digests have, or more is no likeness at all.
BOUND = 416
LENGTH_STEP = 1.1
CHUNK_BYTES = 1 << 19
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_STEPS = np.array([0, 1, 2, 6], np.int64)


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """``(texts, BUCKETS)``: how often each bucket is hit by the triplets of each text."""
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    n = len(data) - WINDOW + 1
    if n <= 0:
        return counts
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[:n] == owner[WINDOW - 1 :]
    cells = owner[:n][inside] * BUCKETS
    first, second, third = data * _A, data * _B, data * _C
    flat = np.zeros(counts.size, np.int64)
    for salt, (i, j) in enumerate(PICKS):
        x = first[:n] + second[i : n + i] + third[j : n + j]
        x += np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)
        x ^= x >> np.uint32(15)
        x *= _B
        flat += np.bincount(cells + (x >> np.uint32(24))[inside], minlength=counts.size)
    return flat.reshape(counts.shape)


def _long_counts(text: bytes) -> np.ndarray:
    """``bucket_counts`` of one long text, by pieces that share a window less one byte."""
    starts = range(0, len(text), CHUNK_BYTES)
    pieces = (text[low : low + CHUNK_BYTES + WINDOW - 1] for low in starts)
    return sum(bucket_counts([piece]) for piece in pieces)


def digests(texts: list[bytes]) -> np.ndarray:
    """One row per text: a length code, then for each bucket the quartile its count lies in."""
    out = np.zeros((len(texts), 1 + BUCKETS), np.uint8)
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= CHUNK_BYTES):
            size += len(texts[high])
            high += 1
        part = texts[low:high]
        counts = bucket_counts(part) if size <= CHUNK_BYTES else _long_counts(part[0])
        ranked = np.sort(counts, axis=1)
        for quarter in (1, 2, 3):
            out[low:high, 1:] += counts > ranked[:, BUCKETS * quarter // 4 - 1, None]
        lengths = np.array([len(t) for t in part])
        out[low:high, 0] = np.minimum(255, np.log1p(lengths) / np.log(LENGTH_STEP))
        low = high
    return out


def to_hex(digest: np.ndarray) -> str:
    """The length code in two digits, then two bits for each bucket."""
    codes = digest[1:].reshape(-1, 4)
    packed = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return bytes([digest[0]]).hex() + packed.astype(np.uint8).tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    data = np.frombuffer(bytes.fromhex(text), np.uint8)
    codes = np.stack([data[1:] >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()
    return np.concatenate([data[:1], codes])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, falling with their difference to 0 at ``BOUND``.

    A bucket adds the quartiles between its two codes, and 6 where they are opposite; the
    lengths add their distance in steps of a tenth, four of which are free.
    """
    codes = _STEPS[np.abs(a[1:].astype(np.int64) - b[1:])].sum()
    length = max(0, abs(int(a[0]) - int(b[0])) - 4) if (a[0] or b[0]) else 0
    return 1.0 - min(1.0, (int(codes) + length) / BOUND)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` of every whole text; NULL is empty, equal texts agree."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = digests([to_bytes(t.as_py()) for t in batch.column(1)])
            written = pa.array([to_hex(d) for d in found], pa.string())
            yield pa.record_batch({"doc_id": batch.column(0), "fingerprint": written})

    texts = only(docs, doc_id=id_col, text=text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, fingerprint string")


REPORT = pa.schema(
    [
        ("part", pa.int64()),
        ("edge", pa.string()),
        ("doc", pa.int64()),
        ("text", pa.string()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_REPORT_SQL = (
    "part bigint, edge string, doc bigint, text string, n_chars bigint, edited_sha256 string,"
    " fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _report(
    part: int, docs: list, texts: list[str], own: np.ndarray, after: str, then: np.ndarray
) -> dict:
    """Columns of rows whose successors are known: the next row's, and ``after`` the last's."""
    following = [*texts[1:], after]
    changed = [edited(t, f).encode("utf-8") for t, f in zip(texts, following, strict=True)]
    new = digests(changed)
    nexts = np.concatenate([own[1:], then[None]])
    n = len(docs)
    return {
        "part": [part] * n,
        "edge": [None] * n,
        "doc": docs,
        "text": [None] * n,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(c).hexdigest() for c in changed],
        "fingerprint": [to_hex(d) for d in own],
        "edited_fingerprint": [to_hex(d) for d in new],
        "near_edited": [likeness(a, b) for a, b in zip(own, new, strict=True)],
        "near_next": [likeness(a, b) for a, b in zip(own, nexts, strict=True)],
    }


def _edge(part: int, edge: str, doc: int | None, text: str) -> dict:
    row = {f.name: [None] for f in REPORT}
    return row | {"part": [part], "edge": [edge], "doc": [doc], "text": [text]}


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports in the order of a sorted partition; its first and last row as edges."""
    part = TaskContext.get().partitionId()
    held = None  # the last row so far, whose successor is not known yet
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            piece = batch.slice(low, 256)
            docs = piece.column(0).to_pylist()
            texts = [t or "" for t in piece.column(1).to_pylist()]
            own = digests([t.encode("utf-8") for t in texts])
            if held is None:
                yield pa.RecordBatch.from_pydict(_edge(part, "first", docs[0], texts[0]), REPORT)
            else:
                docs, texts = [held[0], *docs], [held[1], *texts]
                own = np.concatenate([held[2][None], own])
            if len(docs) > 1:
                rows = _report(part, docs[:-1], texts[:-1], own[:-1], texts[-1], own[-1])
                yield pa.RecordBatch.from_pydict(rows, REPORT)
            held = docs[-1], texts[-1], own[-1]
    if held is not None:
        yield pa.RecordBatch.from_pydict(_edge(part, "last", held[0], held[1]), REPORT)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports of the last rows of partitions, whose successors come in ``after``."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            text, after = row["text"], row["after"]
            own = digests([text.encode("utf-8"), after.encode("utf-8")])
            report = _report(row["part"], [row["doc"]], [text], own[:1], after, own[1])
            yield pa.RecordBatch.from_pydict(report, REPORT)


def in_order(texts: DataFrame) -> DataFrame:
    """``(doc, text)`` in ranges of ids, sorted within each.

    Rows that share an id are in the order of their texts' hashes. Rows that repeat both are told
    apart by their place in the input, so however many there are, they fill several ranges.
    """
    keyed = texts.select(
        "doc",
        "text",
        F.xxhash64("text").alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )
    keys = ["doc", "hash", "place"]
    return keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc", "text")


def next_parts(parts: DataFrame) -> DataFrame:
    """``(part, next)``: the next greater part, after the last the first.

    One task orders the numbers, of which there is one for each task of the shuffle.
    """
    along = Window.orderBy("part")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("part").over(along), F.first("part").over(whole))
    return parts.select("part", after.alias("next"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of an edited text and of the next document.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``. The next document is that with the next greater id, after the last the
    first; the edited text has the second half of its code points replaced by the first of
    the next document's. Rows without an id come first, rows that share an id follow each other
    in the order of their texts' hashes. NULL text is empty. Extra columns are ignored.

    One shuffle puts documents in ranges of ids; a task streams through its sorted range with
    one row in hand. The two ends of each range are returned beside the reports, and each
    range's last row is joined with the next range's first in a second, small step.
    """
    texts = only(docs, doc=id_col, text=text_col).select(
        F.col("doc").cast("bigint").alias("doc"), F.coalesce("text", F.lit("")).alias("text")
    )
    found = materialise(in_order(texts).mapInArrow(_along, _REPORT_SQL), "reports")
    ends = found.filter("edge IS NOT NULL")
    first = ends.filter("edge = 'first'").select(
        F.col("part").alias("next"), F.col("text").alias("after")
    )
    last = ends.filter("edge = 'last'").select("part", "doc", "text")
    crossing = last.join(next_parts(last.select("part")), "part").join(first, "next")
    crossing = crossing.select("part", "doc", "text", "after")
    every = found.filter("edge IS NULL").union(crossing.mapInArrow(_across, _REPORT_SQL))
    return every.select(
        F.col("doc").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
