"""A factorisation machine that scores the quality of whole texts."""

from __future__ import annotations

import io
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnstar.llm.words import WordHashes, to_bytes

# Documents the model is fitted on at most, chosen by the hash of their ids.
TRAIN_DOCUMENTS = 8000
WORD_SLOTS = 1 << 14
FACTORS = 8
BINS = 12
EPOCHS = 10
BATCH = 128
RATE = 0.05
DECAY = 1e-5
SCORE_TEXTS = 256

STATISTICS = (
    "log_chars",
    "log_words",
    "word_length",
    "distinct_words",
    "top_word",
    "upper",
    "digits",
    "punctuation",
    "marks",
    "symbol_words",
    "one_letter_words",
    "repeated_lines",
    "repeated_neighbours",
    "line_length",
    "stated_log_chars",
)
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_PLAIN_MARKS = b".,;:'\"()-"
_MARKS = bytes(set(_PUNCTUATION) - set(_PLAIN_MARKS))
_SYMBOL_END = re.compile(rb"[^\w\s.,;:'\"()\-\x80-\xff](?=\s|$)")


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def statistics(data: bytes, words: list[bytes], stated: float | None) -> list[float]:
    """``STATISTICS`` of one text; 0 where a text has nothing to measure.

    Where no number of characters is stated, the length in bytes takes its place.
    """
    chars, n = max(1, len(data)), max(1, len(words))
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        _without(data, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars,
        _without(data, b"0123456789") / chars,
        _without(data, _PUNCTUATION) / chars,
        _without(data, _MARKS) / chars,
        len(_SYMBOL_END.findall(data)) / n,
        sum(len(w) == 1 for w in words) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        same / n,
        np.log1p(chars / max(1, len(lines))),
        np.log1p(len(data) if stated is None or stated != stated else max(0.0, stated)),
    ]


class Features:
    """Flat rows of (owner, slot, value): hashed words, then a bin of each statistic."""

    def __init__(
        self,
        texts: list[str | None],
        stated: list[float | None],
        hashes: WordHashes | None = None,
    ):
        hashes = WordHashes() if hashes is None else hashes
        owners, slots, values, stats = [], [], [], []
        for row, (text, chars) in enumerate(zip(texts, stated, strict=True)):
            data = to_bytes(text)
            words = data.split()
            stats.append(statistics(data, words, chars))
            slot, count = np.unique(
                hashes.of(data.lower().split()) % np.uint64(WORD_SLOTS), return_counts=True
            )
            value = np.log1p(count).astype(np.float32)
            owners.append(np.full(len(slot), row, np.int32))
            slots.append(slot.astype(np.int32))
            values.append(value / max(1e-6, float(np.sqrt((value**2).sum()))))
        self.n = len(texts)
        self.owner = np.concatenate(owners) if owners else np.zeros(0, np.int32)
        self.slot = np.concatenate(slots) if slots else np.zeros(0, np.int32)
        self.value = np.concatenate(values) if values else np.zeros(0, np.float32)
        self.stats = np.array(stats, np.float32).reshape(self.n, len(STATISTICS))

    def subset(self, rows: np.ndarray) -> Features:
        """The features of some of the texts, in the order given."""
        starts = np.searchsorted(self.owner, np.arange(self.n + 1))
        take = [np.arange(starts[r], starts[r + 1]) for r in rows]
        some = Features([], [])
        some.n, some.stats = len(rows), self.stats[rows]
        some.owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(t) for t in take])
        some.slot, some.value = (part[np.concatenate(take)] for part in (self.slot, self.value))
        return some

    def with_bins(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [np.searchsorted(edges[:, j], self.stats[:, j]) for j in range(len(STATISTICS))]
        bins = np.stack(found, axis=1)
        slot = (WORD_SLOTS + np.arange(len(STATISTICS)) * BINS + bins).astype(np.int32)
        owner = np.repeat(np.arange(self.n, dtype=np.int32), len(STATISTICS))
        order = np.argsort(np.concatenate([self.owner, owner]), kind="stable")
        one = np.full(slot.size, 1 / np.sqrt(len(STATISTICS)), np.float32)
        return (
            np.concatenate([self.owner, owner])[order],
            np.concatenate([self.slot, slot.ravel()])[order],
            np.concatenate([self.value, one])[order],
        )


class StoredFeatures:
    """Features of texts as the bytes that ``_feature_rows`` makes of them, read a batch at a time.

    A text has at most ``WORD_SLOTS`` slots of six bytes, so 8000 texts of whatever length take
    at most 0.8 GB, and usually some MB.
    """

    def __init__(self, rows: pa.Table):
        self.order = pc.sort_indices(rows, sort_keys=[("doc", "ascending")]).to_numpy()
        self.slots, self.values = rows.column("slots"), rows.column("values")
        self.n = rows.num_rows
        flat = b"".join(x.as_py() for x in rows.column("stats"))
        self.stats = np.frombuffer(flat, np.float32).reshape(self.n, -1)[self.order]
        self.labels = rows.column("label").to_numpy()[self.order]

    def subset(self, rows: np.ndarray) -> Features:
        at = self.order[rows]
        slots = [np.frombuffer(self.slots[int(i)].as_buffer(), np.uint16) for i in at]
        some = Features([], [])
        some.n, some.stats = len(rows), self.stats[rows]
        some.owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(s) for s in slots])
        some.slot = np.concatenate(slots).astype(np.int32)
        some.value = np.concatenate(
            [np.frombuffer(self.values[int(i)].as_buffer(), np.float32) for i in at]
        )
        return some


class FactorisationMachine:
    """``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j`` under a logistic link.

    The pairwise sum costs time linear in the features, as half of
    ``sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2``.
    """

    def __init__(self, edges: np.ndarray, seed: int = 7):
        slots = WORD_SLOTS + len(STATISTICS) * BINS
        self.edges = edges
        self.bias = np.zeros(1, np.float32)
        self.linear = np.zeros(slots, np.float32)
        factors = np.random.default_rng(seed).normal(0, 0.05, (slots, FACTORS))
        self.factors = factors.astype(np.float32)

    def _sums(self, n: int, owner: np.ndarray, slot: np.ndarray, value: np.ndarray) -> tuple:
        scaled = self.factors[slot] * value[:, None]
        starts = np.searchsorted(owner, np.arange(n))
        per_row = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat((scaled**2).sum(axis=1), starts)
        linear = np.add.reduceat(self.linear[slot] * value, starts)
        margin = self.bias[0] + linear + 0.5 * ((per_row**2).sum(axis=1) - squares)
        return margin, per_row, scaled

    def margins(self, features: Features) -> np.ndarray:
        owner, slot, value = features.with_bins(self.edges)
        return self._sums(features.n, owner, slot, value)[0] if features.n else np.zeros(0)

    def scores(self, features: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(features).astype(np.float64), -30, 30)))

    def fit(
        self, features: Features | StoredFeatures, labels: np.ndarray, seed: int = 7
    ) -> FactorisationMachine:
        """Adaptive-rate gradient steps on the logistic loss; one small batch is unpacked at a time."""
        rng = np.random.default_rng(seed)
        memory = [np.full_like(p, 1e-6) for p in (self.bias, self.linear, self.factors)]
        for _ in range(EPOCHS):
            order = rng.permutation(features.n)
            for low in range(0, features.n, BATCH):
                rows = order[low : low + BATCH]
                own, s, x = features.subset(rows).with_bins(self.edges)
                margin, per_row, scaled = self._sums(len(rows), own, s, x)
                error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]
                error = (error / len(rows)).astype(np.float32)
                e = error[own]
                used, at = np.unique(s, return_inverse=True)
                g_linear = np.bincount(at, e * x, len(used)) + DECAY * self.linear[used]
                pull = (e * x)[:, None] * (per_row[own] - scaled)
                g_factors = np.stack(
                    [np.bincount(at, pull[:, f], len(used)) for f in range(FACTORS)], axis=1
                )
                g_factors += DECAY * self.factors[used]
                for param, mem, where, grad in (
                    (self.bias, memory[0], slice(None), np.array([error.sum()])),
                    (self.linear, memory[1], used, g_linear),
                    (self.factors, memory[2], used, g_factors),
                ):
                    mem[where] += (grad**2).astype(np.float32)
                    param[where] -= (RATE * grad / np.sqrt(mem[where])).astype(np.float32)
        return self

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, edges=self.edges, bias=self.bias, linear=self.linear, factors=self.factors)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> FactorisationMachine:
        stored = np.load(io.BytesIO(data))
        model = cls(stored["edges"])
        model.bias, model.linear, model.factors = (stored[k] for k in ("bias", "linear", "factors"))
        return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the fit needs of each text, so that no task holds the texts of the sample."""
    hashes = WordHashes()
    for batch in batches:
        for start in range(0, batch.num_rows, SCORE_TEXTS):
            part = batch.slice(start, SCORE_TEXTS)
            texts, stated = part.column("text").to_pylist(), part.column("stated").to_pylist()
            found = Features(texts, stated, hashes)
            ends = np.searchsorted(found.owner, np.arange(found.n + 1))
            cuts = [slice(a, b) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.record_batch(
                {
                    "doc": part.column("doc"),
                    "label": part.column("label").cast(pa.float32()),
                    "slots": pa.array(
                        [found.slot[c].astype(np.uint16).tobytes() for c in cuts], pa.binary()
                    ),
                    "values": pa.array([found.value[c].tobytes() for c in cuts], pa.binary()),
                    "stats": pa.array([row.tobytes() for row in found.stats], pa.binary()),
                }
            )


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    features = StoredFeatures(pa.Table.from_batches(parts))
    inner = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(features.stats, inner, axis=0).astype(np.float32)
    model = FactorisationMachine(edges)
    model.fit(features, features.labels)
    yield pa.record_batch({"model": pa.array([model.to_bytes()], pa.binary())})


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCUMENTS, label_col: str = "quality"
) -> bytes | None:
    """A model fitted on at most ``sample`` labelled documents that are not held out.

    The sample is that with the least hashes of the id, so it does not depend on partitions; it
    is bounded, so one task fits the model on the features that the others compute, and the
    driver gets the model alone, about 600 KB whatever the data. An id with several labels counts
    with the least, one with several texts with the least of these; rows without id or label
    teach nothing. Returns None when nothing is left to learn from.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("doc"), F.col(label_col).alias("label"))
        .filter(F.col("doc").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc")))
        .groupBy("doc")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc"), "doc")
        .limit(sample)
    )
    texts = _texts(docs, "doc_id", "text", "n_chars")
    # One row per id, the same in every run; an id without text is an empty one.
    rows = texts.join(F.broadcast(chosen), "doc").groupBy("doc", "label")
    rows = rows.agg(F.min(F.struct("text", "stated")).alias("least"))
    rows = rows.select("doc", "label", "least.text", "least.stated")
    kind = rows.schema["doc"].dataType.simpleString()
    features = rows.mapInArrow(
        _feature_rows, f"doc {kind}, label float, slots binary, values binary, stats binary"
    )
    found = features.repartition(1).mapInArrow(_fit_task, "model binary").collect()
    return bytes(found[0]["model"]) if found else None


def _texts(docs: DataFrame, id_col: str, text_col: str, chars_col: str) -> DataFrame:
    """Id, text and the stated number of characters, NULL where ``docs`` states none."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc"),
        F.col(f"`{text_col}`").alias("text"),
        _stated(docs, chars_col).alias("stated"),
    )


def _stated(docs: DataFrame, chars_col: str) -> Column:
    known = F.col(f"`{chars_col}`") if chars_col in docs.columns else F.lit(None)
    return known.cast("double")


def scorer(model: bytes | None) -> callable:
    """A column function of (text, stated characters) that gives the score."""
    loaded: list[FactorisationMachine] = []

    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        if model is not None and not loaded:
            loaded.append(FactorisationMachine.from_bytes(model))
        for texts, stated in batches:
            if model is None:
                yield pd.Series(np.full(len(texts), 0.5))
                continue
            texts, stated = list(texts), list(stated)
            cuts = [slice(low, low + SCORE_TEXTS) for low in range(0, len(texts), SCORE_TEXTS)]
            parts = [loaded[0].scores(Features(texts[cut], stated[cut], hashes)) for cut in cuts]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return F.pandas_udf(score, T.DoubleType())


def score_documents(
    docs: DataFrame,
    model: bytes | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    A score is a function of the text and its stated number of characters alone; NULL text is
    empty, and empty texts have a score too. Without a model every score is 0.5.
    """
    score = scorer(model)(F.col("text"), F.col("stated"))
    return (
        _texts(docs, id_col, text_col, chars_col)
        .withColumn("score", score)
        .select(
            F.col("doc").alias("doc_id"),
            held_out(F.col("doc")).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )


def keep_good(
    docs: DataFrame, model: bytes | None, text_col: str = "text", chars_col: str = "n_chars"
) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""
    score = scorer(model)(F.col(f"`{text_col}`"), _stated(docs, chars_col))
    return docs.filter(score >= 0.5)
