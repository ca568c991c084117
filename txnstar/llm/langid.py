"""Language of a text by a bit-sliced Bloom filter: one lookup tells all languages of an n-gram.

A row of the filter has one bit for each language. An n-gram of a language sets that bit in the
rows that its hash names; the rows of a hash, and-ed, are the mask of the languages that hold the
n-gram, apart from false positives, whose rate each language's share of set bits gives.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnstar.llm.frames import first_rows, sized
from txnstar.llm.words import mix64
from txnstar.sources.workdir import materialise

# Documents of each language the filters are learnt from at most, by the hashes of their ids.
LEARN_DOCUMENTS = 1000
LENGTHS = (3, 4, 5)
# An n-gram is a language's if it is so frequent there, and so frequent beside any other language.
# So a language has at most 1 / LEAST_SHARE n-grams of each length.
LEAST_SHARE = 5e-6
LEAST_OF_BEST = 0.4
ROW_BITS = 20
HASHES = 3
BLOCK = 1 << 19
BATCH_CHARS = 1 << 22
UNKNOWN = "und"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point its letter in lower case, 0 if it is no letter."""
    points = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            points[point] = ord(lower) if len(lower) == 1 else point
    return points


def letter_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts with a 0 around each text, and the text each position is of."""
    raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
    sizes = np.array([len(r) // 4 + 1 for r in raw], np.int64)
    gap = b"\0\0\0\0"
    joined = gap + gap.join(raw) + gap * LENGTHS[-1]
    codes = _letters()[np.frombuffer(joined, np.uint32)]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    return codes, owner


def gram_hashes(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(hashes, texts)`` of the n-grams of each length, a block of positions at a time.

    An n-gram lies within one word, of which it may have the ends: what is no letter is a 0,
    and only the first and last character of an n-gram may be 0.
    """
    longest = LENGTHS[-1]
    for low in range(0, len(owner), BLOCK):
        part = codes[low : low + BLOCK + longest - 1].astype(np.uint64)
        n = min(BLOCK, len(owner) - low, len(part) - longest + 1)
        hashes = part[:n]
        inside = np.ones(n, bool)
        for j in range(1, longest):
            hashes = hashes * _FACTOR + part[j : j + n]
            if j + 1 in LENGTHS:
                on = np.flatnonzero(inside & (part[j - 1 : j - 1 + n] > 0))
                yield mix64(hashes[on] + np.uint64(j)), owner[low + on]
            inside &= part[j : j + n] > 0


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have a bounded number of characters, or one long text."""
    sizes = np.asarray(pc.binary_length(batch.column("text")).fill_null(0)).astype(np.int64)
    part = np.cumsum(sizes) // BATCH_CHARS
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for low, high in zip(starts, np.append(starts[1:], len(part)), strict=True):
        yield batch.slice(low, high - low)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.asarray(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in dict.fromkeys(langs):
            codes, owner = letter_codes([texts[i] for i in np.flatnonzero(langs == lang)])
            found = [np.unique(h, return_counts=True) for h, _ in gram_hashes(codes, owner)]
            if not found:
                continue
            grams = np.concatenate([g for g, _ in found]).view(np.int64)
            yield pa.record_batch(
                {
                    "lang": pa.array([lang]).take(pa.array(np.zeros(len(grams), np.int32))),
                    "gram": pa.array(grams),
                    "n": pa.array(np.concatenate([n for _, n in found])),
                }
            )


def held_out(doc_id: Column) -> Column:
    """Documents whose languages are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class LanguageFilter:
    """Rows of language bits; ``rates`` are the false positives to expect of each language."""

    langs: list[str]
    rows: np.ndarray
    rates: np.ndarray

    @classmethod
    def of(cls, langs: list[str], rows: np.ndarray) -> LanguageFilter:
        bits = np.unpackbits(rows, axis=1, bitorder="little")[:, : len(langs)]
        return cls(langs, rows, bits.mean(axis=0) ** HASHES)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """The mask of the languages that contain each n-gram, eight languages a byte."""
        low = np.uint64(len(self.rows) - 1)
        found = self.rows[(hashes & low).astype(np.int64)]
        for i in range(1, HASHES):
            found = found & self.rows[((hashes >> np.uint64(ROW_BITS * i)) & low).astype(np.int64)]
        return found

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of n-grams of each text, and of those that each language contains."""
        codes, owner = letter_codes(texts)
        total = np.zeros(len(texts), np.int64)
        width = self.rows.shape[1]
        seen = np.zeros((width, len(texts) * 256), np.int64)
        for hashes, text in gram_hashes(codes, owner):
            total += np.bincount(text, minlength=len(texts))
            masks = self.masks(hashes)
            for byte in range(width):
                key = text * 256 + masks[:, byte]
                seen[byte] += np.bincount(key, minlength=seen.shape[1])
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        hits = [counts.reshape(len(texts), 256) @ bits.astype(np.int64) for counts in seen]
        return total, np.concatenate(hits, axis=1)[:, : len(self.langs)]

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language with most n-grams after false positives, and its share of all n-grams."""
        total, hits = self.counts(texts)
        real = (hits - total[:, None] * self.rates) / (1 - np.minimum(self.rates, 0.999))
        real = np.clip(real, 0, total[:, None])
        best = real.argmax(axis=1)
        score = real[np.arange(len(texts)), best] / np.maximum(total, 1)
        langs = [self.langs[b] if n else UNKNOWN for b, n in zip(best, total, strict=True)]
        return langs, score


def learn(
    docs: DataFrame,
    sample: int = LEARN_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageFilter | None:
    """The filter of the languages of the documents that are not held out; None without any.

    Counted are the n-grams of at most ``sample`` documents of each language, those with the
    least hashes of the id, whole. An id that repeats counts once for each language, with its least text.
    The filter has ``2 ** ROW_BITS`` rows of a bit for each language, whatever the data.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("doc"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
    )
    rows = rows.filter("doc IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.filter(~held_out(F.col("doc")))
    by_hash = [F.xxhash64("doc"), F.col("doc")]
    chosen = rows.select("doc", "lang").distinct()
    chosen = first_rows(chosen, "lang", F.reverse("doc"), by_hash, sample, "_at")
    chosen = sized(materialise(chosen.select("doc", "lang"), "learn"), 64)
    texts = rows.join(chosen, ["doc", "lang"]).groupBy("doc", "lang").agg(F.min("text").alias("text"))
    counted = texts.select("lang", "text").mapInArrow(
        _gram_counts, "lang string, gram bigint, n bigint"
    )
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "grams")
    totals = counted.groupBy("lang").agg((F.sum("n") / len(LENGTHS)).alias("total"))
    totals = totals.orderBy("lang").collect()
    if not totals:
        return None
    langs = [r["lang"] for r in totals]
    known = docs.sparkSession.createDataFrame(
        [(r["lang"], i, float(r["total"])) for i, r in enumerate(totals)],
        "lang string, bit int, total double",
    )
    share = (F.col("n") / F.col("total")).alias("share")
    grams = counted.join(F.broadcast(known), "lang").select("gram", "bit", share)
    grams = grams.filter(F.col("share") >= LEAST_SHARE)
    best = F.max("share").over(Window.partitionBy("gram"))
    grams = grams.withColumn("best", best).filter(F.col("share") >= LEAST_OF_BEST * F.col("best"))
    low = (1 << ROW_BITS) - 1
    places = [
        F.shiftrightunsigned("gram", ROW_BITS * i).bitwiseAND(F.lit(low)) for i in range(HASHES)
    ]
    width = -(-len(langs) // 8)
    set_bits = (
        grams.select(F.explode(F.array(*places)).alias("row"), "bit")
        .withColumn("at", F.col("row") * width + F.floor(F.col("bit") / 8))
        .groupBy("at")
        .agg(F.bit_or(F.expr("shiftleft(1, bit % 8)")).alias("bits"))
        .toArrow()
    )
    filled = np.zeros((1 << ROW_BITS) * width, np.uint8)
    filled[set_bits.column("at").to_numpy()] = set_bits.column("bits").to_numpy().astype(np.uint8)
    return LanguageFilter.of(langs, filled.reshape(-1, width))


def _predict(model: LanguageFilter | None) -> callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                texts = part.column("text").to_pylist()
                if model is None:
                    langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                else:
                    langs, score = model.decide(texts)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "held_out": part.column("held_out"),
                        "lang_pred": pa.array(langs, pa.string()),
                        "score": pa.array(score, pa.float64()),
                    }
                )

    return rows


def identify(
    docs: DataFrame,
    model: LanguageFilter | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``, from its whole text.

    ``score`` is the share of the text's n-grams that the language contains, false positives
    taken off. Texts without a letter, and NULL, are ``und`` with score 0, and so is everything
    without a model. A text of which no language holds an n-gram, and ties, go to the first of
    the languages in the order of their names. Extra columns are ignored.
    """
    doc = F.col(f"`{id_col}`")
    rows = docs.select(
        doc.alias("doc_id"), held_out(doc).alias("held_out"), F.col(f"`{text_col}`").alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(_predict(model), schema)
