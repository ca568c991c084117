"""Phrases whose words occur together more than their parts explain, for each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnstar.llm.fm_index import FmIndex
from txnstar.llm.frames import first_rows, only, sized
from txnstar.llm.words import mix64, seeds64, to_bytes
from txnstar.sources.workdir import materialise

SHARD_WORDS = 1_000_000
HELD_WORDS = 2_000_000
MAX_WORDS = 3
LEAST_COUNT = 10
CONTAINED_PERCENT = 50
SCALE = 1_000_000
TOP = 2000
UNKNOWN = "und"
# The frequent phrases that a round extends, as a filter of so many bits, whatever their number.
FILTER_BITS = 1 << 26
FILTER_KEYS = 3
ROWS_OUT = 65_536
_END = b"\xff"  # in no UTF-8 text
_SPACED_END = b" \xff "


def _plain_bytes() -> bytes:
    """A-Z in lower case, what ends a piece as one mark, tabs as blanks."""
    table = bytearray(bytes(range(256)).lower())
    for byte in b".,;:!?\n\x0b\x0c\r":
        table[byte] = _END[0]
    table[ord("\t")] = ord(" ")
    return bytes(table)


_PLAIN = _plain_bytes()


def piece_words(text: str | None) -> list[bytes]:
    """The words of a text in order, with a mark between pieces."""
    return to_bytes(text).translate(_PLAIN).replace(_END, _SPACED_END).split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class _Shard:
    """The words of one language's texts as numbers, pieces ended by 0."""

    def __init__(self) -> None:
        self.numbers = _Numbers({_END: 0})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str | None) -> int:
        words = piece_words(text)
        words.append(_END)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)
        return len(words)

    def ids(self) -> np.ndarray:
        return np.concatenate(self.parts)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Shard]]:
    """Shards of whole texts; one text of more words than a shard is a shard of its own."""
    open_shards: dict[str, _Shard] = {}
    held = 0
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang, text in zip(langs, texts, strict=True):
            shard = open_shards.setdefault(lang, _Shard())
            held += shard.add(text)
            full = lang if shard.size >= SHARD_WORDS else None
            if full is None and held >= HELD_WORDS:  # of many languages
                full = max(open_shards, key=lambda x: open_shards[x].size)
            if full is not None:
                shard = open_shards.pop(full)
                held -= shard.size
                yield full, shard
    while open_shards:
        yield open_shards.popitem()


def _hashes(lang: str, vocabulary: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in vocabulary], np.uint64)


def _phrase_hashes(word_hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    found = np.zeros(len(words), np.uint64)
    for column in range(words.shape[1]):
        found = mix64(found * np.uint64(31) + word_hashes[words[:, column]] + np.uint64(column))
    return found


def _places(hashes: np.ndarray) -> np.ndarray:
    """The bits of the filter that each phrase sets."""
    seeds = seeds64(FILTER_KEYS, 12)
    return (mix64(hashes[:, None] ^ seeds) % np.uint64(FILTER_BITS)).astype(np.int64)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = _places(hashes)
    return ((bits[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def _rows_out(lang: str, vocabulary: pa.Array, words: np.ndarray, count: np.ndarray) -> Iterator:
    for low in range(0, len(count), ROWS_OUT):
        part = words[low : low + ROWS_OUT]
        columns = [vocabulary.take(pa.array(part[:, i])) for i in range(part.shape[1])]
        phrase = columns[0]
        if len(columns) > 1:
            phrase = pc.binary_join_element_wise(*columns, pa.scalar(b" "))
        n = len(part)
        yield pa.record_batch(
            {
                "lang": pa.array([lang]).take(pa.array(np.zeros(n, np.int32))),
                "words": pa.array(np.full(n, part.shape[1], np.int32)),
                "phrase": phrase.cast(pa.string()),
                "count": pa.array(count[low : low + ROWS_OUT].astype(np.int64)),
            }
        )


def _mine(length: int, bits: np.ndarray | None) -> callable:
    """Counts of the phrases of ``length`` words in each shard.

    The first round also counts words, and all words together as the phrase of none. Later
    rounds extend only phrases that pass the filter, and keep extensions whose last words pass.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in _shards(batches):
            words = list(shard.numbers)
            vocabulary = pa.array(words, pa.binary())
            index = FmIndex(shard.ids(), length)
            del shard
            found = index.single()
            if bits is None:
                total = np.array([found.count.sum()])
                nothing = pa.array([b""], pa.binary())
                yield from _rows_out(lang, vocabulary, found.words, found.count)
                if total[0]:
                    for batch in _rows_out(lang, nothing, np.zeros((1, 1), np.int64), total):
                        yield batch.set_column(1, "words", pa.array([0], pa.int32()))
                found = index.extended(found)
            else:
                hashes = _hashes(lang, words)
                for size in range(2, length + 1):
                    found = index.extended(found)
                    if size == length - 1:
                        found = found.where(_passes(bits, _phrase_hashes(hashes, found.words)))
                found = found.where(_passes(bits, _phrase_hashes(hashes, found.words[:, 1:])))
            yield from _rows_out(lang, vocabulary, found.words, found.count)

    return rows


_COUNTED = "lang string, words int, phrase string, count bigint"


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 64-bit words of the filter that frequent phrases set, merged in each batch."""
    for batch in batches:
        hashes = np.zeros(batch.num_rows, np.uint64)
        for i, (lang, phrase) in enumerate(
            zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)
        ):
            parts = phrase.encode().split(b" ")
            hashes[i] = _phrase_hashes(_hashes(lang, parts), np.arange(len(parts))[None])[0]
        places = _places(hashes).ravel()
        at, back = np.unique(places >> 6, return_inverse=True)
        bits = np.zeros(len(at), np.uint64)
        np.bitwise_or.at(bits, back, np.uint64(1) << (places & 63).astype(np.uint64))
        yield pa.record_batch({"at": pa.array(at), "bits": pa.array(bits.view(np.int64))})


def _filter(frequent: DataFrame) -> np.ndarray:
    """A Bloom filter of the frequent phrases; the driver gets at most ``FILTER_BITS / 64`` rows."""
    rows = frequent.select("lang", "phrase").mapInArrow(_filter_words, "at bigint, bits bigint")
    rows = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bits


def phrase_counts(
    docs: DataFrame, max_words: int, least: int, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """``(lang, words, phrase, count)`` of all phrases up to ``max_words`` that occur ``least`` times.

    The row of no words has the number of all words of the language. Each task indexes the
    texts it reads in shards, enumerates the phrases of a length with their counts, and the
    counts are summed over the shards. A phrase can only be frequent if the phrases it extends
    are, so each round passes those to the shards as a filter of fixed size; what passes by
    mistake is counted and dropped, so a full filter costs time and nothing else.
    """
    texts = only(docs, lang=lang_col, text=text_col)
    texts = texts.withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)))
    every, bits = None, None
    for length in range(2, max_words + 1):
        found = texts.mapInArrow(_mine(length, bits), _COUNTED)
        found = found.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("count"))
        found = materialise(found.filter(f"count >= {int(least)} OR words = 0"), "counts")
        if length < max_words:
            bits = _filter(found.filter(f"words = {length}"))
        every = found if every is None else every.union(found)
    return every


def _cuts(candidates: DataFrame) -> DataFrame:
    """A row for each place at which a candidate can be cut in two."""
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    rows = candidates.select("lang", "phrase", "words", "a", cut).withColumn("w", words)
    first = F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("first")
    rest = F.array_join(F.slice("w", F.col("cut") + 1, F.col("words")), " ").alias("rest")
    return rows.select("lang", "phrase", "words", "a", "cut", first, rest)


def _contained(candidates: DataFrame, max_words: int) -> DataFrame:
    """``(lang, phrase, most)``: the count of the commonest candidate around a shorter phrase."""
    longer = candidates.filter("words > 2").withColumn("w", F.split("phrase", " "))
    sizes = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    longer = longer.select("lang", "a", "w", "words", sizes)
    begins = F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("begin")
    inner = longer.select("lang", "a", "w", "size", begins)
    inner = inner.select(
        "lang", "a", F.array_join(F.slice("w", F.col("begin"), F.col("size")), " ").alias("phrase")
    )
    return inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))


def collocations(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    least: int = LEAST_COUNT,
    contained_percent: int = CONTAINED_PERCENT,
    top: int = TOP,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases.

    Words are runs of bytes other than blank and tab in pieces that end at ``.,;:!?`` or line
    and page ends, A-Z lower-cased. A candidate has 2 to ``max_words`` words and occurs ``least``
    times; its score is the least over its cuts of ``floor(1000000 * a * a / (l * r))`` in exact
    arithmetic, the first such cut giving ``l`` and ``r``. A candidate within a longer one that
    occurs in ``contained_percent`` of its places or more is dropped. ``n`` counts all words.

    NULL text is empty, NULL language is ``und``. Repeated rows count each time. Languages
    without a candidate, and empty tables, have no rows. Ties are broken by count and then by the
    phrase's bytes, so ranks are reproducible. Extra columns are ignored.
    """
    counts = phrase_counts(docs, max_words, least, lang_col, text_col)
    candidates = counts.filter("words >= 2").withColumnRenamed("count", "a")
    parts = counts.filter(f"words BETWEEN 1 AND {max_words - 1}").select("lang", "phrase", "count")
    parts = sized(parts, 64)
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("count").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r"))
    big = "decimal(38,0)"
    square = (F.col("a").cast("decimal(19,0)") * F.col("a").cast("decimal(13,0)")).cast(big)
    scored = (
        _cuts(candidates)
        .join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("top", (square * F.lit(SCALE).cast("decimal(7,0)")).cast(big))
        .withColumn("base", (F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")).cast(big))
        .withColumn("score", F.expr("top div base"))
        .groupBy("lang", "phrase")
        .agg(
            F.first("a").alias("a"),
            F.min(F.struct("score", "cut", "l", "r")).alias("least"),
        )
    )
    around = sized(materialise(_contained(candidates, max_words), "contained"), 64)
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("most") < contained_percent * F.col("a"), F.lit(True))
    )
    order = [F.col("least.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    kept = first_rows(kept, "lang", F.col("phrase"), order, top, "rank")
    totals = counts.filter("words = 0").select("lang", F.col("count").alias("n"))
    totals = sized(materialise(totals, "totals"), 64)
    return kept.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "least.l", "least.r", "n", F.col("least.score").alias("score")
    )


ORACLE = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, unnest(
            regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    w AS (
        SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
        FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
    t AS (SELECT lang, p, unnest(w) AS one, unnest(range(len(w))) AS i FROM w),
    next AS (
        SELECT lang, one, lead(one) OVER (PARTITION BY p ORDER BY i) AS two,
            lead(one, 2) OVER (PARTITION BY p ORDER BY i) AS three
        FROM t),
    grams AS (
        SELECT lang, 1 AS k, one AS phrase FROM next
        UNION ALL SELECT lang, 2, one || ' ' || two FROM next WHERE two IS NOT NULL
        UNION ALL SELECT lang, 3, one || ' ' || two || ' ' || three FROM next
            WHERE three IS NOT NULL),
    counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts
          WHERE k > 1 AND f >= 10),
    cuts AS (
        SELECT c.lang, c.phrase, c.k, c.a, j, x.f AS l, y.f AS r,
            ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM c, (SELECT unnest([1, 2]) AS j)
        JOIN counts x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
        JOIN counts y ON y.lang = c.lang AND y.k = c.k - j
            AND y.phrase = array_to_string(c.w[j + 1:c.k], ' ')
        WHERE j < c.k),
    best AS (
        SELECT * FROM cuts
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inner_phrases AS (
        SELECT lang, phrase, max(a) AS most FROM (
            SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE k = 3
            UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE k = 3)
        GROUP BY lang, phrase),
    kept AS (
        SELECT b.* FROM best b LEFT JOIN inner_phrases i
            ON i.lang = b.lang AND i.phrase = b.phrase
        WHERE i.most IS NULL OR 100 * i.most < 50 * b.a)
    SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
        phrase, a, l, r, n, score
    FROM kept k JOIN totals ON totals.lang = k.lang
    QUALIFY rank <= 2000"""
