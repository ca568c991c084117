"""Byte-level BPE over length-bucketed numpy matrices."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnstar.llm.frames import only

NONE = np.int32(np.iinfo(np.int32).max)
# Pieces a task remembers, cells of one matrix, and texts it handles at a time.
MAX_PIECES = 150_000
MATRIX_CELLS = 1 << 18
BATCH_TEXTS = 256
# Pieces of up to so many bytes more than the last multiple share a matrix; longer ones go alone.
BUCKET_STEP = 4
LONG_PIECE = 512
_P = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Merged id of two neighbouring ids: a hash table in arrays, probed in lockstep."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.values = np.full(1 << bits, NONE, np.int32)
        free = self.keys[0]
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            open_ = self.keys[at] == free
            _, first = np.unique(at[open_], return_index=True)
            win = todo[open_][first]
            self.keys[slot[win]], self.values[slot[win]] = keys[win], values[win]
            todo = np.setdiff1d(todo, win, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _P) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id, which is also the rank, of each pair; ``NONE`` where there is none."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32)
        slot = self._slot(keys)
        out = np.full(keys.shape, NONE, np.int32)
        flat, todo = out.ravel(), np.arange(keys.size)
        keys, slot = keys.ravel(), slot.ravel()
        free = np.uint64(0xFFFFFFFFFFFFFFFF)
        while len(todo):
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            flat[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found != free)]
            slot[todo] = (slot[todo] + 1) & self.mask
        return out


class ByteBpe:
    """Encoder and decoder for a file of ``base64(token) rank`` lines."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.split = regex.compile(pattern).findall
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = PairTable(
            np.fromiter(pairs, np.uint64, len(pairs)),
            np.fromiter(pairs.values(), np.int32, len(pairs)),
        )
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > MAX_PIECES:
            self.known.clear()
        pieces = [self.split(t) for t in texts]
        self._learn(list(set().union(*pieces).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, p)) for p in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces: whole tokens at once, the rest by length in matrices."""
        rest, raw = [], []
        for piece in pieces:
            data = piece.encode("utf-8")
            rank = self.ranks.get(data)
            if rank is None:
                rest.append(piece)
                raw.append(data)
            else:
                self.known[piece] = rank.to_bytes(4, "little")
        order = sorted(range(len(raw)), key=lambda x: len(raw[x]))
        low = 0
        while low < len(order):
            width = len(raw[order[low]])
            if width > LONG_PIECE:
                ids = self._merge_long(self.byte_ids[np.frombuffer(raw[order[low]], np.uint8)])
                self.known[rest[order[low]]] = ids.astype("<u4").tobytes()
                low += 1
                continue
            width = -(-width // BUCKET_STEP) * BUCKET_STEP
            high = low
            most = low + max(1, MATRIX_CELLS // width)
            while high < min(most, len(order)) and len(raw[order[high]]) <= width:
                high += 1
            rows = order[low:high]
            for x, ids in zip(rows, self._merge_matrix([raw[x] for x in rows], width), strict=True):
                self.known[rest[x]] = ids
            low = high

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Each round, every row merges its leftmost pair of least rank.

        Rows are padded with -1, which is in no pair. A merge takes one id and one pair out of
        its row, so every round compacts the matrices by a column; only the two pairs about
        the merge are looked up again. Rows without a pair are done and leave the matrix.
        """
        sizes = np.array([len(p) for p in pieces])
        inside = np.arange(width) < sizes[:, None]
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((len(pieces), width - 1), NONE, np.int32)
        pair = inside[:, 1:]
        rank[pair] = self.pairs.merged(ids[:, :-1][pair], ids[:, 1:][pair])
        out: list[bytes] = [b""] * len(pieces)
        name = np.arange(len(pieces))
        while len(name):
            rows = np.arange(len(name))
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(name), np.int64)
            best = rank[rows, at] if rank.shape[1] else np.full(len(name), NONE)
            done = best == NONE
            if done.any():
                ends = zip(name[done].tolist(), sizes[done].tolist(), ids[done], strict=True)
                for x, size, row in ends:
                    out[x] = row[:size].tobytes()
                go = ~done
                ids, rank, sizes, name = ids[go], rank[go], sizes[go], name[go]
                at, best, rows = at[go], best[go], rows[: len(name)]
                if not len(name):
                    break
            n, width = ids.shape
            ids[rows, at] = best
            column = np.arange(width)
            ids = ids[column != at[:, None] + 1].reshape(n, width - 1)
            rank = rank[column[:-1] != at[:, None]].reshape(n, width - 2)
            sizes = sizes - 1
            for spot in (at - 1, at):
                ok = (spot >= 0) & (spot + 1 < sizes)
                r, c = rows[ok], spot[ok]
                rank[r, c] = self.pairs.merged(ids[r, c], ids[r, c + 1])
        return out

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: all places of the least rank merge in a round, left to right.

        That is what merging them one by one gives, provided no merge makes a pair of a
        lower rank; where one does, only the leftmost merges.
        """
        rank = self.pairs.merged(ids[:-1], ids[1:])
        while len(rank) and (best := rank.min()) != NONE:
            at = np.flatnonzero(rank == best)
            run = np.cumsum(np.diff(at, prepend=-2) != 1)
            start = at[np.searchsorted(run, run)]
            at = at[(at - start) % 2 == 0]
            while True:
                merged = ids.copy()
                merged[at] = best
                stay = np.ones(len(ids), bool)
                stay[at + 1] = False
                merged = merged[stay]
                spot = at - np.arange(len(at))
                near = np.unique(np.concatenate([spot - 1, spot]))
                near = near[(near >= 0) & (near + 1 < len(merged))]
                found = self.pairs.merged(merged[near], merged[near + 1])
                if len(at) == 1 or not (found < best).any():
                    break
                at = at[:1]
            kept = rank[stay[:-1]] if stay[-1] else rank[stay[:-1]][: len(merged) - 1]
            rank = kept[: len(merged) - 1].copy()
            rank[near] = found
            ids = merged
        return ids


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(
    docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, ids)``: the tokens of each whole text, little-endian unsigned 32-bit.

    ``vocab`` is the path of a rank file that every executor can read, ``pattern`` splits a
    text into the pieces that are merged separately. NULL and empty texts have no ids. Special
    tokens are ordinary text. Extra columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocab, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(low, BATCH_TEXTS)
                ids = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.record_batch(
                    {"doc_id": part.column(0), "ids": pa.array(ids, pa.binary())}
                )
        bpe.known.clear()  # the worker goes on to other tasks

    texts = only(docs, doc_id=id_col, text=text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, ids binary")


def decode_documents(encoded: DataFrame, vocab: str, pattern: str) -> DataFrame:
    """``encoded`` with the bytes its ``ids`` stand for in ``decoded``; NULL stays NULL."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocab, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(low, BATCH_TEXTS)
                given = part.column("ids").to_pylist()
                texts = [None if ids is None else bpe.decode(ids) for ids in given]
                yield part.append_column("decoded", pa.array(texts, pa.binary()))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]
    return encoded.mapInArrow(rows, ", ".join([*fields, "decoded binary"]))


def round_trip(
    docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the encoded and decoded texts."""
    encoded = encode_documents(docs, vocab, pattern, id_col, text_col)
    return decode_documents(encoded, vocab, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
