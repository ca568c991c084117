"""Secrets in texts, also behind nested URL, Unicode, base64 and compressed layers."""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnstar.llm.frames import only

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 24 and more are the runs of any length that have 24.
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED, MIN_ACCESS = 6, 20

# What is held of a compressed layer at a time, in bytes; a larger one is read in windows.
LAYER_BUDGET = 16 * 1024 * 1024
# Bytes of layers for each byte of a text, beyond which only bombs go: deflate's greatest ratio.
LAYER_RATIO = 1032
# What a decompressor gives at a time, and how often data may have been compressed.
PIECE_BYTES = 1 << 16
PACKED_LEVELS = 64
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPES = re.compile(
    r"(?:\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2})|\\u[0-9A-Fa-f]{4}"
    r"|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
    r"|[！-～]"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Lines of base64; a line end may be written as an escape, and a line indented or quoted.
_LINE_END = r"[ \t]*(?:\r?\n|\r|(?:\\r)?\\n)[ \t>]*"
_WRAPPED = re.compile(
    rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}+(?:{_LINE_END}[A-Za-z0-9+/_-]++)++={{0,2}}"
)
# Runs of plain characters as long as the shortest secret, in one byte or two each.
_RUNS = (
    (re.compile(rb"[\x20-\x7e\t\r\n]{12,}"), "ascii", 1),
    (re.compile(rb"(?:[\x20-\x7e\t\r\n]\x00){12,}"), "utf-16-le", 2),
    (re.compile(rb"(?:\x00[\x20-\x7e\t\r\n]){12,}"), "utf-16-be", 2),
)
# Base64 of what compressed data begins with, and as much as tells whether it does.
_PACKED_START = re.compile(r"H4sI|Qlpo|[/_]Td6|e[AFJN]")
PACKED_HEAD = 256
_LINES = re.compile(rf"({_LINE_END})|[A-Za-z0-9+/_-]+")


@dataclass
class Source:
    """The range of the layer before that a range of characters comes from, layer by layer."""

    back: Callable[[int, int], tuple[int, int]]
    before: Source | None


@dataclass
class Layer:
    """A text, and where its characters, and all of it, come from in the first text."""

    text: str
    source: Source | None
    whole: tuple[int, int]

    def origin(self, start: int, end: int) -> tuple[int, int]:
        source = self.source
        while source is not None:
            start, end = source.back(start, end)
            source = source.before
        return start, end


@dataclass
class Packed:
    """Compressed data, and the characters of the first text that it was decoded from."""

    data: bytes
    whole: tuple[int, int]


_ERRORS = (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError)


class _TooMuch(Exception):
    """A text's layers hold more than any but bombs do."""


def find(text: str) -> Iterator[tuple[int, int, int]]:
    """``(kind, start, end)`` of every secret that stands openly in ``text``."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_ASSIGNED:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= MIN_ACCESS:
                yield 1, m.start(), m.end()
    for m in HEX.finditer(text):
        yield 2, m.start(), m.end()


def _spliced(layer: Layer, parts: list[tuple[int, int, str, int]]) -> Layer | None:
    """``layer`` with each ``[start, end)`` replaced by a text.

    Each character of it comes from the next ``width`` characters, or from all where that is 0.
    """
    if not parts:
        return None
    texts, done = [], 0
    at, low, high, widths = (array("q") for _ in range(4))

    def piece(text: str, start: int, end: int, width: int) -> None:
        if text:
            at.append(at[-1] + len(texts[-1]) if texts else 0)
            low.append(start)
            high.append(end)
            widths.append(width)
            texts.append(text)

    for start, end, text, width in parts:
        piece(layer.text[done:start], done, start, 1)
        piece(text, start, end, width)
        done = end
    piece(layer.text[done:], done, len(layer.text), 1)

    def back(start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(at, start) - 1, bisect_right(at, end - 1) - 1
        last = low[j] + (end - at[j]) * widths[j] if widths[j] else high[j]
        return low[i] + (start - at[i]) * widths[i], last

    return Layer("".join(texts), Source(back, layer.source), layer.whole)


def _unpercent(layer: Layer) -> Iterator[Layer]:
    if "%" not in layer.text:
        return
    parts = []
    for m in _PERCENT.finditer(layer.text):
        data = bytes.fromhex(m.group().replace("%", ""))
        try:
            text = data.decode("utf-8")
        except UnicodeDecodeError:
            text = data.decode("latin-1")
        if len(text) == len(data):
            parts.append((m.start(), m.end(), text, 3))
            continue
        start = m.start()
        for char in text:
            end = start + 3 * len(char.encode())
            parts.append((start, end, char, 0))
            start = end
    if found := _spliced(layer, parts):
        yield found


def _unescape(layer: Layer) -> Iterator[Layer]:
    text = layer.text
    if "\\" not in text and "&#" not in text and text.isascii():
        return
    parts = []
    for m in _ESCAPES.finditer(text):
        code = m.group()
        if "！" <= code <= "～":
            value = ord(code) - 0xFEE0
        elif code.startswith("&#"):
            value = int(code[3:-1], 16) if code[2] in "xX" else int(code[2:-1])
        elif len(code) == 12:
            value = 0x10000 + ((int(code[2:6], 16) & 0x3FF) << 10) + (int(code[8:], 16) & 0x3FF)
        else:
            value = int(code[2:].strip("{}"), 16)
        if value < 0x110000 and not 0xD800 <= value < 0xE000:
            parts.append((m.start(), m.end(), chr(value), 0))
    if found := _spliced(layer, parts):
        yield found


def _opener(data: bytes) -> Callable | None:
    """What opens compressed data, by its magic number."""
    if data[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    return None


def _opens(data: bytes) -> bool:
    """Whether ``data`` begins as its magic number says; that of zlib is short, and met by chance."""
    try:
        _opener(data)().decompress(data[:256])
    except _ERRORS:
        return False
    return True


def _inflated(
    chunks: Iterator[bytes], open_one: Callable, charge: Callable[[int], None]
) -> Iterator[bytes]:
    """All members or streams of compressed data, up to an error.

    An error takes with it what the same call gave. So zlib goes back then and on byte by
    byte; bz2 and lzma, which cannot go back, are fed so from the start.
    """
    opener = open_one()
    slow = not hasattr(opener, "copy")
    for chunk in chunks:
        while chunk:
            at, rest = 0, b""
            while at < len(chunk) and not opener.eof:
                step = 1 if slow else len(chunk) - at
                before = None if slow else opener.copy()
                try:
                    data = opener.decompress(chunk[at : at + step], PIECE_BYTES)
                    rest = getattr(opener, "unconsumed_tail", b"")
                except _ERRORS:
                    if slow:
                        return
                    opener, slow = before, True
                    continue
                at += step - len(rest)
                while data:
                    charge(len(data))
                    yield data
                    full = len(data) == PIECE_BYTES and not rest and not opener.eof
                    try:
                        data = opener.decompress(b"", PIECE_BYTES) if full else b""
                    except _ERRORS:
                        return
            chunk = (opener.unused_data if opener.eof else b"") + chunk[at:]
            if opener.eof:
                chunk = chunk.lstrip(b"\0")  # padding between streams
                if chunk:
                    opener = open_one()


def _opened(data: bytes, charge: Callable[[int], None]) -> Iterator[bytes]:
    """``data`` uncompressed, as often as it was compressed, a piece at a time."""
    chunks: Iterator[bytes] = iter([data])
    for _ in range(PACKED_LEVELS):
        head = b""
        while len(head) < 6 and (more := next(chunks, b"")):
            head += more
        chunks = chain([head], chunks)
        open_one = _opener(head)
        if open_one is None:
            return chunks
        chunks = _inflated(chunks, open_one, charge)
    raise _TooMuch


def _windows(packed: Packed, size: int, charge: Callable[[int], None]) -> Iterator[Layer | None]:
    """What ``packed`` opens to, in windows that overlap by half; None if there are several."""

    def layers(data: bytes, first: bool) -> Iterator[Layer]:
        for text, _, _ in _texts(data, first, whole=False):
            yield Layer(text, Source(lambda start, end: packed.whole, None), packed.whole)

    held, first = bytearray(), True
    for chunk in _opened(packed.data, charge):
        held += chunk
        while len(held) > size:
            if first:
                yield None
            yield from layers(bytes(held[:size]), first)
            del held[: max(1, size // 2)]
            first = False
    yield from layers(bytes(held), first)  # it may have ended by an error


def _texts(
    data: bytes, first: bool = True, whole: bool = True
) -> Iterator[tuple[str, int, int | None]]:
    """The texts in ``data``: each with its first byte, and the bytes of a character if fixed.

    Data that is UTF-8 with few odd characters is one text. Of any other, such as Latin-1, UTF-16 or
    a binary format, all runs of plain characters that can hold a secret are texts. What is not the
    first of its layer may begin within a character, and what is not whole may end within one.
    """
    skip = 0
    if not first:
        skip = next((n for n in range(min(4, len(data))) if data[n] & 0xC0 != 0x80), 0)
    try:
        text = codecs.getincrementaldecoder("utf-8")().decode(data[skip:], whole)
    except UnicodeDecodeError:
        text = ""
    odd = sum(not (c.isprintable() or c in "\t\r\n") for c in text)
    if text and odd * 20 <= len(text):
        yield text, skip, None
        return
    for pattern, coding, width in _RUNS:
        for m in pattern.finditer(data):
            yield m.group().decode(coding), m.start(), width


def _wrapped(text: str) -> Iterator[list[tuple[int, int]]]:
    """Ranges of lines that may be one base64 text.

    These are all the lines of a block, and each run of lines of one width, with the line
    before it and a shorter one after it and without, as lines beside it may be other words.
    A secret of a block that can be read in several ways may have several spans.
    """
    for m in _WRAPPED.finditer(text):
        lines = [x.span() for x in _LINES.finditer(text, m.start(), m.end()) if x[1] is None]
        widths = [end - start for start, end in lines]
        wanted, at = {(0, len(lines))}, 0
        while at < len(lines):
            end = at + 1
            while end < len(lines) and widths[end] == widths[at]:
                end += 1
            befores = {at, max(0, at - 1)}
            afters = {end, end + (end < len(lines) and widths[end] < widths[at])}
            wanted |= {(a, b) for a in befores for b in afters if b - a > 1}
            at = end
        for a, b in sorted(wanted):
            yield lines[a:b]


def _unbase64(layer: Layer) -> Iterator[Layer | Packed]:
    """What runs of base64 characters hold, from each of the four places a group may begin at.

    Other letters, digits, slashes, dashes or underscores may stand right before the base64.
    Compressed data is looked for at every place, unless the whole run is compressed data.
    """
    for m in _BASE64.finditer(layer.text):
        start = m.start()
        stop = start + len(m.group().rstrip("="))
        packed = False
        for skip in range(4):
            for found in _decoded(layer, [(start + skip, stop)], m.end()):
                packed = packed or isinstance(found, Packed) and _opens(found.data)
                yield found
            if packed:
                break
        if packed:
            continue
        for cut in _PACKED_START.finditer(layer.text, start, stop):
            begin = cut.start()
            if begin - start > 3 and _begins_packed(layer.text[begin : min(stop, begin + PACKED_HEAD)]):
                yield from _decoded(layer, [(begin, stop)], m.end())
    for lines in _wrapped(layer.text):
        yield from _decoded(layer, lines, lines[-1][1])


def _bytes_of(token: str) -> bytes | None:
    """Base64 without its padding, of either alphabet."""
    token = token.replace("-", "+").replace("_", "/")
    token = token[: len(token) - (len(token) % 4 == 1)]
    try:
        return base64.b64decode(token + "=" * (-len(token) % 4), validate=True)
    except binascii.Error:
        return None


def _begins_packed(token: str) -> bool:
    data = _bytes_of(token)
    return data is not None and _opener(data) is not None and _opens(data)


def _decoded(layer: Layer, lines: list[tuple[int, int]], end: int) -> Iterator[Layer | Packed]:
    """What the base64 in ``lines``, ranges of ``layer``, holds."""
    data = _bytes_of("".join(layer.text[a:b] for a, b in lines))
    if data is None:
        return
    whole = layer.origin(lines[0][0], end)
    if _opener(data) is not None:
        yield Packed(data, whole)
        if _opens(data):
            return
    for text, first, width in _texts(data):
        back = _base64_back(text, lines, first, width)
        yield Layer(text, Source(back, layer.source), whole)


def _base64_back(
    text: str, lines: list[tuple[int, int]], first: int = 0, width: int | None = None
) -> Callable[[int, int], tuple[int, int]]:
    """The base64 characters in ``lines`` that characters of the decoded text come from.

    The text begins at byte ``first``; its characters have ``width`` bytes, or those of UTF-8.
    """
    sizes = None
    if not text.isascii():
        sizes = np.cumsum([0, *(len(c.encode()) for c in text)])
    at = array("q", [0])
    for start, end in lines:
        at.append(at[-1] + end - start)

    def place(char: int) -> int:
        line = bisect_right(at, char) - 1
        return lines[line][0] + char - at[line]

    def back(start: int, end: int) -> tuple[int, int]:
        if sizes is not None:
            start, end = int(sizes[start]), int(sizes[end])
        elif width is not None:
            start, end = start * width, end * width
        start, end = first + start, first + end
        return place(start * 8 // 6), place(min(-(-end * 8 // 6), at[-1]) - 1) + 1

    return back


def scan(text: str, budget: int = LAYER_BUDGET) -> tuple[list, list, bool]:
    """``(base, all, whole)``: spans ``(start, kind, end)`` in order, openly and in all layers.

    Layers wait in a list; each is unwrapped in every way, and what comes out waits in turn,
    until nothing new does. A layer equal to an earlier one over the same characters is not
    taken again, so cycles end. Compressed layers wait as they are and are opened one at a time;
    one of more than ``budget`` bytes is read to its end in windows of that size. Its secrets are
    all found, but a layer within it only if it fits half a window, so ``whole`` is false;
    it is also where layers hold more than ``LAYER_RATIO`` times the text and ``budget``.
    """
    base = sorted((start, kind, end) for kind, start, end in find(text))
    spans, seen, whole = set(base), set(), True
    waiting: list[Layer | Packed | Iterator] = [Layer(text, None, (0, len(text)))]
    left = budget + LAYER_RATIO * len(text)

    def charge(size: int) -> None:
        nonlocal left
        left -= size
        if left < 0:
            raise _TooMuch

    def take(child: Layer | Packed) -> None:
        is_text = isinstance(child, Layer)
        data = child.text.encode("utf-8", "surrogatepass") if is_text else child.data
        key = is_text, hashlib.sha256(data).digest(), child.whole
        if key in seen:
            return
        seen.add(key)
        charge(len(data))
        if is_text:
            for kind, start, end in find(child.text):
                first, last = child.origin(start, end)
                spans.add((first, kind, last))
        waiting.append(child)

    while waiting:
        layer = waiting.pop()
        try:
            if isinstance(layer, Layer):
                for child in chain(_unpercent(layer), _unescape(layer), _unbase64(layer)):
                    take(child)
                continue
            windows = _windows(layer, budget, charge) if isinstance(layer, Packed) else layer
            for window in windows:
                if window is None:
                    whole = False
                    continue
                waiting.append(windows)
                take(window)
                break
        except _TooMuch:
            return base, sorted(spans), False
    return base, sorted(spans), whole


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, spans, n_assign, n_access, n_hex, whole)`` for every row of ``docs``.

    ``base`` and ``spans`` list ``kind:start:end`` by start, then kind, then end; offsets count
    code points of the given text, also for a secret in a layer, whose span is that of the
    characters it was decoded from. The counts are those of ``base``. NULL text is empty.
    ``whole`` is false where layers were too large to follow all (see ``scan``). Extra columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py() or "") for t in batch.column(1)]
            counts = [[sum(k == x for _, k, _ in base) for base, _, _ in found] for x in range(3)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "base": pa.array([_written(b) for b, _, _ in found], pa.string()),
                    "spans": pa.array([_written(s) for _, s, _ in found], pa.string()),
                    "n_assign": pa.array(counts[0], pa.int64()),
                    "n_access": pa.array(counts[1], pa.int64()),
                    "n_hex": pa.array(counts[2], pa.int64()),
                    "whole": pa.array([w for _, _, w in found], pa.bool_()),
                }
            )

    texts = only(docs, doc_id=id_col, text=text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        rows,
        f"doc_id {kind}, base string, spans string, n_assign bigint, n_access bigint,"
        " n_hex bigint, whole boolean",
    )


def secret_report(docs: DataFrame) -> DataFrame:
    """``find_secrets`` with the digest of the openly standing secrets in place of their list."""
    return find_secrets(docs).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        "whole",
    )
