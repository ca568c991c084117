"""URL filtering by a bit-parallel automaton of wildcard rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnstar.llm.frames import only

# (verdict, host and path); a host stands for its subdomains too, a path for what it starts.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# Where no rule fits: a URL is blocked if a glob of (host, path) fits it, else allowed.
BLOCKED_GLOBS = (
    ("ads.*", "*"),
    ("*.ads.*", "*"),
    ("*", "*.exe"),
    ("*", "*.zip"),
    ("*", "*/login*"),
    ("*", "*/wp-admin/*"),
)
# Bytes that occur in no UTF-8 text: the start of a URL, and the end of its host.
START, HOST_END = 0xFE, 0xFF
CELLS = 1 << 22


class GlobAutomaton:
    """All globs at once by Shift-And over masks of as many 64-bit words as they need.

    Each symbol of a pattern but ``*`` is a bit. A step shifts all bits by one, with the
    carry from word to word, and keeps those whose symbol is the byte read; a bit before
    a ``*`` also stays where it is. ``?`` fits any byte. URLs of a batch advance together.
    """

    def __init__(self, patterns: list[list[int | str]]):
        symbols: list[int | str] = []
        stays, firsts, self.lasts = set(), [], []
        for pattern in patterns:
            firsts.append(len(symbols))
            symbols.append(START)
            for symbol in pattern:
                if symbol == "*":
                    stays.add(len(symbols) - 1)
                else:
                    symbols.append(symbol)
            self.lasts.append(len(symbols) - 1)
        words = -(-len(symbols) // 64)
        self.masks = np.zeros((256, words), np.uint64)
        self.stay, self.first = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        for at, symbol in enumerate(symbols):
            bit = np.uint64(1 << (at % 64))
            if symbol == "?":
                self.masks[:START, at // 64] |= bit
            else:
                self.masks[symbol, at // 64] |= bit
        for target, places in ((self.stay, stays), (self.first, firsts)):
            for at in places:
                target[at // 64] |= np.uint64(1 << (at % 64))

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """``(texts, patterns)``: which pattern fits which whole text."""
        out = np.zeros((len(texts), len(self.lasts)), bool)
        order = sorted(range(len(texts)), key=lambda x: len(texts[x]))
        low = 0
        while low < len(order):
            high, width = low, 0
            while high < len(order) and (
                high == low or len(texts[order[high]]) * (high + 1 - low) <= CELLS
            ):
                high += 1
            rows = order[low:high][::-1]
            width = len(texts[rows[0]])
            sizes = np.array([len(texts[x]) for x in rows])
            table = np.zeros((len(rows), width), np.uint8)
            table[np.arange(width) < sizes[:, None]] = np.frombuffer(
                b"".join(texts[x] for x in rows), np.uint8
            )
            out[rows] = self._run(table, sizes)
            low = high
        return out

    def _run(self, table: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        state = np.broadcast_to(self.first, (len(table), len(self.first))).copy()
        active = np.searchsorted(-sizes, -np.arange(table.shape[1]), side="left")
        for at in range(table.shape[1]):
            here = state[: active[at]]
            step = here << np.uint64(1)
            step[:, 1:] |= here[:, :-1] >> np.uint64(63)
            step &= ~self.first
            step &= self.masks[table[: active[at], at]]
            state[: active[at]] = step | (here & self.stay)
        return np.stack(
            [(state[:, x // 64] >> np.uint64(x % 64)) & np.uint64(1) for x in self.lasts], axis=1
        ).astype(bool)


def _symbols(glob: str) -> list[int | str]:
    out: list[int | str] = []
    for char in glob:
        out.extend([char] if char in "*?" else char.encode("utf-8", "surrogatepass"))
    return out


def rule_pattern(rule: str) -> list[int | str]:
    """``example.net/en/`` as a glob: that host or a subdomain, and a path it starts."""
    host, slash, path = rule.partition("/")
    literal = list(f".{host}".encode()), list(f"{slash}{path}".encode())
    return ["*", *literal[0], HOST_END, *literal[1], "*"]


def glob_pattern(host: str, path: str) -> list[int | str]:
    return [ord("."), *_symbols(host), HOST_END, *_symbols(path)]


def canonical(host: str, path: str) -> bytes:
    """What the automaton reads: a dot, the host, its end, the path."""
    data = f".{host}".encode("utf-8", "surrogatepass") + bytes([HOST_END])
    return data + path.encode("utf-8", "surrogatepass")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, parts, g), F.lit("")) for g in (1, 2))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, letters, letters.lower()), path


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple = RULES,
    blocked_globs: tuple = BLOCKED_GLOBS,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``.

    The longest rule that fits gives the verdict; of two equally long ones the blocking, then
    the lesser. Without one, a URL is blocked if a glob fits its host and path, else
    allowed. A NULL URL, or one without ``://``, has an empty host and path. Rules and
    globs are patterns of one automaton, built once per task. Extra columns are ignored.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))
    patterns = [rule_pattern(r) for _, r in ranked] + [glob_pattern(*g) for g in blocked_globs]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobAutomaton(patterns)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            texts = [canonical(h, p) for h, p in zip(hosts, paths, strict=True)]
            fits = automaton.matches(texts)
            by_rule, by_glob = fits[:, : len(ranked)], fits[:, len(ranked) :].any(axis=1)
            first = by_rule.argmax(axis=1) if ranked else np.zeros(len(texts), int)
            some = by_rule.any(axis=1)
            rule = [ranked[f][1] if s else None for f, s in zip(first, some, strict=True)]
            verdict = [
                ranked[f][0] if s else "block" if g else "allow"
                for f, s, g in zip(first, some, by_glob, strict=True)
            ]
            yield batch.append_column("rule", pa.array(rule, pa.string())).append_column(
                "verdict", pa.array(verdict, pa.string())
            )

    rows = only(pages, page_id=id_col, url=url_col)
    host, path = url_parts(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(
        judge, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


ORACLE = r"""
    WITH p AS (
        SELECT page_id,
            translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    r(verdict, rule, h, p) AS (
        VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
            ('block', 'example.com/de/', 'example.com', '/de/'),
            ('allow', 'org/fr/', 'org', '/fr/')),
    m AS (
        SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule
        FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p)
        GROUP BY page_id, host, path)
    SELECT p.page_id, p.host, p.path, m.rule,
        coalesce(r.verdict, CASE WHEN starts_with(p.host, 'ads.') OR contains(p.host, '.ads.')
            OR ends_with(p.path, '.exe') OR ends_with(p.path, '.zip')
            OR contains(p.path, '/login') OR contains(p.path, '/wp-admin/')
            THEN 'block' ELSE 'allow' END) AS verdict
    FROM p LEFT JOIN m ON p.page_id IS NOT DISTINCT FROM m.page_id
        AND p.host = m.host AND p.path = m.path
    LEFT JOIN r ON m.rule = r.rule"""
