from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import DOCS, SF, with_clashing_columns
from txnstar.llm import collocation
from txnstar.llm.collocation import collocations, phrase_counts, piece_words
from txnstar.llm.fm_index import FmIndex
from txnstar.llm.queries import QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def _pieces(text):
    parts = re.split(r"[.,;:!?\x0A-\x0D]", _lower(text))
    return [re.findall(r"[^\x20\x09]+", p) for p in parts]


def _grams(rows, most):
    counts, total = {}, Counter()
    for lang, text in rows:
        for words in _pieces(text):
            total[lang or "und"] += len(words)
            for k in range(1, most + 1):
                c = counts.setdefault(lang or "und", Counter())
                c.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts, total


def _brute(rows, most=3, least=10, top=2000):
    counts, total = _grams(rows, most)
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [
                b
                for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if all(100 * b < 50 * a for b in longer):
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, x, y) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, total[lang], -score))
    return sorted(out)


def _found(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def _rows(seed, n):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "é", "ÉT", "d-e", "x y", "ß", "\x00z", "m", "(o)"]
    seps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", ";", "?!", "\x0b", "\r\n"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.choice([0, 1, 5, 40, 200])))
        rows.append((rng.choice(["en", "fr", None, "und"]), rng.choice([text, text, text, None, ""])))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)], DOCS)


@pytest.mark.parametrize("depth", [2, 3, 5])
def test_index_enumerates_phrases_from_either_side(depth):
    rng = random.Random(depth)
    for size in (0, 1, 7, 90, 600):
        ids = [rng.randrange(7) for _ in range(size)] + [0]
        index = FmIndex(np.array(ids, np.int32), depth)
        for sides in ([True] * depth, [False] * depth, [True, False] * depth):
            found = index.single()
            for d in range(1, depth + 1):
                grams = (tuple(ids[i : i + d]) for i in range(len(ids) - d + 1))
                expected = Counter(g for g in grams if 0 not in g)
                got = {tuple(map(int, w)): int(c) for w, c in zip(found.words, found.count, strict=True)}
                assert got == expected
                if d < depth:
                    found = index.extended(found, sides[d])
                    half = found.where(np.arange(len(found)) % 2 == 0)
                    assert len(half) == (len(found) + 1) // 2


def test_index_of_many_words_orders_by_several_keys():
    rng = np.random.default_rng(3)
    ids = np.append(rng.integers(1, 1 << 20, 500), 0).astype(np.int32)
    ids[100:200] = ids[300:400]
    index = FmIndex(ids, 5)
    found = index.single()
    for _ in range(4):
        found = index.extended(found)
    twice = {tuple(w) for w, c in zip(found.words, found.count, strict=True) if c == 2}
    assert {tuple(ids[i : i + 5]) for i in range(100, 196)} <= twice


def test_words_and_pieces_follow_the_definition():
    for _, text in _rows(9, 60) + [(None, " \t. \n"), (None, "a\xffb ÿ")]:
        marked = piece_words(text)
        pieces = [w.decode().split(" ") if w else [] for w in b" ".join(marked).split(b"\xff")]
        plain = [[w for w in p if w] for p in pieces]
        assert [p for p in plain if p] == [p for p in _pieces(text) if p]


@pytest.mark.parametrize("shard,most,least", [(1_500_000, 3, 10), (300, 3, 4), (150, 4, 3), (500, 2, 2)])
def test_collocations_equal_plain_counting(spark, monkeypatch, shard, most, least):
    monkeypatch.setattr(collocation, "SHARD_WORDS", shard)
    rows = _rows(shard, 120)
    docs = with_clashing_columns(_frame(spark, rows).repartition(4), ["words", "phrase", "count", "a"])
    found = collocations(docs, max_words=most, least=least, top=300)
    assert _found(found) == _brute(rows, most, least, 300)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = _rows(5, 80)
    monkeypatch.setattr(collocation, "_passes", lambda bits, hashes: np.ones(len(hashes), bool))
    assert _found(collocations(_frame(spark, rows))) == _brute(rows)


def test_counts_above_64_bits_in_products_and_a_hot_pair(spark):
    text = "hot pair " * 40_000 + "cold"
    rows = [("en", text)] * 3 + [("en", "hot stone. cold pair")] * 50
    assert _found(collocations(_frame(spark, rows).repartition(3))) == _brute(rows)


def test_empty_tables_and_texts(spark):
    assert collocations(_frame(spark, [])).count() == 0
    assert collocations(_frame(spark, [("en", None), ("en", " . "), (None, "")])).count() == 0
    counts = phrase_counts(_frame(spark, [("en", "a b. a b"), ("fr", None)]), 3, 2)
    assert sorted(map(tuple, counts.collect())) == [
        ("en", 0, "", 4), ("en", 1, "a", 2), ("en", 1, "b", 2), ("en", 2, "a b", 2),
    ]


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    expected = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({collocation.ORACLE})").fetchall()
    con.close()
    assert _found(QUERIES["op12_collocations"](spark, SF)) == sorted(expected)
