from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import DOCS, SF_SMALL, with_clashing_columns
from txnstar.llm import merkle
from txnstar.llm.merkle import tamper_report
from txnstar.llm.queries import QUERIES
from txnstar.llm.sha_state import FIRST, build, resume, to_states

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "tampered"]


def _sha(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row) -> str:
    return _sha("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def _levels(nodes):
    out = []
    while len(nodes) > 1:
        out.append(nodes)
        nodes = [_sha(nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return out, nodes[0]


def _brute(rows):
    """The report from rows ``(doc_id, source, lang, n_chars, text)``, tree by tree."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[k] = _levels([_leaf(r) for r in groups[k]])
    upper, root = _levels([trees[k][1] for k in keys])
    out = []
    for at, k in enumerate(keys):
        for i, r in enumerate(groups[k]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = r[4]
            if hit and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now, proof = _leaf((*r[:4], text)), []
            for levels, pos in ((trees[k][0], i), (upper, at)):
                for nodes in levels:
                    low = pos // 16 * 16
                    run = nodes[low : low + 16]
                    proof += run[: pos - low] + run[pos - low + 1 :]
                    run[pos - low] = now
                    now, pos = _sha(run), pos // 16
            out.append((r[0], _leaf(r), trees[k][1], root, _sha(proof), now, now == root, hit))
    return sorted(out, key=repr)


def _frame(spark, rows):
    ordered = [(r[0], r[4], r[2], r[1], r[3]) for r in rows]
    return spark.createDataFrame(ordered, DOCS)


def _found(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def test_parents_and_resumed_folds_are_sha256():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 256, (60, 32)).astype(np.uint8)
    size = np.array([16, 3, 1, 16, 7])
    first = np.array([0, 16, 19, 20, 36])
    states, digests = build(pool, first, size)
    at = 0
    for f, n, digest in zip(first, size, digests, strict=True):
        hexes = [row.tobytes().hex() for row in pool[f : f + n]]
        assert digest.tobytes().hex() == _sha(hexes)
        for slot in range(n):
            new = rng.integers(0, 256, (1, 32)).astype(np.uint8)
            state = to_states(states[at + slot : at + slot + 1])
            right, where = np.array([n - slot - 1]), np.array([f + slot + 1])
            found = resume(state, new, pool, where, right, np.array([n]))
            changed = [*hexes[:slot], new.tobytes().hex(), *hexes[slot + 1 :]]
            assert found.tobytes().hex() == _sha(changed)
        at += n
    assert (to_states(states[:1]) == FIRST).all()


@pytest.mark.parametrize("n,sources", [(1, 1), (17, 1), (300, 40), (4500, 3)])
def test_report_equals_the_tree_built_plainly(spark, n, sources):
    rng = random.Random(n)
    names = [None, *[f"s{j}é" for j in range(sources - 1)]] if sources > 1 else ["x"]
    rows = [
        (
            rng.choice([None, i, i, i, 7]),
            rng.choice(names),
            rng.choice([None, "en"]),
            rng.choice([None, i]),
            rng.choice([None, "", "Ab cÉ", "x", "Long " * 300]),
        )
        for i in range(n)
    ]
    docs = with_clashing_columns(_frame(spark, rows).repartition(5), ["key", "pos", "n", "tie"])
    assert _found(tamper_report(docs)) == _brute(rows)


def test_equal_rows_and_one_source_with_most_rows(spark):
    rows = [(None, "hot", "en", 3, "abc")] * 700 + [(i, "hot", "en", 1, "A") for i in range(600)]
    rows += [(i, f"s{i}", None, None, None) for i in range(20)]
    docs = _frame(spark, rows).repartition(7)
    assert _found(tamper_report(docs)) == _brute(rows)


def test_result_does_not_depend_on_partitions(spark, conf):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(900)]
    first = _found(tamper_report(_frame(spark, rows).repartition(3)))
    conf("spark.sql.shuffle.partitions", "29")
    conf("spark.sql.adaptive.enabled", "false")
    assert _found(tamper_report(_frame(spark, rows).repartition(11))) == first
    assert {r[6] for r in first} == {True, False}
    assert all(r[6] != r[7] for r in first)


def test_empty_table(spark):
    assert tamper_report(spark.createDataFrame([], DOCS)).count() == 0


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SF_SMALL}/documents.parquet'")
    expected = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.ORACLE})").fetchall()
    con.close()
    assert _found(QUERIES["op13_merkle_manifest"](spark, SF_SMALL)) == sorted(expected, key=repr)
