"""The registered queries and the pipeline, against SQL and against plain versions."""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.helpers import DOCS, SF, SF_SMALL, brute_components, documents, words
from tests.llm.test_bpe_mixing_quality import _targets
from txnstar.llm import quality_fm
from txnstar.llm.queries import ORACLES, QUERIES, bpe_files

TABLES = ["documents", "pages", "labels"]
COLUMNS = {
    "op1": {"doc_id", "held_out", "score", "predicted"},
    "op2": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op3": {"page_id", "host", "path", "rule", "verdict"},
    "op4": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op5": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op6": {"doc_id", "size", "source_size", "target", "taken"},
    "op7": {"doc_id", "n_shingles", "component_id", "kept"},
    "op8": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op9": {"page_id", "url", "text", "n_chars"},
    "op10": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op11": {"doc_id", "held_out", "lang_pred", "score"},
    "op12": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "op13": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
}


def test_every_operator_is_registered_over_its_whole_table(spark):
    known = contract.queries()
    assert {name.split("_")[0] for name in QUERIES} == set(COLUMNS)
    assert known["pipeline"] is corpus_pipeline.run and set(QUERIES) < set(known)
    for name, query in QUERIES.items():
        found = query(spark, SF_SMALL)
        number = name.split("_")[0]
        assert COLUMNS[number] <= set(found.columns), name
        if number == "op12":  # ranks of phrases
            continue
        table = "pages" if number in ("op3", "op4", "op9") else "documents"
        assert found.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count(), name


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    ours = QUERIES[name](spark, SF).toArrow()
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    expected = con.execute(ORACLES[name]).to_arrow_table().select(ours.column_names)
    con.register("ours", ours)
    con.register("expected", expected)
    assert ours.num_rows == expected.num_rows
    for a, b in (("ours", "expected"), ("expected", "ours")):
        rows = con.execute(f"SELECT count(*) FROM (FROM {a} EXCEPT ALL FROM {b})").fetchall()
        assert rows == [(0,)]


def test_near_duplicates_of_a_whole_table_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = QUERIES["op7_near_duplicates"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(rows, 4, 80)


def _mix(rows: list[tuple]) -> dict:
    """How often each document is taken, by sorting every source by hash."""
    size, by_source = {}, defaultdict(list)
    for doc, text, source in rows:
        size[doc] = len(words(text))
        by_source[source].append(doc)
    targets = _targets({s: sum(size[d] for d in docs) for s, docs in by_source.items()})
    times = {}
    for source, docs in by_source.items():
        total = sum(size[d] for d in docs)
        whole = int(targets[source] // total) if total else 0
        budget, before = targets[source] - whole * total, 0
        for doc in sorted(docs, key=lambda d: int(hashlib.md5(str(d).encode()).hexdigest()[:13], 16) >> 2):
            more = whole < 3 and 2 * (budget - before) >= size[doc]
            before += size[doc]
            times[doc] = whole + more if size[doc] else 1
    return times


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_fm.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality_fm.score_documents(docs, model).collect() if r.predicted}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good]
    last = {}
    for doc, text, _ in rows:
        last[text] = max(doc, last.get(text, doc))
    rows = [r for r in rows if last[r[1]] == r[0]]
    component = brute_components([r[:2] for r in rows], 5, 80)
    rows = [r for r in rows if component[r[0]] == r[0]]
    times = _mix(rows)
    path, pattern = bpe_files()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    expected = sorted(
        (doc, np.array(library.encode_ordinary(text), "<u4").tobytes())
        for doc, text, _ in rows
        for _ in range(times[doc])
    )
    found = sorted((r.doc_id, bytes(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert found == expected


def test_stages_take_awkward_documents(spark):
    rows = [
        (1, None), (2, ""), (3, "word " * 20_000), (4, "one two"), (4, "one two"), (4, "one two three"),
        (None, "one two"), (None, "no id"), (5, " \n "), (6, "é 漢字 😀"),
    ]
    docs = documents(spark, rows)
    empty = spark.createDataFrame([], DOCS)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mixing", "encoding"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != "encoding":
            assert out.columns == docs.columns
            assert stage(spark, empty, SF_SMALL).columns == docs.columns
        assert out.count() <= 3 * len(rows)
        assert stage(spark, empty, SF_SMALL).count() == 0
    kept = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, SF_SMALL)
    texts = sorted(r.text or "" for r in kept.collect())
    assert texts == sorted({t or "" for _, t in rows})


def test_the_pipeline_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = dict(corpus_pipeline.STAGES)["quality"](spark, docs, SF)
    clean = labels.filter("quality = 1").join(docs.select("doc_id"), "doc_id")
    held = clean.filter(quality_fm.held_out(clean["doc_id"]))
    stays = held.join(kept.select("doc_id"), "doc_id", "left_semi").count()
    assert stays / held.count() > 0.99
