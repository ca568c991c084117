from __future__ import annotations

import base64
import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, SF, SF_SMALL, documents, rows_of, with_clashing_columns, words
from txnstar.llm import quality_fm, queries
from txnstar.llm.bpe import ByteBpe, PairTable, decode_documents, encode_documents, round_trip
from txnstar.llm.mixing import mix, source_targets, take_mix
from txnstar.llm.queries import bpe_files

# ---- byte-level BPE ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    path, pattern = bpe_files()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(*bpe_files())


def _ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def test_pair_table_finds_all_and_only_its_pairs():
    rng = np.random.default_rng(1)
    left, right = rng.integers(0, 50_000, (2, 5000)).astype(np.int32)
    keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
    keys, at = np.unique(keys, return_index=True)
    table = PairTable(keys, np.arange(len(keys), dtype=np.int32))
    assert (table.merged(left[at], right[at]) == np.arange(len(keys))).all()
    other = table.merged(right[at], left[at] + np.int32(60_000))
    assert (other == np.iinfo(np.int32).max).all()


def test_ids_equal_the_library_on_random_texts(library, bpe):
    rng = random.Random(3)
    alphabets = ["ab", "a", "aé漢字😀 ", "abc \n\t", "0123456789", "%$#&*!", "\x1c\x85\xa0 a", "theandor", "<|endoftext|>"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice([0, 1, 4, 40, 900]))) for _ in range(600)]
    texts += ["".join(rng.choice(a) for _ in range(3000)) for a in alphabets]
    assert [_ids(x) for x in bpe.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert [bpe.decode(x).decode() for x in bpe.encode(texts)] == texts


def test_a_lower_rank_that_appears_in_a_merge_of_many_places_is_taken_at_once(tmp_path):
    # "ab" < "abc" but "bcab" < "ab": merging every "ab" of a long row first would be wrong.
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"bca", b"ab", b"abab", b"cab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for r, t in enumerate(tokens)))
    own = ByteBpe(str(path), r"(?s).+")
    ranks = {t: r for r, t in enumerate(tokens)}
    rng = random.Random(5)
    for size in (10, 700):
        for _ in range(20):
            text = "".join(rng.choice("abc") for _ in range(size))
            parts = [bytes([b]) for b in text.encode()]
            while True:
                pairs = [(ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, at = min(pairs, default=(1 << 30, 0))
                if rank == 1 << 30:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            assert _ids(own.encode([text])[0]) == [ranks[p] for p in parts]


def test_documents_round_trip(spark, library):
    rows = [(1, "Hello there world"), (2, None), (3, ""), (4, "é漢 😀\n\n  x"), (5, "a" * 5000), (5, "a" * 5000), (None, "no id")]
    docs = with_clashing_columns(documents(spark, rows), ["ids", "decoded"])
    found = rows_of(round_trip(docs, *bpe_files()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    expected = []
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        data = np.array(ids, "<u4").tobytes()
        expected.append((doc, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=repr)
    encoded = encode_documents(docs, *bpe_files()).withColumn("ids", F.when(F.col("doc_id") != 1, F.col("ids")))
    back = decode_documents(encoded, *bpe_files())
    assert back.filter("doc_id = 1").first()["decoded"] is None
    assert round_trip(spark.createDataFrame([], DOCS), *bpe_files()).count() == 0


def test_whole_table_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in round_trip(docs, *bpe_files()).collect()}
    for r in docs.collect():
        ids = np.array(library.encode_ordinary(r.text), "<u4")
        assert found[r.doc_id] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())


def test_other_rank_file(spark):
    vocab = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = documents(spark, [(1, "Nothing to merge here, or is there?")])
    out = decode_documents(encode_documents(docs, vocab, public_tokenizers.PATTERN), vocab, public_tokenizers.PATTERN)
    assert bytes(out.first()["decoded"]) == b"Nothing to merge here, or is there?"


# ---- mixing -----------------------------------------------------------------------------------


def _targets(sizes: dict) -> dict:
    """Share by weight, cap at three times the size, share the excess anew, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * rest > 3 * sizes[s] * share}
        if not above:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * rest / share for s in names}
        capped |= above


def test_targets(spark):
    for sizes in (
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 500, "c": 7, "d": 0, None: 30, "Z": 12, "é": 40},
        {"a": 0},
        {"only": 9},
        {"a": 10, "b": 1, "c": 1, "d": 1, "e": 1000},
    ):
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        for in_a_task in (100, 0):
            rows = source_targets(frame, in_a_task=in_a_task).collect()
            found = {r.source: 3.0 * r.source_size if r.capped else r.share * r.rest / r.free for r in rows}
            assert found == pytest.approx(_targets(sizes))


def _mixture(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["b", "c", None, "É"]
    return [(n, " ".join(["w"] * rng.choice([0, 1, 3, 10, 200])), rng.choice(sources)) for n in range(1500)]


def test_words_taken_come_near_the_targets(spark):
    rows = _mixture(1)
    docs = with_clashing_columns(documents(spark, rows), ["size", "point", "target", "_source", "words"])
    found = mix(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    source_of, size_of = {r[0]: r[2] for r in rows}, {r[0]: len(words(r[1])) for r in rows}
    targets, taken = _targets(sizes), defaultdict(int)
    for r in found:
        source = source_of[r.doc_id]
        assert r.size == size_of[r.doc_id] and r.source_size == sizes[source]
        assert r.target == pytest.approx(targets[source])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[source] += r.taken
    assert len(found) == len(rows)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 100  # half of the longest document
    again = rows_of(mix(docs.repartition(3)), "doc_id", "taken")
    assert again == sorted(((r.doc_id, r.taken) for r in found), key=repr)


def test_mixing_awkward_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y", "a"), (3, "x y", "a"), (None, "z", None), (None, "z", None), (4, "q " * 5000, "a")]
    found = rows_of(mix(documents(spark, rows)), "doc_id", "size", "taken")
    assert len(found) == len(rows)
    assert [t for d, _, t in found if d == 3][0] == [t for d, _, t in found if d == 3][1]
    assert mix(spark.createDataFrame([], DOCS)).count() == 0
    assert take_mix(spark.createDataFrame([], DOCS)).count() == 0


def test_rows_are_taken_as_often_as_the_mix_says(spark):
    rows = [(n, t, s) for n, t, s in _mixture(2) if t]
    docs = documents(spark, rows)
    times = {r.doc_id: r.times for r in mix(docs).collect()}
    out = take_mix(docs)
    assert out.columns == docs.columns
    counted = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counted == {d: t for d, t in times.items() if t}


# ---- the quality classifier ---------------------------------------------------------------------


def test_pairwise_sum_equals_its_definition():
    texts = ["one two two THREE!!", "", None, "a\na\na"]
    features = quality_fm.Features(texts, [19.0, None, float("nan"), 5.0])
    edges = np.quantile(features.stats, np.linspace(0, 1, quality_fm.BINS + 1)[1:-1], axis=0)
    model = quality_fm.FactorisationMachine(edges.astype(np.float32))
    model.linear += 0.1
    owner, slot, value = features.with_bins(model.edges)
    for row, margin in enumerate(model.margins(features)):
        s, x = slot[owner == row], value[owner == row]
        v = model.factors[s]
        pairs = sum(float(v[i] @ v[j]) * x[i] * x[j] for i in range(len(s)) for j in range(i))
        assert margin == pytest.approx(0.1 * x.sum() + pairs, abs=1e-4)
    again = quality_fm.FactorisationMachine.from_bytes(model.to_bytes())
    assert (again.margins(features) == model.margins(features)).all()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality_fm.train(docs, labels)
    scored = quality_fm.score_documents(docs, model)
    assert scored.count() == docs.count()
    known = scored.join(labels, "doc_id").filter("held_out")
    right = known.filter("predicted = quality").count() / known.count()
    assert right > 0.98
    clean = known.filter("quality = 1")
    assert clean.filter("predicted = 1").count() / clean.count() > 0.995


def test_scores_depend_on_nothing_but_the_text(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_fm.train(docs, labels)
    before = {r.doc_id: r.score for r in quality_fm.score_documents(docs, model).collect()}
    changed = docs.withColumns({"doc_id": F.col("doc_id") + 1_000_000, "lang": F.lit("zz"), "source": F.lit(None).cast("string")})
    after = quality_fm.score_documents(changed.repartition(3), model).collect()
    assert {r.doc_id - 1_000_000: r.score for r in after} == pytest.approx(before, abs=1e-6)
    flipped = labels.withColumn("quality", F.when(quality_fm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_fm.train(docs, flipped) == model


def test_quality_of_awkward_rows(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    learnt = quality_fm.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), labels)
    rows = [(1, None), (2, ""), (3, "word " * 30_000), (3, "word " * 30_000), (None, "no id")]
    docs = with_clashing_columns(documents(spark, rows), ["score", "stated", "label", "doc"])
    for model in (learnt, None):
        found = quality_fm.score_documents(docs, model).collect()
        assert len(found) == len(rows)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
        kept = quality_fm.keep_good(docs, model)
        assert kept.columns == docs.columns
    empty = spark.createDataFrame([], DOCS)
    assert quality_fm.score_documents(empty, learnt).count() == 0
    assert quality_fm.train(empty, labels) is None
    assert quality_fm.train(docs, labels.filter("false")) is None
    no_chars = docs.drop("n_chars")
    assert quality_fm.score_documents(no_chars, learnt).count() == len(rows)


def _labelled(n: int) -> list[tuple]:
    rng = random.Random(11)
    return [(i, " ".join(rng.choice(("good", "Bad!", "w1", "é", "9")) for _ in range(rng.randint(0, 12)))) for i in range(n)]


def test_all_of_8000_labels_are_learnt_from(spark):
    rows = _labelled(9000)
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int("good" in t)) for i, t in rows], "doc_id bigint, quality int")
    learnable = labels.filter(~quality_fm.held_out(F.col("doc_id"))).count()
    assert 4000 < learnable < 8000
    assert quality_fm.train(docs, labels) == quality_fm.train(docs, labels, sample=learnable)


def test_the_fit_of_features_from_many_tasks_is_that_of_the_texts(spark):
    rows = [*_labelled(600), (600, None), (601, "")]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    docs = documents(spark, rows)
    held = {r[0] for r in docs.select("doc_id").filter(quality_fm.held_out(F.col("doc_id"))).collect()}
    learnt = [(i, t) for i, t in rows if i not in held]
    features = quality_fm.Features([t for _, t in learnt], [None if t is None else float(len(t)) for _, t in learnt])
    edges = np.quantile(features.stats, np.linspace(0, 1, quality_fm.BINS + 1)[1:-1], axis=0)
    plain = quality_fm.FactorisationMachine(edges.astype(np.float32))
    plain.fit(features, np.array([i % 2 for i, _ in learnt], np.float32))
    assert quality_fm.train(docs.repartition(5), labels) == plain.to_bytes()


def test_an_id_with_several_texts_teaches_the_least(spark):
    rows = _labelled(300)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    again = [(i, "語 " * (i % 5 + 1) + t) for i, t in rows if t and i % 3 == 0]
    learnt = quality_fm.train(documents(spark, rows), labels)
    for mixed in (rows + again, again[::-1] + rows):
        assert quality_fm.train(documents(spark, mixed).repartition(7), labels) == learnt


def test_scores_of_the_query_are_those_of_the_definition(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_fm.FactorisationMachine.from_bytes(quality_fm.train(docs, labels))
    linear, factors = model.linear.astype(float), model.factors.astype(float)
    found = {r.doc_id: r for r in queries.QUERIES["op1_quality_classifier"](spark, SF_SMALL).collect()}
    given = docs.select("doc_id", "text", "n_chars").collect()
    assert len(found) == len(given)
    for doc in given:
        n_chars = None if doc.n_chars is None else float(doc.n_chars)
        _, slot, value = quality_fm.Features([doc.text], [n_chars]).with_bins(model.edges)
        scaled = factors[slot] * value[:, None].astype(float)
        products = scaled @ scaled.T
        pairs = np.triu(products, 1).sum()
        margin = float(model.bias[0]) + linear[slot] @ value + pairs
        row = found[doc.doc_id]
        assert row.score == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -30, 30))), abs=1e-4)
        assert row.predicted == (row.score >= 0.5)
