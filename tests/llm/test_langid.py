from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, SF, with_clashing_columns
from txnstar.llm import langid
from txnstar.llm.langid import LanguageFilter, gram_hashes, identify, learn, letter_codes
from txnstar.llm.queries import QUERIES

COLUMNS = ["doc_id", "held_out", "lang_pred", "score"]


def _plain_grams(text):
    """Windows of the lower-cased letters, others a blank, with blanks at the ends alone."""
    letters = [c.lower() if len(c.lower()) == 1 else c for c in text or ""]
    padded = " " + "".join(c if c.isalpha() else " " for c in letters) + " "
    return [
        (n, padded[i : i + n])
        for n in langid.LENGTHS
        for i in range(len(padded) - n + 1)
        if " " not in padded[i + 1 : i + n - 1]
    ]


def _hashed(text):
    codes, owner = letter_codes([text])
    return sorted(int(h) for part, _ in gram_hashes(codes, owner) for h in part)


def _filter(langs, texts):
    rows = np.zeros((1 << langid.ROW_BITS, -(-len(langs) // 8)), np.uint8)
    for bit, text in enumerate(texts):
        for h in _hashed(text):
            for i in range(langid.HASHES):
                rows[(h >> (langid.ROW_BITS * i)) & (len(rows) - 1), bit // 8] |= 1 << bit % 8
    return LanguageFilter.of(langs, rows)


def test_grams_are_the_windows_within_words(monkeypatch):
    texts = ["", "a", "I'm 4 you", "Été ÀÉ ǅ İx", "日本 語", "ab\U0001f600cd", "x" * 40, None]
    for block in (langid.BLOCK, 7):
        monkeypatch.setattr(langid, "BLOCK", block)
        counts, distinct = {}, {}
        for text in texts:
            plain, hashed = _plain_grams(text), _hashed(text)
            assert len(plain) == len(hashed)
            assert len(set(plain)) == len(set(hashed))
            counts[text], distinct[text] = len(plain), set(hashed)
        codes, owner = letter_codes(texts)
        found = np.concatenate([o for _, o in gram_hashes(codes, owner)])
        assert list(np.bincount(found, minlength=len(texts))) == [counts[t] for t in texts]


def test_masks_tell_every_language_of_a_gram():
    texts = ["alpha beta", "beta gamma", *[f"word{chr(97 + n)}x beta" for n in range(9)]]
    model = _filter([f"l{n:02}" for n in range(11)], texts)
    total, hits = model.counts([*texts, "beta", "zzz qqq", "", "9 _"])
    for bit, text in enumerate(texts):
        assert hits[bit, bit] == total[bit] == len(_plain_grams(text))
    assert (hits[11] == total[11]).all() and total[11] > 0
    assert hits[12].sum() == 0 < total[12]
    assert total[13] == total[14] == 0


def test_false_positives_are_taken_off():
    rows = np.zeros((1 << langid.ROW_BITS, 1), np.uint8)
    rng = np.random.default_rng(2)
    rows[rng.random(len(rows)) < 0.8, 0] |= 1  # a crowded language without n-grams of the text
    model = _filter(["aa", "bb"], ["", "quite other words here"])
    model = LanguageFilter.of(["aa", "bb"], model.rows | rows)
    assert model.rates[0] == pytest.approx(0.8**langid.HASHES, abs=0.01)
    text = " ".join("".join(map(chr, rng.integers(0x4E00, 0x9F00, 6))) for _ in range(2000))
    total, hits = model.counts([text])
    assert hits[0, 0] > 0.4 * total[0]
    _, score = model.decide([text])
    assert score[0] < 0.05
    assert model.decide(["quite other words here"])[0] == ["bb"]


def test_ties_unknown_grams_and_texts_without_letters():
    model = _filter(["aa", "bb"], ["same words", "same words"])
    langs, score = model.decide(["same", "zzz", None, "", "12 !?"])
    assert langs == ["aa", "aa", "und", "und", "und"]
    assert score[0] > 0.5 and list(score[1:]) == [0, 0, 0, 0]


def test_held_out_documents_and_missing_values_teach_nothing(spark):
    ids = {n: zlib.crc32(str(n).encode()) % 4 == 2 for n in range(400)}
    rows = [(n, "wrongly labelled text" if out else "plainly told words", "xx" if out else "en", "s", 1) for n, out in ids.items()]
    rows += [(None, "no id", "yy", "s", 1), (7001, None, "zz", "s", 1), (7002, "no label", None, "s", 1)]
    docs = with_clashing_columns(spark.createDataFrame(rows, DOCS), ["doc", "gram", "n", "share"])
    model = learn(docs)
    assert set(model.langs) <= {"en"}
    found = {r.doc_id: r for r in identify(docs, model).collect()}
    assert all(found[n].held_out == out for n, out in ids.items())
    assert found[7001].lang_pred == "und" and found[7001].score == 0
    assert found[7002].lang_pred == "en" and found[None].held_out is False


def test_repeated_ids_and_a_bounded_sample(spark):
    rows = [(1, f"text {n % 3} of one id", "en", "s", 1) for n in range(500)]
    rows += [(n, f"andere Wörter {n}", "de", "s", 1) for n in range(2000, 2200)]
    docs = spark.createDataFrame(rows, DOCS)
    first = learn(docs, sample=20)
    again = learn(docs.repartition(9, F.rand(3)), sample=20)
    assert first.langs == ["de", "en"] and (first.rows == again.rows).all()


def test_a_long_text_counts_to_its_end(spark):
    rows = [(n, t, lang, "s", 1) for n, t, lang in [(1, "these are words", "en"), (4, "das sind worte", "de")]]
    model = _filter(["de", "en"], ["das sind worte", "these are words"])
    text = "these are words " * 20_000 + "das sind worte " * 60_000
    docs = spark.createDataFrame([*rows, (9, text, None, "s", 1)], DOCS)
    found = {r.doc_id: r.lang_pred for r in identify(docs, model).collect()}
    assert found == {1: "en", 4: "de", 9: "de"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert learn(docs) is None
    assert identify(docs, None).count() == 0
    one = spark.createDataFrame([(1, "text", None, "s", 1)], DOCS)
    assert [tuple(r) for r in identify(one, learn(one)).collect()] == [(1, False, "und", 0.0)]


def test_query_on_held_out_documents(spark):
    found = QUERIES["op11_language_id"](spark, SF).select(COLUMNS)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found.count() == docs.count()
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 200 and right >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
