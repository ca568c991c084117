"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnstar.llm import (
    collocation,
    html_trees,
    langid,
    merkle,
    mixing,
    neardup,
    quality_fm,
    url_rules,
    warc,
)
from txnstar.llm.bpe import round_trip
from txnstar.llm.cuckoo import exact_duplicates
from txnstar.llm.fingerprint import edit_report
from txnstar.llm.frames import prepare
from txnstar.llm.secrets import secret_report

Query = Callable[[SparkSession, str], DataFrame]
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_files() -> tuple[str, str]:
    """Path of the rank file and the splitting pattern, from the installed vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_fm.train(docs, _table(spark, sf_dir, "labels"))
    return quality_fm.score_documents(docs, model)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(_table(spark, sf_dir, "pages"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("times")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_trees.extract_main_text(pages, html_trees.train(pages))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), *bpe_files())


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_secrets": op2_secrets,
    "op3_url_rules": op3_url_rules,
    "op4_warc": op4_warc,
    "op5_fingerprints": op5_fingerprints,
    "op6_mixing": op6_mixing,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_exact_duplicates": op8_exact_duplicates,
    "op9_html_extraction": op9_html_extraction,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_language_id": op11_language_id,
    "op12_collocations": op12_collocations,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op3_url_rules": url_rules.ORACLE,
    "op4_warc": warc.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_near_duplicates": neardup.ORACLE,
    "op8_exact_duplicates": """
        WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
              FROM t GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size,
               doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM t JOIN g USING (text_sha256)""",
    "op12_collocations": collocation.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
