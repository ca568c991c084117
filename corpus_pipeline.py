"""A corpus from raw documents, stage by stage; each stage is written and read again."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txnstar.llm import quality_fm  # noqa: E402
from txnstar.llm.bpe import encode_documents  # noqa: E402
from txnstar.llm.cuckoo import drop_exact_copies  # noqa: E402
from txnstar.llm.frames import prepare  # noqa: E402
from txnstar.llm.mixing import take_mix  # noqa: E402
from txnstar.llm.neardup import keep_one_of_each  # noqa: E402
from txnstar.llm.queries import bpe_files  # noqa: E402
from txnstar.sources.workdir import fresh_dir, scratch  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier fitted on the labelled ones does not reject."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_fm.keep_good(docs, quality_fm.train(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each distinct text, that with the greatest id."""
    prepare(spark)
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 similarity of five-word shingles."""
    prepare(spark)
    return keep_one_of_each(docs, k=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return take_mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids)``: the tokens of every document, ready for training."""
    prepare(spark)
    return encode_documents(docs, *bpe_files())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

# The classifier and the link search are not expressible in SQL; tests compare each stage
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage writes on its way is removed after it.

    The stages' own results stay in the shared folder, one table each.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        place = fresh_dir(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
