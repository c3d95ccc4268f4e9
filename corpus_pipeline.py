"""A corpus-cleaning pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
back as the next stage's docs. All but the last return the columns of docs.
"""

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barwright.llm import bpe, decontam, langid, linededup, minhash  # noqa: E402
from barwright.llm.common import discard, stage, table  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return langid.with_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines near an earlier one go, and documents that keep no line with words."""
    return linededup.without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return minhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a run of ten words with a benchmark item go."""
    return decontam.without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the remaining texts, per doc_id, and digests of the texts decoded from them."""
    coded = bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokenization", tokenization),
]

#: Language ID, MinHash and BPE have no SQL form; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        docs, path = stage(step(spark, docs, sf_dir), name)
        discard(spark, *before)  # what this stage has read
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
