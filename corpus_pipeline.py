"""Corpus pipeline: quality, language, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  All but the last return the columns of `docs`; the last returns the
packed pieces.  Edge cases are those of the operators: empty and null texts have
no word, so the first stage rejects them; an empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from capture_lake.llm.common import stored_table, table
from capture_lake.llm.langid import keep_known, train
from capture_lake.llm.quality import keep_good
from capture_lake.llm.simhash import one_per_group
from capture_lake.llm.surrogates import pseudonymize
from capture_lake.llm.swap_packing import pack_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality, by their own evidence and their site's, is good enough."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_known(docs, train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data."""
    return pseudonymize(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens packed into sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality),
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("pii_surrogates", personal_data),
    ("best_fit_packing", packing),
]

#: SQL has no byte-pair tokenizer and no trained classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage kept is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
