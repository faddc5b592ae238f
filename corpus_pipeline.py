"""A training corpus from raw documents: languages, near-duplicates, benchmark leaks, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import discard, saved, table
from sparkloom.llm.decontaminate import without_contaminated
from sparkloom.llm.langid import accepted
from sparkloom.llm.near_dedup import first_of_groups
from sparkloom.llm.packing import pack_documents
from sparkloom.llm.pii import sanitised
from sparkloom.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return first_of_groups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with identifiers and disclosing words replaced in their texts."""
    clean = sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), 2)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]
#: A trained classifier, tokenizers and a packing plan are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; what a stage kept is deleted when the next has read it."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs, path = saved(stage(spark, docs, sf_dir), name)
        discard(spark, *before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
