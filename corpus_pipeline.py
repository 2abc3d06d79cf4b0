"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again.

1. toxicity: documents predicted toxic go.
2. near_copies: of documents linked by n-gram Jaccard likeness one stays.
3. decontamination: documents that hold a benchmark window go.
4. mixing: every document as often as its source's target takes it.
5. tokens: ids packed into files in id order; the rows are the files' index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattle.llm.common import keep, read
from wattle.llm.decontam import drop_contaminated
from wattle.llm.mixing import mixed_rows
from wattle.llm.ngram_join import drop_near_copies
from wattle.llm.tokens import tokenize_documents
from wattle.llm.toxicity import drop_toxic
from wattle.session import apply_runtime_conf


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is 0.5 or more."""
    apply_runtime_conf(spark)
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    apply_runtime_conf(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a window of a benchmark item."""
    apply_runtime_conf(spark)
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that each source meets its target."""
    apply_runtime_conf(spark)
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes packed token ids in id order and returns the files' index."""
    apply_runtime_conf(spark)
    return tokenize_documents(docs)


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("decontamination", decontamination),
          ("mixing", mixing), ("tokens", tokens)]
#: SQL can express neither the fitted classifier nor the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
