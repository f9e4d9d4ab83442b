"""From documents to packed training sequences: five stages over whole tables.

Every stage reads the Parquet its predecessor wrote and keeps the columns of
``documents`` (doc_id, text, lang, source, n_chars); the last one returns the
placed pieces. A lost executor re-reads the last written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import scratch_path, table
from quire.llm.langid import keep_identified
from quire.llm.mixing import mixed_documents
from quire.llm.ngram_trie import keep_first
from quire.llm.packing import pack_documents
from quire.llm.pii import sanitise
from quire.session import staging

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject."""
    return keep_identified(docs.select(*COLUMNS))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return keep_first(docs.select(*COLUMNS), n=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and revealing terms replaced in their texts."""
    return sanitise(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: documents once an epoch, the last cut at the budget."""
    return mixed_documents(docs.select(*COLUMNS))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack_documents(docs.select(*COLUMNS))


STAGES = [("language_id", language_id), ("ngram_join", ngram_join), ("pii", pii), ("source_mix", source_mix), ("best_fit", best_fit)]

#: SQL has neither the tokenizer nor the compressor; tests/llm checks run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with staging(spark):                    # what a stage staged goes when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
