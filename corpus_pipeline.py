"""Cleaning a corpus for training: five stages over ``documents``, each written and reread.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the
last keep the columns of documents; a stage works on all that the one before
it kept.

Defined cases, the same in every stage: a null or empty text is a clean document and stays; a null doc_id comes last and its row
stays, unless its text is removed for what it holds; rows that repeat a document are treated alike by toxicity, line dedup, decontamination and
encoding, and are one document in the n-gram Jaccard join; very long texts are worked on whole; further columns, whatever their
names, pass through all stages but the last; empty tables give empty results, and without labels or benchmark items nothing is removed by
them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lunchbox.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from lunchbox.llm.queries import tokenizer_path
from lunchbox.llm.runtime import written

TOKENIZER = "word_bpe_49k.json"


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def similar_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are nearly equal the first stays; a document that loses all its lines stays, empty."""
    return line_dedup.without_similar_lines(docs).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity 0.8 stays."""
    return jaccard_join.one_of_each_group(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are windows of benchmark items go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and digests of ids and decoded text."""
    return bpe.encoded(docs, tokenizer_path(TOKENIZER), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("line_dedup", similar_lines),
    ("ngram_jaccard_join", near_copies),
    ("decontamination", contaminated),
    ("bpe", tokens),
]

#: Similarity links, learned scores and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
