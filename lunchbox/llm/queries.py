"""The registered queries: each operator on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lunchbox.llm import (bpe, decontaminate, fingerprint, hard_negatives, jaccard_join, language, language_model, line_dedup, quality, token_files,
                           toxicity, warc_fixity, whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; on the driver only."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(_table(spark, sf_dir, "documents"))


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return warc_fixity.audit(warc_fixity.stored(pages), warc_fixity.damaged_replica(pages))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(_table(spark, sf_dir, "documents"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_documents(_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(_table(spark, sf_dir, "embeddings"), hard_negatives.SHIFTED_LABEL)


QUERIES = {f.__name__: f for f in (
    op1_decontaminate,
    op2_language_model,
    op3_warc_fixity,
    op4_bpe,
    op5_language,
    op6_fingerprint,
    op7_ngram_jaccard_join,
    op8_token_files,
    op9_toxicity,
    op10_line_dedup,
    op11_whitening,
    op12_quality,
    op13_hard_negatives,
)}

#: DuckDB SQL by query; the others are tested against brute force, round trips or held-out accuracy.
SQL: dict[str, str] = {"op3_warc_fixity": warc_fixity.SQL, "op13_hard_negatives": hard_negatives.SQL}
