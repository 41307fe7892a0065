"""A corpus from raw documents to token ids: language, near copies, repeated passages,
benchmark passages, segmentation."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparrowscope.llm import decontaminate, jaccard, language, pieces, spans
from sparrowscope.llm.common import store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return language.keep_determined(docs, language.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return jaccard.keep_one(docs, size=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences inside repeated spans go, all but their first occurrence; a document of
    which nothing is left goes as well."""
    # All columns in one beside id and text, so that no name of theirs can clash.
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    cut = spans.remove_repeats(whole, counts=True).where("n_removed = 0 OR text <> ''")
    length = F.when(F.col("n_removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": length}
    return cut.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document that is left, as token ids."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("benchmark_passages", drop_contaminated),
    ("segmentation", segment),
]

# Sampling, support vectors and 128-bit hashes have no SQL; tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
