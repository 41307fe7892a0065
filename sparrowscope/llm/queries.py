"""The dealt operators as queries over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparrowscope.llm import (
    classifier,
    decontaminate,
    jaccard,
    language,
    manifest,
    order_minhash,
    pieces,
    quality,
    spans,
    suffixes,
    tokens,
    warc,
    whitening,
)
from sparrowscope.llm.common import crc_mod

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), statistics=STATISTICS)


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return pieces.digests(pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model")))


def op3_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    trees = classifier.fit(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    return classifier.score(docs, trees).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_folder(spark)
    warc.write_captures(_table(spark, sf_dir, "pages"), path)
    return warc.captured_pages(spark, path)


def op5_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.remove_repeats(docs, counts=True)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs.where(crc_mod(F.col("doc_id"), 3) != 1))
    return language.predict(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_substrings(_table(spark, sf_dir, "documents"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=90)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokens.archive_folder(spark)
    tokens.write_archives(
        _table(spark, sf_dir, "documents"),
        path,
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
        by_word=True,
    )
    return tokens.token_index(spark, path)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_with_edited(_table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_pieces": op2_pieces,
    "op3_classifier": op3_classifier,
    "op4_warc": op4_warc,
    "op5_spans": op5_spans,
    "op6_language": op6_language,
    "op7_suffixes": op7_suffixes,
    "op8_jaccard": op8_jaccard,
    "op9_tokens": op9_tokens,
    "op10_decontaminate": op10_decontaminate,
    "op11_whitening": op11_whitening,
    "op12_order_minhash": op12_order_minhash,
    "op13_manifest": op13_manifest,
}
