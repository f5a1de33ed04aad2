"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, embedding_dedup, exact_dedup, lm_scoring, media, packing, quality, sentence_pieces, simhash, substring_dedup, token_counts, vector_codes, warc
from ._common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenised_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(media.read_media(media.media_column(table(spark, sf_dir, "documents")), tensors=True))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(table(spark, sf_dir, "documents"), model), model)
    text = F.col("text").cast("binary")
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), F.octet_length(text).cast("long").alias("decoded_bytes"), F.sha2(text, 256).alias("decoded_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_dedup(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_media": op2_media,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_simhash": op7_simhash,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_sentence_pieces": op9_sentence_pieces,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {"op5_substring_dedup": substring_dedup.ORACLE, "op10_exact_dedup": exact_dedup.ORACLE, "op11_source_divergence": divergence.ORACLE, "op12_embedding_dedup": embedding_dedup.ORACLE, "op13_vector_codes": vector_codes.ORACLE}
