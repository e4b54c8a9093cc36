"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, dedup, html, language, licenses, media, mixing, packing, quality, toxicity
from .common import table


def op1_media_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WAV payload, digests and the digest of the spectral-peak fingerprints of every document."""
    out = media.media_column(table(spark, sf_dir, "documents"), keep_media=False)
    codes = F.array_join(F.transform("fingerprint", lambda c: F.hex(c)), ",")
    return out.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
        F.concat_ws(":", "n_windows", F.size("fingerprint"), F.sha2(codes, 256)).alias("feature"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.language_id(docs)
    return out.select("doc_id", language.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_rejected", "cross_entropy")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and decision of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality.quality(docs.select("doc_id", "text"), quality.graded(labels))
    return out.select("doc_id", language.held_out().alias("held_out"), "quality_grade", "quality_tail", (~F.col("quality_rejected")).alias("kept"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, with the number of offending sentences."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.toxicity(docs.select("doc_id", "text"), labels, spans=True)
    score = F.col("toxicity")
    return out.select("doc_id", language.held_out().alias("held_out"), score.alias("score"), F.when(score >= 0.7, 1).otherwise(0).alias("predicted"), F.size("toxic_spans").alias("n_offending"))


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every row whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % or more of their 3-word shingles."""
    return dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=3, percent=85)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    out = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", F.col("license_score").alias("score"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn by the hierarchical budget, with their epoch."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "domain", "language", F.coalesce("source", F.lit("und")).alias("source"), "mix_tokens", "epoch")


def word_bpe() -> str:
    """The vocabulary file of the packing queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), word_bpe())


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = html.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), "n_chars")


QUERIES = {
    "op1_media_fingerprints": op1_media_fingerprints,
    "op2_nearest_vectors": op2_nearest_vectors,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_license_scan": op4_license_scan,
    "op5_mixing": op5_mixing,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_main_text": op10_main_text,
}
ORACLES: dict[str, str] = {
    "op4_license_scan": licenses.oracle(),
    "op5_mixing": mixing.oracle(),
}
