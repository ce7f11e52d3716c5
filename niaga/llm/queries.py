"""The registered queries of these operators: name -> function of (session, folder of test tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from niaga.llm import bpe, debruijn, hamming, merkle, oracles, packing, pii, pivots, quality, setsketch, toxicity, unigram, whitening, winnowing
from niaga.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated quality score of every document."""
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 ids, as pieces."""
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated toxicity score of every document."""
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op5_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near-duplicates of every document."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents")).drop("row")


def op6_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every whole text."""
    return unigram.token_counts(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the 50-word runs of earlier documents, as a digest."""
    left = debruijn.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return hamming.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and what they decode to, as digests."""
    back = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every whole text, and digests of the base ones."""
    found = pii.spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2("base", 256).alias("base_sha256"),
        F.col("found").alias("spans"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading principal components, whitened."""
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in ten-word windows of benchmark items, and digests of these items."""
    return winnowing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of membership of every document, and whether it holds after tampering."""
    return merkle.proofs(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    operators = (
        op1_quality,
        op2_packing,
        op3_pivot_dedup,
        op4_toxicity,
        op5_setsketch,
        op6_unigram_counts,
        op7_substring_dedup,
        op8_multi_index,
        op9_byte_bpe,
        op10_personal_data,
        op11_whitening,
        op12_winnowing,
        op13_merkle_manifest,
    )
    return {f.__name__: f for f in operators} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
