"""From raw documents to packed training sequences: five stages, each an operator of ``niaga.llm``.

Every stage takes all rows that its predecessor kept. The first four return the columns of documents; a changed text has its new
length in n_chars, and an unchanged row (a null text too) is passed as it is. Repeated rows share a decision, except that one
document of each group of near-duplicates stays. Null ids are never rejected by another row's decision.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from niaga.llm import debruijn, packing, pii, setsketch, toxicity
from niaga.llm.common import cut, restored, table, without
from niaga.session import shared_root

TOXIC = 0.5  # documents of this score and above are rejected
SHINGLE = 5  # words of a shingle; the four of op5_setsketch are its contract's alone


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxic passages make them likely toxic."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return without(docs, cut(scored.filter(F.col("score") >= TOXIC).select("doc_id", "row")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near-duplicates (0.8 of all runs of five words in common)."""
    found = cut(setsketch.near_duplicates(docs, SHINGLE))
    linked = found.filter("kept and n_shingles > 0").groupBy("doc_id", "row").count()
    return without(docs, found.filter("not kept"), linked.filter("count > 1"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the runs of 50 words that an earlier document holds."""
    return restored(debruijn.remove_repeats(docs, carry=True), docs, "changed")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each span of personal data by its kind."""
    return restored(pii.spans(docs, carry=True), docs, "redacted")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of the documents, in pieces of full sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None  # learned scores, sketches and retrieval are not expressible; tests/llm has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    folder = f"{shared_root(spark)}/niaga/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
