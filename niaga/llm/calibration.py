"""Labels to learn from, and isotonic calibration from counts per score bin."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niaga.llm.common import held_out

BINS = 2000
LABELS = 200_000  # the most labelled rows (about) that a model is fitted on


def training_labels(labels: DataFrame, column: str, bound: int = LABELS) -> DataFrame:
    """(doc_id, label) outside the held-out fifth: all, or beyond ``bound`` rows a share of ids chosen by their hash.

    Rows without an id or with a label other than 0 and 1 are left out. A document with several labels has the largest.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .filter(~held_out() & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    count = rows.count()
    if count <= bound:
        return rows
    share = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
    return rows.filter(share < int(0.95 * bound / count * 1_000_000))


def bin_of(score: Column, low: float, high: float) -> Column:
    """The calibration bin of a raw score."""
    at = F.floor((score - low) / max(high - low, 1e-12) * BINS).cast("int")
    return F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1))


def isotonic(counts: np.ndarray, positives: np.ndarray, unknown: float = 0.5) -> np.ndarray:
    """The nondecreasing share of positives per bin (pool adjacent violators, half a row of each class added to a block); without
    any row ``unknown``."""
    used = np.flatnonzero(counts)
    if not len(used):
        return np.full(len(counts), unknown)
    blocks: list[list[float]] = []  # weight, positives, bins
    for i in used:
        blocks.append([float(counts[i]), float(positives[i]), 1])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            weight, hits, size = blocks.pop()
            blocks[-1] = [blocks[-1][0] + weight, blocks[-1][1] + hits, blocks[-1][2] + size]
    shares = np.concatenate([np.full(int(size), (hits + 0.5) / (weight + 1)) for weight, hits, size in blocks])
    return np.interp(np.arange(len(counts)), used, np.maximum.accumulate(shares))


def fit(labelled: DataFrame, raw: str, label: str = "label", unknown: float = 0.5) -> tuple[float, float, np.ndarray]:
    """(low, high, share per bin) from rows with a raw score and a label; at most BINS rows reach the driver."""
    span = labelled.agg(F.min(raw).alias("low"), F.max(raw).alias("high")).first()
    if span is None or span.low is None:
        return 0.0, 1.0, np.full(BINS, unknown)
    binned = labelled.groupBy(bin_of(F.col(raw), span.low, span.high).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(label).alias("hits")
    )
    counts, positives = np.zeros(BINS), np.zeros(BINS)
    for row in binned.collect():
        counts[row.bin], positives[row.bin] = row.n, row.hits
    return span.low, span.high, isotonic(counts, positives)


def apply(raw: np.ndarray, model: tuple[float, float, np.ndarray]) -> np.ndarray:
    """The share of positives at each raw score; inside a step of that share, the raw order moves it by at most 0.001."""
    low, high, shares = model
    place = np.clip((raw - low) / max(high - low, 1e-12), 0, 1)
    return 0.999 * shares[np.minimum(place * BINS, BINS - 1).astype(int)] + 0.001 * place
