"""Toxicity by maximum-scoring segments (operator 4).

Words (runs of letters, lower case) and their stems of four and six bytes are told apart by 64-bit hashes. Those that at least
``HOLDERS`` labelled training documents hold are counted in these, by class, and over the whole texts of all documents. Their log-odds
between the classes, with a Dirichlet prior in proportion to the frequency in the whole corpus, are taken less two standard
errors; a word scores as the largest of its three, less a constant drift, which is all that a word without evidence has. How many
words are counted follows from the labelled documents (``COUNTED`` at most), so no two words share a count in a corpus of any size.
Only words with evidence are sent to the tasks that score. A linear scan finds every maximal segment of a document. Karlin-Altschul statistics turn a segment's score S in a text of n words into its expected
number of equals in clean text, K n exp(-lambda S): segments under a level are reported, and their evidence is summed and
calibrated by isotonic regression on training rows that gave no counts.

Results for odd rows: a null or empty text has no segments and the score of a document without evidence; a null id counts as
held out; repeated rows are scored alike; with no labelled row of a class all word scores are
negative, and without any to calibrate on each score is at most 0.001; other columns are
ignored; an empty table gives an empty one. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm import calibration, words
from niaga.llm.common import batch, cut, held_out, slices, text_buffer, texts

HOLDERS = 2  # labelled documents that hold a word, for it to be counted
STEMS = (4, 6)  # bytes
PRIOR = 2000.0  # words that the prior is worth
DRIFT = 0.25  # taken from each word's score: how fast a segment dies out in neutral text
LEVEL = 0.05  # expected number of such segments in clean text, below which one is reported
NO_EVIDENCE = -30.0  # the evidence of a text without any segment
COUNTED = 100_000  # the most labelled rows (about) that are sent to the tasks that count


def _found(part: pa.RecordBatch) -> tuple[np.ndarray, words.Words]:
    """Hashes of each word (first row) and of its stems, another one for each kind, and the words."""
    data, offsets = text_buffer(part.column("text"))
    found = words.split(data, offsets, letters=True)
    hashed = words.hashes(data, found, lower=True, stems=STEMS)
    hashed += np.arange(len(hashed), dtype=np.uint64)[:, None]
    return words.mix(hashed).view(np.int64), found


class Places:
    """Where hashes stand among the sorted ``known`` ones, behind the last for others: by a table of slots, some four for each known
    hash, and by bisection where several known ones share a slot."""

    def __init__(self, known: np.ndarray):
        self.known, n = known, len(known)
        self.mask = (1 << max(4, (4 * n).bit_length())) - 1
        slot, own = known & self.mask, np.arange(n, dtype=np.int32)
        self.slots, self.shared = np.full(self.mask + 1, n, np.int32), np.zeros(self.mask + 1, bool)
        self.slots[slot] = own
        self.shared[slot[self.slots[slot] != own]] = True

    def of(self, hashed: np.ndarray) -> np.ndarray:
        n = len(self.known)
        out = np.full(hashed.shape, n, np.int32)
        for row, places in zip(hashed, out, strict=True):
            if n:
                slot = row & self.mask
                at = self.slots[slot]
                hit = (at < n) & (self.known[np.minimum(at, n - 1)] == row)
                places[hit] = at[hit]
                doubt = np.flatnonzero(~hit & self.shared[slot])
                at = np.minimum(np.searchsorted(self.known, row[doubt]), n - 1)
                places[doubt] = np.where(self.known[at] == row[doubt], at, n)
        return out


def _of_texts(found: words.Words, kinds: int) -> np.ndarray:
    """The text of each word, for each kind in turn."""
    return np.tile(np.repeat(np.arange(len(found.bounds) - 1), np.diff(found.bounds)), kinds)


def labelled_counts(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(word, clean, toxic): how many labelled documents of each class hold a word or stem. ``labelled`` (doc_id, label) is bounded."""
    schema = pa.schema([("word", pa.int64()), ("clean", pa.int64()), ("toxic", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed, found = _found(part)
            text, word = _of_texts(found, len(hashed)), hashed.ravel()
            order = np.lexsort((text, word))
            text, word = text[order], word[order]
            once = np.append(True, (text[1:] != text[:-1]) | (word[1:] != word[:-1]))[: len(word)]
            toxic, word = part.column("label").to_numpy()[text[once]].astype(np.int64), word[once]
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1])[: len(word)])
            if len(head):
                hits = np.add.reduceat(toxic, head)
                yield batch(schema, word[head], np.diff(np.append(head, len(word))) - hits, hits)

    rows = texts(docs).join(F.broadcast(labelled), "doc_id").select("text", "label")
    counts = rows.mapInArrow(work, "word long, clean long, toxic long")
    return counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, clean, toxic) of those that HOLDERS labelled documents hold, sorted. Bounded as the labelled documents are."""
    held = counts.filter(F.col("clean") + F.col("toxic") >= HOLDERS).toArrow()
    word, clean, toxic = (held.column(c).to_numpy() for c in ("word", "clean", "toxic"))
    order = np.argsort(word)
    return word[order], clean[order].astype(float), toxic[order].astype(float)


def corpus_counts(docs: DataFrame, known: np.ndarray) -> np.ndarray:
    """How many texts of the whole corpus hold each known word. A task yields one row for a word, and Spark adds them up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, total = Places(known), np.zeros(len(known), np.int64)
        for part in slices(batches):
            hashed, found = _found(part)
            place = places.of(hashed).ravel()
            seen = np.flatnonzero(place < len(known))
            pair = np.sort(_of_texts(found, len(hashed))[seen] * len(known) + place[seen])
            pair = pair[np.append(True, pair[1:] != pair[:-1])[: len(pair)]]
            total += np.bincount(pair % max(len(known), 1), minlength=len(known))
        used = np.flatnonzero(total)
        yield batch(pa.schema([("place", pa.int32()), ("n", pa.int64())]), used, total[used])

    sums = texts(docs).select("text").mapInArrow(work, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(known))
    out[sums.column("place").to_numpy()] = sums.column("n").to_numpy()
    return out


def log_odds(corpus: np.ndarray, clean: np.ndarray, toxic: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """The score of each word from its counts; ``totals`` are those of all words of the clean and of the toxic documents."""
    if not all(totals):
        return np.full(len(corpus), -DRIFT, np.float32)
    prior = PRIOR * corpus / max(corpus.sum(), 1)
    odds = lambda y, total: np.log((y + prior) / np.maximum(total + PRIOR - y - prior, 1))
    delta = odds(toxic, totals[1]) - odds(clean, totals[0])
    error = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    sure = np.sign(delta) * np.maximum(np.abs(delta) - 2 * error, 0)
    return (np.clip(sure, -2, 8) - DRIFT).astype(np.float32)


def decay(scores: np.ndarray, weights: np.ndarray) -> float:
    """lambda > 0 with sum(weights * exp(lambda * score)) = 1, for scores of negative mean; 1 where no score is positive."""
    share, scores = weights[weights > 0] / max(weights.sum(), 1e-12), scores[weights > 0].astype(float)
    if not share[scores > 0].sum() or (share * scores).sum() >= 0:
        return 1.0
    total = lambda rate: (share * np.exp(np.minimum(rate * scores, 700))).sum()
    low, high = 0.0, 1.0
    while total(high) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return max((low + high) / 2, 1e-3)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, behind, score) of a run of word scores, in linear time (Ruzzo and Tompa).

    Only the positive words are visited; what lies between two of them is a difference of running sums.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    stack: list[tuple[int, int, float, float]] = []  # first, behind, sum before, sum behind
    for i in np.flatnonzero(scores > 0):
        first, behind, left, right = int(i), int(i) + 1, float(sums[i]), float(sums[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= right:
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((first, behind, left, right))
    return [(first, behind, right - left) for first, behind, left, right in stack]


def maximal_segments(docs: DataFrame, known: np.ndarray, scores: np.ndarray) -> DataFrame:
    """(doc_id, row, n_words, best, segments): every maximal segment of each whole text as byte offsets (first, behind) in its
    UTF-8 form and a score; best is the largest score, 0 without a segment. Words that are not known have only the drift."""
    scores = np.append(scores, np.float32(-DRIFT))
    segment = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64()), ("score", pa.float64())]))
    kinds = [("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("best", pa.float64())]
    schema = pa.schema([*kinds, ("segments", segment)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(known)
        for part in slices(batches):
            hashed, found = _found(part)
            scored, offsets = scores[places.of(hashed)].max(axis=0), text_buffer(part.column("text"))[1]
            best, listed = [], []
            for i in range(part.num_rows):
                at, begin = found.bounds[i], offsets[i]
                own = segments(scored[at : found.bounds[i + 1]])
                best.append(max((s for *_, s in own), default=0.0))
                listed.append([{"first": int(found.first[at + a] - begin), "behind": int(found.last[at + b - 1] - begin), "score": s} for a, b, s in own])
            yield batch(schema, part.column("doc_id"), part.column("row"), np.diff(found.bounds), best, listed)

    fields = "doc_id long, row long, n_words long, best double, segments array<struct<first: long, behind: long, score: double>>"
    return texts(docs).withColumn("row", F.xxhash64("text")).mapInArrow(work, fields)


def with_evidence(found: DataFrame, decay: float, scale: float) -> DataFrame:
    """Adds ``raw``, the surprise -log(K n exp(-lambda S)) of the best segment or the sum over all significant ones, and
    ``passages``, the significant segments with their expected number in clean text."""
    base = F.log(F.lit(scale) * F.greatest(F.col("n_words"), F.lit(1)))
    surprise = lambda s: F.lit(decay) * s - base
    listed = F.transform("segments", lambda s: s.withField("expected", F.exp(-surprise(s["score"]))))
    significant = F.filter(listed, lambda s: s["expected"] < LEVEL)
    total = F.aggregate(significant, F.lit(0.0), lambda t, s: t + surprise(s["score"]))
    raw = F.when(F.col("best") > 0, F.greatest(surprise(F.col("best")), total)).otherwise(NO_EVIDENCE)
    return found.withColumn("passages", significant).withColumn("raw", raw).drop("segments")


def calibration_of(rows: DataFrame) -> tuple[float, float, np.ndarray]:
    """The calibration of raw evidence. Evidence is a sum that grows with the text: its inverse hyperbolic sine is binned, so that one
    very long text does not widen the bins of the others."""
    return calibration.fit(rows.withColumn("raw", F.asinh("raw")), "raw", unknown=0.0)


def calibrated(raw: np.ndarray, model: tuple[float, float, np.ndarray]) -> np.ndarray:
    return calibration.apply(np.arcsinh(raw), model)


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = COUNTED) -> DataFrame:
    """(doc_id, row, held_out, n_words, raw, passages, score) of every document; row is the hash of its text, score the
    calibrated share of toxic ones."""
    rows = cut(calibration.training_labels(labels, label, bound))
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0  # these rows give no counts: they calibrate
    counts = cut(labelled_counts(docs, rows.filter(~apart)))
    totals = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("clean", "toxic"))).first()
    known, clean, toxic = vocabulary(counts)
    scores = log_odds(corpus_counts(docs, known), clean, toxic, totals)
    rate = decay(np.append(scores, -DRIFT), np.append(clean, totals[0] - clean.sum()))
    telling = np.abs(scores + DRIFT) > 1e-6
    found = cut(maximal_segments(docs, known[telling], scores[telling]))
    checked = found.join(rows.filter(apart), "doc_id")
    n, total = checked.filter("label = 0 and n_words > 0").agg(F.count("*"), F.sum(F.col("n_words") * F.exp(-rate * F.col("best")))).first()
    scale = n / total if n and total else 0.1  # the likeliest K of an extreme-value law with this lambda
    model = calibration_of(with_evidence(checked, rate, scale))
    kinds = "doc_id long, row long, held_out boolean, n_words long, raw double, passages array<struct<first: long, behind: long, score: double, expected: double>>, score double"
    evident = with_evidence(found, rate, scale).select("doc_id", "row", held_out().alias("held_out"), "n_words", "raw", "passages")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            raw = part.column("raw").to_numpy(zero_copy_only=False)
            yield part.append_column("score", pa.array(calibrated(raw, model)))

    return evident.mapInArrow(work, kinds)
