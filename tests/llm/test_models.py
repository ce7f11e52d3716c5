"""Quality and toxicity: parts against plain versions, accuracy on the held-out fifth, odd rows."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.samples import ODD, SF

from niaga.llm import calibration, quality, toxicity, words
from niaga.llm.queries import op1_quality, op4_toxicity


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def accuracy(got, labels, column):
    rows = [(r.predicted, labels[r.doc_id][column]) for r in got if r.held_out and r.doc_id in labels]
    return sum(p == y for p, y in rows) / len(rows)


def check_rows(spark, got, threshold):
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)


def test_quality_on_held_out_rows(spark, labels):
    got = op1_quality(spark, SF).collect()
    check_rows(spark, got, 0.3)
    assert accuracy(got, labels, "quality") >= 0.95


def test_toxicity_on_held_out_rows(spark, labels):
    got = op4_toxicity(spark, SF).collect()
    check_rows(spark, got, 0.5)
    assert accuracy(got, labels, "toxic") >= 0.93


def planted(docs_of, spark):
    rng = np.random.default_rng(3)
    rows, marks = [], []
    for i in range(600):
        own = [f"w{''.join(rng.choice(list('abcdefgh'), 5))}" for _ in range(rng.integers(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            at = int(rng.integers(0, len(own)))
            own[at:at] = list(rng.choice(["vileword", "Foulness,", "nastything"], 4))
        rows.append((i, " ".join(own)))
        marks.append((i, int(toxic), 1))
    return rows, docs_of(rows), spark.createDataFrame(marks, "doc_id long, toxic int, quality int")


def test_passages_cover_planted_words(spark, docs_of):
    rows, docs, marks = planted(docs_of, spark)
    text = dict(rows)
    hits = misses = false = 0
    for r in toxicity.score(docs, marks).collect():
        raw = text[r.doc_id].encode()
        for p in r.passages:
            passage = raw[p.first : p.behind].decode().lower()
            assert p.expected < toxicity.LEVEL
            hits += any(w in passage for w in ("vileword", "foulness", "nastything"))
        misses += r.doc_id % 5 == 0 and not r.passages
        false += r.doc_id % 5 != 0 and bool(r.passages)
    assert hits >= 110 and misses <= 6 and false <= 25


def hash_of(word, kind=0):
    return int(toxicity._found(pa.RecordBatch.from_pydict({"text": [word]}))[0][kind, 0])


def test_counts_of_words_and_stems_are_exact(spark, docs_of):
    rows = [(1, "Alpha alphabet, alpha"), (2, "alpha beta"), (3, "BETA gamma"), (4, "alphabet gamma gamma"), (5, None), (6, "alpha")]
    marks = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 0), (5, 1)], "doc_id long, label int")
    counts = toxicity.labelled_counts(docs_of(rows), marks)
    got = {r.word: (r.clean, r.toxic) for r in counts.collect()}
    assert got[hash_of("alpha")] == (1, 1) and got[hash_of("alphabet")] == (2, 0) and got[hash_of("beta")] == (0, 2)
    assert got[hash_of("alpha", 1)] == (2, 1) and got[hash_of("alphabet", 2)] == (2, 0)  # stems alph and alphab
    known, clean, toxic = toxicity.vocabulary(counts)
    assert len(known) == sum(sum(n) >= toxicity.HOLDERS for n in got.values()) and (np.diff(known) > 0).all()
    corpus = dict(zip(known.tolist(), toxicity.corpus_counts(docs_of(rows), known), strict=True))
    assert corpus[hash_of("alpha")] == 3 and corpus[hash_of("gamma")] == 2 and corpus[hash_of("alpha", 1)] == 4
    assert [(int(c), int(t)) for c, t in zip(clean, toxic, strict=True)] == [got[w] for w in known.tolist()]


def test_places_of_hashes():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 3000):
        known = np.unique(np.concatenate([rng.integers(-(2**63), 2**63 - 1, n), np.arange(n // 2) << 40]))  # the latter share a slot
        asked = rng.permutation(np.concatenate([known, rng.integers(-(2**63), 2**63 - 1, 500), [0, -1]]))
        at = {int(h): i for i, h in enumerate(known)}
        assert toxicity.Places(known).of(asked[None])[0].tolist() == [at.get(int(h), len(known)) for h in asked]


def test_no_two_words_share_a_count(spark, docs_of):
    """More words than the fixed buckets of before had places for without collisions."""
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(5))
    rows = [(d, " ".join(name(i) for i in range(5000 * (d // 2), 5000 * (d // 2 + 1)))) for d in range(80)]
    marks = spark.createDataFrame([(d, d % 2) for d in range(80)], "doc_id long, label int")
    known, clean, toxic = toxicity.vocabulary(toxicity.labelled_counts(docs_of(rows), marks).filter("clean = 1 and toxic = 1"))
    words_of = {hash_of(name(i)) for i in range(0, 200_000, 997)}
    assert words_of <= set(known.tolist())
    at = np.isin(known, list(words_of))
    assert set(toxicity.corpus_counts(docs_of(rows), known)[at]) == {2.0}


def brute_segments(scores):
    """All maximal segments: recursively the best segment (the first, shortest of equal ones), then left and right of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    spans = itertools.combinations(range(len(scores) + 1), 2)
    a, b = min(spans, key=lambda s: (-sum(scores[s[0] : s[1]]), s[1] - s[0], s[0]))
    left = brute_segments(scores[:a])
    right = [(a2 + b, b2 + b, s) for a2, b2, s in brute_segments(scores[b:])]
    return [*left, (a, b, sum(scores[a:b])), *right]


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(4)
    for _ in range(150):
        scores = rng.choice([-3, -1, 2, 5, -2, 1], rng.integers(0, 16)) + rng.normal(scale=1e-6, size=1)
        got = toxicity.segments(np.array(scores, float))
        expected = brute_segments([float(s) for s in scores])
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in expected])


def test_decay_solves_its_equation():
    scores, share = np.array([-1.0, -0.5, 2.0]), np.array([0.7, 0.2, 0.1])
    assert (share * np.exp(toxicity.decay(scores, share) * scores)).sum() == pytest.approx(1)
    assert toxicity.decay(np.array([-1.0]), np.array([1.0])) == 1.0


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(5)
    counts = rng.integers(20, 50, 40)
    positives = rng.binomial(counts, np.linspace(0.1, 0.9, 40))
    got = calibration.isotonic(counts, positives)
    assert (np.diff(got) >= 0).all() and abs(got - positives / counts).mean() < 0.12
    # min-max formula of isotonic regression, with the same half counts in advance per block
    share = lambda a, b: positives[a : b + 1].sum() / counts[a : b + 1].sum()
    plain = [max(min(share(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert abs(got - plain).max() < 0.03


def test_training_labels(spark):
    rows = [(i, i % 2) for i in range(1000)] + [(7, 1), (None, 1), (8, None), (9, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, quality int")
    every = {r.doc_id: r.label for r in calibration.training_labels(frame, "quality").collect()}
    assert set(every) == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 5}
    some = calibration.training_labels(frame, "quality", bound=200)
    assert 120 <= some.count() <= 230


def test_statistics_against_plain_counts():
    texts = ["", "aa bb aa aa", "ONE two. Three,\nfour 5 $$$ é"]
    raw = [t.encode() for t in texts]
    rows = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert rows.shape == (3, quality.STATISTICS) and not rows[0].any()
    assert rows[1][1] == pytest.approx(np.log1p(4)) and rows[1][12] == pytest.approx(1 / 4) and rows[1][14] == pytest.approx(3 / 4)
    assert rows[2][3] == pytest.approx(4 / 17) and rows[2][4] == pytest.approx(1 / len(raw[2]))


def test_word_hashes():
    text = "One one ONE two\ttwo onetwo one-two".encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    found = words.split(data, offsets)
    exact, folded = words.hashes(data, found), words.hashes(data, found, lower=True)
    assert len(set(exact.tolist())) == 6 and len(set(folded.tolist())) == 4
    monkey = words.SEGMENT
    try:
        words.SEGMENT = 5  # words on borders of portions
        assert (words.hashes(data, found) == exact).all()
    finally:
        words.SEGMENT = monkey


@pytest.mark.parametrize("operator, column", [(quality.score, "quality"), (toxicity.score, "toxic")])
def test_odd_rows(spark, odd, nothing, operator, column):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1), (6, 0), (8, 1), (77, 1)], f"doc_id long, {column} int")
    got = operator(odd, labels).select("doc_id", "held_out", "score").collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    assert operator(nothing, labels).count() == 0
    none = labels.filter("doc_id < 0")
    assert {r.score for r in operator(odd, none).select("score").collect()} and operator(odd, none).count() == len(ODD)


def test_one_very_long_toxic_text_leaves_the_others_apart(spark):
    """Clean evidence around -3, toxic from 15 on, and a toxic text of 86,000: in equal bins of 43 both would share one."""
    raw = [(-3 + i % 7 / 10, 0) for i in range(300)] + [(15.0 + i % 20, 1) for i in range(100)] + [(86_000.0, 1)]
    rows = spark.createDataFrame(raw, "raw double, label int")
    assert calibration.apply(np.array([25.0]), calibration.fit(rows, "raw"))[0] < 0.5
    low, high = toxicity.calibrated(np.array([-2.5, 25.0]), toxicity.calibration_of(rows))
    assert low < 0.05 and high > 0.95
