from __future__ import annotations

import math

import numpy as np
import pytest
from llm.samples import CLASHING, SF

from niaga.llm import queries, whitening
from niaga.llm.common import table


def frame(spark, rows, partitions=3):
    more = ("row", 1, 2, 0.5, 3, 4, "key", 5, 6, "s")
    schema = f"vec_id long, embedding array<double>, x string, n int, {CLASHING}"
    return spark.createDataFrame([(i, v, "x", 9, *more) for i, v in rows], schema).repartition(partitions)


def plain(rows, components=4):
    """By id: (deviation, n), with the spectrum of the distinct whole vectors of one length."""
    x = [tuple(math.floor(256 * c) for c in v) for _, v in rows]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    apart = np.array([[c - s / n for c, s in zip(v, sums, strict=True)] for v in fit])
    values, directions = np.linalg.eigh(apart.T @ apart / n)
    order = np.argsort(-values)[:components]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    projected = np.array([[c - s / n for c, s in zip(v, sums, strict=True)] for v in x]) @ directions[:, order]
    return n, deviations, values[order], projected, values.sum()


def test_query_equals_a_full_decomposition(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    n, deviations, values, projected, total = plain(rows)
    got = {(r.vec_id, r.component): r for r in queries.queries()["op11_whitening"](spark, SF).collect()}
    assert len(got) == 4 * len(rows)
    for k in range(4):
        own = np.array([got[i, k + 1].whitened for i, _ in rows])
        expected = projected[:, k] / math.sqrt(values[k])
        assert np.abs(own * np.sign(own @ expected) - expected).max() < 1e-9
        assert all(abs(got[i, k + 1].explained / (values[k] / total) - 1) < 1e-9 for i, _ in rows)
    assert all(got[i, 1].deviation == d and got[i, 1].n == n for (i, _), d in zip(rows, deviations, strict=True))
    assert {r.identity_error for r in got.values()} == {got[0, 1].identity_error} and got[0, 1].identity_error < 1e-9


@pytest.mark.parametrize("d", [1, 2, 3, 7, 30])
def test_counts_equal_eigenvalues_above_the_shift(d):
    random = np.random.default_rng(d)
    for kind in range(3):
        a = random.normal(size=(d, d))
        a = (a + a.T, a @ a.T, np.round(a + a.T))[kind]
        values = np.linalg.eigvalsh(a)
        for shift in [*random.normal(size=20) * np.abs(values).max(), 0.0]:
            if np.abs(values - shift).min() > 1e-9:
                assert whitening.above(a, shift) == (values > shift).sum()


def test_counts_of_singular_matrices():
    assert whitening.above(np.zeros((5, 5)), 0.0) == 0
    assert whitening.above(np.array([[0.0, 1], [1, 0]]), 0.0) == 1
    assert whitening.above(np.diag([2.0, 2, 0, -1]), 0.0) == 2


@pytest.mark.parametrize(
    "spectrum",
    [[5, 4, 3, 2, 1], [3, 3, 3, 3, 3, 1], [7, 7, 1, 1, 1], [1 + 1e-9, 1, 1 - 1e-9, 0.5], [1e8, 1, 1e-3, 1e-5], [4], [2, 0, 0], [1, 1 + 1e-14, 0.3]],
)
def test_leading_pairs(spectrum):
    d = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]
    v = turn @ np.diag(spectrum) @ turn.T
    v = (v + v.T) / 2
    values, vectors = whitening.leading(v)
    expected = sorted((s for s in spectrum if s > 0), reverse=True)[:4]
    norm = max(spectrum)
    assert len(values) == len(expected) and np.abs(values - expected).max() < 1e-13 * norm * d
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() < 1e-13 * norm * d


def test_random_covariances():
    random = np.random.default_rng(3)
    for d in (2, 5, 64, 200):
        x = random.normal(size=(3 * d, d)) * random.exponential(size=d)
        v = np.cov(x.T, bias=True)
        values, vectors = whitening.leading(v)
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:4], rtol=1e-12)
        assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * values[0]


def test_odd_rows(spark):
    random = np.random.default_rng(5)
    good = [(i, random.normal(size=3).tolist()) for i in range(20)]
    again = [good[0], good[0], (None, good[1][1]), (100, good[2][1])]
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, math.nan, 2.0]), (204, [math.inf, 1.0, 2.0]), (205, [1e300, 0.0, 0.0])]
    short = [(300 + i, [float(i), 0.5]) for i in range(5)]  # one dimension without variance
    lone = [(400, [1.0] * 4), (401, [1.0] * 4)]  # one distinct vector: no component
    got = whitening.whitened(frame(spark, good + again + bad + short + lone)).collect()
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == [*range(20), 100, *range(300, 305)]
    n, deviations, _, _, _ = plain(good + again)
    assert n == 20 and len(got) == 24 * 3 + 5
    by = {r.vec_id: r for r in got}
    assert all(by[i].deviation == d and by[i].n == 20 for (i, _), d in zip(good + again, deviations, strict=True))
    assert {r.component for r in got if r.vec_id == 300} == {1} and by[300].explained == pytest.approx(1)
    assert all(r.identity_error < 1e-9 for r in got)


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = [(i, [float(3**i), -float(2**i), 0.25]) for i in range(25)]
    n, deviations, _, _, _ = plain(rows)
    got = whitening.whitened(frame(spark, rows), components=1).collect()
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviations))
    assert max(deviations) > 2**63


def test_vectors_alike_in_every_direction(spark):
    rows = [(2 * i + s, [float((1 - 2 * s) * (i == j)) for j in range(6)]) for i in range(6) for s in range(2)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert len(got) == 48 and max(r.identity_error for r in got) < 1e-9
    assert all(r.explained == pytest.approx(1 / 6, rel=1e-9) for r in got)


def test_empty_tables(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None), (2, [])])).collect() == []
