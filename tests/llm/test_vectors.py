from __future__ import annotations

import numpy as np
import pytest
from llm.brute import components, linked
from llm.samples import SF

from niaga.llm import hamming, pivots
from niaga.llm.queries import op3_pivot_dedup, op8_multi_index


def check_links(vectors, got):
    links = linked(vectors, 0.93)
    root = components(links)
    assert len(got) == len(vectors)
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (len(links[r.vec_id]), root[r.vec_id], root[r.vec_id] == r.vec_id)


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, v int, c string, head int, d int, block int, sheet int, rank int"
    return spark.createDataFrame([(i, v, lab, 1, "x", 2, 3, 4, 5, 6) for i, lab, v in rows], schema).repartition(3)


def test_query_of_links(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_links({r.vec_id: (r.label, r.embedding) for r in rows}, op3_pivot_dedup(spark, SF).collect())


def clustered(seed=1, d=32):
    rng = np.random.default_rng(seed)
    out = []
    for c in range(12):
        centre = rng.normal(size=d)
        for _ in range(rng.integers(1, 60)):
            out.append((c % 3, (centre + rng.normal(size=d) * rng.choice([0, 0.05, 0.2, 0.35])) * rng.uniform(0.1, 9)))
    ids = rng.permutation(len(out))
    return [(int(i), lab, np.float32(v).tolist()) for i, (lab, v) in zip(ids, out, strict=True)]


def test_clusters_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rows = clustered()
    got = pivots.near_duplicates(frame(spark, rows)).collect()
    check_links({i: (lab, v) for i, lab, v in rows}, got)


def test_recall_of_the_head_at_the_threshold():
    rng = np.random.default_rng(2)
    for d, n, least in ((64, 256, 0.999), (64, 1024, 0.999), (64, 4096, 0.99)):
        points = pivots.unit(rng.normal(size=(n, d)))
        a = pivots.unit(rng.normal(size=(2000, d)))
        away = rng.normal(size=a.shape)
        away = pivots.unit(away - (away * a).sum(axis=1, keepdims=True) * a)
        b = 0.93 * a + np.sqrt(1 - 0.93**2) * away
        shared = [len({*x} & {*y}) for x, y in zip(pivots.heads(a, points), pivots.heads(b, points), strict=True)]
        assert (np.array(shared) >= pivots.SHARED).mean() >= least


ODD = [
    (1, 1, None), (2, 1, []), (3, 1, [0.0, 0.0]), (4, 1, [1.0, None]), (5, 1, [float("nan"), 1.0]), (6, 1, [float("inf"), 1.0]),
    (7, None, [1.0, 2.0]), (8, 1, [1.0, 2.0]), (9, 1, [2.0, 4.0]), (10, 1, [1.0, 2.0]), (10, 1, [1.0, 2.0]), (11, 2, [1.0, 2.0]),
    (12, 1, [1.0, 2.0, 0.0]), (None, 1, [1.0, 2.0]), (50, 1, [1.0, 2.0]),
]


def test_odd_links(spark):
    got = {}
    for r in pivots.near_duplicates(frame(spark, ODD)).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    for i in (1, 2, 3, 4, 5, 6, 7, 11, 12):
        assert got[i] == [(0, i, True)]
    assert got[8] == [(5, 8, True)] and got[9] == [(5, 8, False)] and got[10] == [(5, 8, False)] * 2 and got[None] == [(5, 8, False)]
    assert pivots.near_duplicates(frame(spark, [])).count() == 0


def best(vectors, query, k=5):
    q = np.array(vectors[query], float)
    near = {i: float(np.array(v, float) @ q / (np.linalg.norm(v) * np.linalg.norm(q))) for i, v in vectors.items() if i != query}
    return sorted(near, key=lambda i: (-near[i], i))[:k], near


def check_search(vectors, got, least=0.9):
    """Exact scores in the right order, and recall against brute force."""
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {i for i in vectors if i % 50 == 0}
    hits = 0
    for query, own in by.items():
        own.sort(key=lambda r: r["rank"])
        wanted, near = best(vectors, query)
        assert [r["rank"] for r in own] == list(range(1, len(wanted) + 1))
        for r in own:
            assert r.score == pytest.approx(near[r.vec_id], abs=1e-12)
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        hits += sum(r.score >= near[wanted[-1]] - 1e-12 for r in own)  # equal directions differ in the last bit
    assert hits >= least * sum(min(5, len(vectors) - 1) for _ in by)


def test_query_of_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_search({r.vec_id: r.embedding for r in rows}, op8_multi_index(spark, SF).collect())


def test_search_in_small_parts_of_clusters(spark):
    rows = clustered(3, 64)
    check_search({i: v for i, _, v in rows}, hamming.nearest(frame(spark, rows), part=20).collect(), 0.95)


def test_odd_search(spark):
    got = [(r.query_id, r["rank"], r.vec_id) for r in hamming.nearest(frame(spark, [*ODD, (100, 1, None)])).orderBy("rank").collect()]
    assert got == [(50, n + 1, i) for n, i in enumerate([7, 8, 9, 10, 11])]
    assert hamming.nearest(frame(spark, [])).count() == 0
    assert hamming.nearest(frame(spark, [(50, 1, [1.0, 2.0])])).count() == 0


def near_copies(n=3000, d=64, seed=7, noise=0.15):
    """Groups of some ten near copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 10, d))
    return centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, d)) * noise


def test_probing_finds_every_code_in_the_radius_once():
    rng = np.random.default_rng(6)
    v = rng.normal(size=(3000, 16))
    code = hamming.codes(v, hamming.learned_rotation(v))
    ids = [np.array([i]) for i in range(len(v))]
    parts = [hamming.Part(t, code, v, ids) for t in range(hamming.TABLES)]
    apart = hamming.distances(code, code[7])
    assert (apart == np.unpackbits((code ^ code[7]).view(np.uint8), axis=1).sum(axis=1)).all()
    found = []
    for low, high in ((0, 2), (3, 3), (4, 6)):
        for part in parts:
            found += [int(part.ids[r][0]) for r in part.probe(code[7], low, high)]
        assert len(found) == len(set(found))
        assert {*np.flatnonzero(apart <= hamming.TABLES * (high + 1) - 1).tolist()} <= set(found)


@pytest.mark.parametrize("seed", [1, 2])
def test_slack_and_the_share_of_the_rows_that_is_retrieved(seed):
    """On near copies the index spares most of the rows."""
    v = near_copies(seed=seed)
    made = hamming.learned(v)
    assert 0 <= made.slack <= hamming.BITS and 0 <= made.first <= hamming.SUB
    code = hamming.codes(v, made.rotation)
    x = hamming.unit(v)
    share, hits = [], 0
    for i in range(0, len(v), 50):
        cosines = x @ x[i]
        cosines[i] = -2
        near = np.argsort(-cosines)[:5]
        reach = (hamming.radius(float(cosines[near[-1]])) + made.slack) // hamming.TABLES
        each = hamming._ONES[code ^ code[i]].min(axis=1)
        share.append((each <= reach).mean())
        hits += (each[near] <= reach).sum()
    assert np.mean(share) < 0.3
    assert hits >= 0.95 * 5 * len(share)


def test_equal_vectors_are_one_entry(spark):
    rng = np.random.default_rng(9)
    one, rest = (np.float32(rng.normal(size=s)).tolist() for s in (8, (200, 8)))
    rows = [(i, 0, one if i % 3 == 0 else rest[i % 200]) for i in range(600)]
    check_search({i: v for i, _, v in rows}, hamming.nearest(frame(spark, rows)).collect())


def test_radius_covers_the_neighbours():
    assert hamming.radius(1.0) == 0 and hamming.radius(-1.0) == 64
    assert 9 <= hamming.radius(0.95) <= 13 < hamming.radius(0.5) < hamming.radius(0.2)


def dense_group(n, d=64, seed=4):
    """A third of the rows are near-copies of one vector, none equal; a tenth of the others are near-copies of others."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=d)
    third = centre + rng.normal(size=(n // 3, d)) * 0.24
    rest = rng.normal(size=(n - n // 3, d))
    rest[1::10] = rest[: len(rest) - 1 : 10][: len(rest[1::10])] + rng.normal(size=rest[1::10].shape) * 0.2
    return [(int(i), 0, np.float32(v).tolist()) for i, v in enumerate(rng.permutation(np.concatenate([third, rest])))]


@pytest.mark.parametrize("points", [256, 1024, 4096])
def test_dense_group_of_a_third_of_the_rows(spark, monkeypatch, points):
    monkeypatch.setattr(pivots, "LEAST", points)
    rows = dense_group(3000)
    v = np.array([r[2] for r in rows], float)
    norm = np.sqrt((v * v).sum(axis=1))
    near = (v @ v.T) / np.outer(norm, norm) >= 0.93
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(frame(spark, rows)).collect()}
    assert sum(got.values()) >= 0.999 * near.sum() > 300_000
    dense = np.flatnonzero(near.sum(axis=1) > 100)
    assert len(dense) > 900 and all(got[i] == near[i].sum() for i in dense)
