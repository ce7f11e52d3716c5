from __future__ import annotations

import random

import numpy as np
import pytest
from llm.brute import near_groups, shingles
from llm.samples import ODD, SF

from niaga.llm import setsketch as s
from niaga.llm.queries import op5_setsketch


def check(rows, got):
    groups = near_groups(rows)
    assert len(got) == len(rows)
    for r in got:
        root = groups[r.doc_id]
        assert (r.component_id, r.kept) == (root, r.doc_id == root), r


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op5_setsketch(spark, SF).collect()
    check(rows, got)
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got)


def varied(base, r, changes):
    words = list(base)
    for _ in range(changes):
        words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
    return " ".join(words)


def test_group_of_changed_copies_loses_no_link(docs_of):
    r = random.Random(2)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    rows = [(i, varied(base, r, r.choice([0, 0, 1, 2, 3, 4, 5, 7]))) for i in range(150)]
    rows += [(1000 + i, " ".join(f"w{r.randrange(5000)}" for _ in range(60))) for i in range(30)]
    r.shuffle(rows)
    check(rows, s.near_duplicates(docs_of(rows)).collect())


def test_small_blocks_give_the_same(docs_of, monkeypatch):
    monkeypatch.setattr(s, "LEADERS", 3)
    monkeypatch.setattr(s, "MEMBERS", 5)
    r = random.Random(3)
    base = [f"w{r.randrange(5000)}" for _ in range(80)]
    rows = [(i, varied(base, r, r.choice([1, 2, 3, 4, 5]))) for i in range(60)]
    check(rows, s.near_duplicates(docs_of(rows)).collect())


def test_threshold_is_exact(docs_of):
    words = [f"w{i}" for i in range(100)]
    at = " ".join(words)  # 97 runs of four words
    rows = [(1, at)]
    for k in range(70, 100):
        rows.append((k, " ".join(words[:k])))
    got = {x.doc_id: x.component_id for x in s.near_duplicates(docs_of(rows)).collect()}
    assert got == near_groups(rows)


def test_odd_rows(odd, nothing):
    got = {}
    for r in s.near_duplicates(odd).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert got[1] == [(0, 1, True)] and got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)]
    assert got[4] == [(1, 4, True)] and got[5] == [(2, 5, True)] * 2 and got[6] == [(2, 5, False)]
    assert got[None] == [(2, 5, False)] and got[8] == [(1, 8, True)]
    assert len([x for v in got.values() for x in v]) == len(ODD)
    assert s.near_duplicates(nothing).count() == 0


def test_group_without_ids(docs_of):
    got = s.near_duplicates(docs_of([(None, "a b c d e"), (None, "a b c d e"), (None, "")])).collect()
    assert [(r.component_id, r.kept) for r in got] == [(None, True)] * 3


def sets_of(*texts):
    raw = [t.encode() for t in texts]
    return s.element_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_elements_are_the_shingles():
    texts = ["a b c d e a b c d", "A B C D e", "a b", "", "ab c", "a bc", "a b c d\x1ce"]
    bounds, elements = sets_of(*texts)
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]
    own = [set(elements[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            assert len(own[i] & own[j]) == len(shingles(x) & shingles(y))


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = np.unique(pool[:3000]), np.unique(pool[1000:])
    union = np.unique(pool)
    made = s.sketch(np.cumsum([0, len(a), len(b), len(union)]), np.concatenate([a, b, union]), 2000)
    assert (s.merge(made[0], made[1]) == made[2]).all()
    near = s.likeliest(made[:1], made[1:2], np.array([len(a)]), np.array([len(b)]))[0]
    assert near == pytest.approx(2000 / 4000, abs=0.05)


def test_blocks_follow_the_sizes_of_the_sets(docs_of, monkeypatch):
    """Blocks of a few hundred elements: a long text is a block of its own, and texts of x meet y in slices."""
    monkeypatch.setattr(s, "LEADER_ELEMENTS", 300)
    monkeypatch.setattr(s, "MEMBER_ELEMENTS", 700)
    r = random.Random(5)
    base = [f"w{r.randrange(5000)}" for _ in range(300)]
    rows = [(i, varied(base, r, r.choice([5, 10, 14, 16, 18]))) for i in range(40)]
    check(rows, s.near_duplicates(docs_of(rows)).collect())


def test_five_words(docs_of):
    r = random.Random(6)
    base = [f"w{r.randrange(50)}" for _ in range(100)]
    rows = [(i, varied(base, r, i % 6)) for i in range(30)]
    got = s.near_duplicates(docs_of(rows), k=5).collect()
    groups = near_groups(rows, 5)
    assert {x.doc_id: x.component_id for x in got} == groups
    assert groups != near_groups(rows, 4)
