from __future__ import annotations

import hashlib
import random

import pytest
from llm.brute import without_repeats
from llm.samples import ODD, SF

from niaga.llm import debruijn as d
from niaga.llm.queries import op7_substring_dedup


def check(rows, got, window=50):
    expected = without_repeats(rows, window)
    assert len(got) == len(rows)
    for r in got:
        n, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept) == (n, n - len(kept), " ".join(kept))


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = without_repeats(rows)
    got = op7_substring_dedup(spark, SF).collect()
    assert len(got) == len(rows) and any(r.n_removed for r in got)
    for r in got:
        n, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, n - len(kept))
        assert r.kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("seed", range(3))
def test_passages_copies_and_loops(docs_of, seed):
    """Few different words, shared passages of many lengths, passages twice in a text, runs of one word."""
    r = random.Random(seed)
    word = lambda: f"v{r.randrange(6 if seed else 400)}"
    passages = [[word() for _ in range(r.choice([18, 20, 25, 60]))] for _ in range(8)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(r.randrange(6)):
            own += r.choice(passages) if r.random() < 0.6 else [word() for _ in range(r.randrange(30))]
        rows.append((i, " ".join(own + ["same"] * r.choice([0, 0, 40]))))
    r.shuffle(rows)
    check(rows, d.remove_repeats(docs_of(rows), window=20).collect(), 20)


def test_spans_grow_with_the_earlier_document(docs_of):
    base = [f"w{i}" for i in range(200)]
    rows = [(5, " ".join(base)), (3, " ".join(base[:80])), (4, " ".join(base[40:95])), (9, " ".join(base[30:79])), (7, " ".join(base))]
    check(rows, d.remove_repeats(docs_of(rows)).collect())


def test_layout_of_untouched_texts_is_kept(docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    got = {r.doc_id: r.changed for r in d.remove_repeats(docs_of([(1, " a \n b "), (2, long), (3, f"x\n\n{long}  y")])).collect()}
    assert got == {1: " a \n b ", 2: long, 3: "x y"}


def test_odd_rows(odd, nothing, docs_of):
    got = {}
    for r in d.remove_repeats(odd).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed))
    assert got == {1: [(0, 0)], 2: [(0, 0)], 3: [(0, 0)], 4: [(1, 0)], 5: [(5, 0)] * 2, 6: [(5, 0)], None: [(5, 0)], 7: [(6, 0)], 8: [(30000, 0)], 9: [(1, 0)]}
    assert d.remove_repeats(nothing).count() == 0
    assert len(ODD) == sum(map(len, got.values()))
    long = " ".join(f"w{i}" for i in range(70))
    rows = [(None, long), (2, long), (2, long), (3, long), (None, long)]
    got = sorted((r.doc_id or 0, r.n_removed) for r in d.remove_repeats(docs_of(rows)).collect())
    assert got == [(0, 0), (0, 0), (2, 0), (2, 0), (3, 70)]
