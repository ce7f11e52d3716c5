from __future__ import annotations

import hashlib
import zlib

import pytest
from llm.samples import CLASHING, SF

from niaga.llm import merkle
from niaga.llm.common import table

OUT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    i, source, lang, n, text = row
    values = (i, source, lang, None if n is None else n + more, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        out.append((i % 2 == 1, level[i ^ 1] if i ^ 1 < len(level) else ""))
        i //= 2
    return out


def plain(rows):
    """The contract, tree by tree and leaf by leaf."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {k: levels([leaf(r) for r in by[k]]) for k in langs}
    top = levels([trees[k][-1][0] for k in langs])
    out = []
    for at, k in enumerate(langs):
        for i, r in enumerate(by[k]):
            steps = path(trees[k], i) + path(top, at)
            acc = leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf(r)
            for left, digest in steps:
                acc = sha(digest + acc if left else acc + digest)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[k][-1][0], root, sha("".join(d for _, d in steps)), acc, acc == root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def made(spark):
    def make(rows, partitions=5):
        more = ("x", 1, 2, 0.5, 3, 4, "k", 5, 6, "s")
        schema = f"doc_id long, source string, lang string, n_chars long, text string, {CLASHING}"
        return spark.createDataFrame([(*r, *more) for r in rows], schema).repartition(partitions)

    return make


def found(docs):
    return sorted((tuple(r[c] for c in OUT) for r in merkle.proofs(docs).collect()), key=repr)


def test_query_equals_the_plain_trees(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = found(docs)
    assert got == plain(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (33,), (65, 32, 1), (1025, 2, 3, 5, 7, 1)])
def test_trees_of_every_shape(made, sizes):
    rows = [(100 * i + j, "s", f"l{j}", 5, f"text {i}") for j, n in enumerate(sizes) for i in range(n)]
    assert found(made(rows)) == plain(rows)


def test_odd_rows(made):
    rows = [
        (None, None, None, None, None),
        (None, "s", None, 3, "x"),
        (1, "", "", 0, ""),
        (2, "s", "é", None, "日本語"),
        (3, "s", "en", 2**63 - 1, "long" * 100_000),
        *[(7 * i, None, "z", i, None) for i in range(40)],
        *[(5, "s", "en", 4, "again")] * 70,
        (5, "s", "en", 5, "same id"),
    ]
    assert found(made(rows)) == plain(rows)


def test_root_does_not_depend_on_the_order_or_the_partitions(made):
    rows = [(i % 50, "s", "ab"[i % 2], i, f"t {i}") for i in range(200)]
    assert found(made(rows, 1)) == found(made(rows[::-1], 7))


def test_a_changed_row_changes_the_root_of_its_language_only(made):
    rows = [(i, "s", "ab"[i % 2], i, f"t {i}") for i in range(50)]
    other = [(*rows[0][:4], "t!"), *rows[1:]]
    one, two = ({r[0]: r for r in found(made(x))} for x in (rows, other))
    assert one[2][2] != two[2][2] and one[1][2] == two[1][2] and one[1][3] != two[1][3]


def test_proof_steps_fold_to_the_root(made):
    from pyspark.sql import functions as F

    rows = [(i, "s", "en", i, f"t {i}") for i in range(100)]
    held = merkle.manifest(made(rows))
    assert held.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
    assert held.filter(F.size("path") != 7).isEmpty()


def test_empty_table(made):
    assert found(made([])) == []
