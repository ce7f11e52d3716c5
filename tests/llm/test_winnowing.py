from __future__ import annotations

import hashlib
import random
import re

import pytest
from llm.samples import CLASHING, ODD, SF

from niaga.llm import winnowing
from niaga.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def hits(docs, items):
    """Words hit, and items, of each document by comparing all windows."""
    held = {}
    for i, text in items:
        w = split(text)
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if n else ():
            held.setdefault(tuple(w[s : s + n]), set()).update([str(i)] if i is not None else [])
    out = []
    for i, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(k) for k in held}:
            for s in range(len(w) - n + 1):
                if (own := held.get(tuple(w[s : s + n]))) is not None:
                    hit.update(range(s, s + n))
                    found |= own
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), listed, bool(hit)))
    return sorted(out, key=repr)


def items_of(spark, rows):
    schema = f"item_id long, text string, item string, w string, set int, hash int, {CLASHING}"
    return spark.createDataFrame([(i, t, "a", "b", 1, 2, "x", 1, 2, 0.5, 3, 4, "k", 5, 6, "s") for i, t in rows], schema)


def reported(docs, items):
    return sorted((tuple(r) for r in winnowing.report(docs, items).collect()), key=repr)


def test_query_equals_all_windows(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = reported(docs, items)
    rows = lambda df, key: [(r[key], r.text) for r in df.collect()]
    assert got == hits(rows(docs, "doc_id"), rows(items, "item_id"))
    assert any(r[-1] for r in got)


def test_few_words_and_many_ties(spark, docs_of):
    """A small vocabulary: equal runs inside a window, overlapping hits, items of every length from one word up."""
    random.seed(12)
    text = lambda n, k: " ".join(random.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(i, text(n, 8)) for i, n in enumerate([3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 30, 30])]
    items += [(90, "a a a a a a a a a a a a"), (91, "zeta"), (92, "a"), (93, "eta theta")]
    docs = [(i, text(random.randint(0, 200), 2 + i % 7)) for i in range(60)] + [(100, "a " * 40), (101, "x zeta y"), (102, "theta eta theta")]
    assert reported(docs_of(docs), items_of(spark, items)) == hits(docs, items)


@pytest.mark.parametrize("width", range(1, 12))
def test_fingerprints_find_every_window(spark, width):
    """Runs kept by any text that holds the window include the window's own fingerprint."""
    random.seed(width)
    n = min(width, 10)
    inner = [f"w{random.randint(0, 3)}" for _ in range(n)]
    whole = " ".join([*(f"v{random.randint(0, 3)}" for _ in range(8)), *inner, *(f"u{random.randint(0, 3)}" for _ in range(8))])
    docs = spark.createDataFrame([(1, whole, 5)], "doc_id long, text string, row long")
    own = winnowing.item_windows(items_of(spark, [(1, " ".join(inner))]), "item_id", "text").head().hash
    assert own in {r.hash for r in winnowing.fingerprints(docs, [n]).collect()}


def test_odd_rows(spark, docs_of, odd):
    items = [(1, "one two three"), (1, "four five"), (2, None), (3, ""), (4, " .,! "), (None, "déjà VU"), (5, "日本語"), (6, "word " * 50), (7, "a" * 300000)]
    assert reported(odd, items_of(spark, items)) == hits(ODD, items)


def test_windows_are_separated_and_lower_cased_as_stated(spark, docs_of):
    items = [(1, "Ein Öl-Fass: 3,5 kg; ÄÖ_x{y}z~é"), (2, "\x00a\x7fb\x1fc d e f g h i j k l")]
    docs = [(1, "ein Öl fass 3 5 KG ÄÖ X y z é"), (2, "ein öl fass 3 5 kg"), (3, "A B C D E F G H I J K L m")]
    got = reported(docs_of(docs), items_of(spark, items))
    assert got == hits(docs, items)
    assert [r[2] for r in got] == [11, 0, 12]


def test_spans_and_items_of_a_passage_in_many_documents_and_items(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(25))
    items = items_of(spark, [(i, f"q{i} {passage} r{i}") for i in range(40)])
    docs = docs_of([(i, f"x{i} y {passage}" if i % 3 else f"x{i}") for i in range(90)])
    found = winnowing.find(docs, items)
    rows = {r.doc_id: r for r in found.documents.collect()}
    assert [tuple(s) for s in rows[1].spans] == [(2, 27)] and rows[0].spans == [] and rows[0].combination is None
    (combination,) = found.combinations.collect()  # one for all sixty documents
    assert combination["items"] == sorted(str(i) for i in range(40))


def test_empty_tables(spark, docs_of, nothing):
    items = items_of(spark, [(1, "one two three four five six")])
    assert reported(nothing, items) == []
    docs = [(1, "one two three four five six"), (None, "x")]
    for none in (items_of(spark, []), items_of(spark, [(1, None), (2, " . ")])):
        assert reported(docs_of(docs), none) == hits(docs, [])
