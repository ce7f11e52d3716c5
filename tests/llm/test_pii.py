from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm.brute import base_spans
from llm.samples import ODD, SF

from niaga.llm import pii
from niaga.llm.queries import op10_personal_data


def own(text):
    return [(pii.KINDS[k], s, e) for s, k, e in pii.base_spans(text)]


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(7)
    parts = ["a.b@c.de", "@", "x@y", "1.2.3.4", "256.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-2030", "+", "++4", " ", "-", "é", "word", "99", "_@", "007.1.1.1", ".com", "%", "\n", "0" * 30, "٣"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(12)))
        assert own(text) == base_spans(text), text
    for text in ("a@b.c_d@e.f", "x@y.z@w.v", "a@b@c.d", "a@-.-", "1.2.3.4.5.6.7.8", "+49 30 1234567 2020 99 88 77", "1" * 5000 + ".1.1.1"):
        assert own(text) == base_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000, "1 " * 200_000):
        pii.candidates(text)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_personal_data(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        base = base_spans(docs[r.doc_id])
        names = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in pii.KINDS)
        assert set(names) <= set(r.spans.split(",") if r.spans else [])


def test_reliabilities_find_the_good_labelers():
    rng = np.random.default_rng(8)
    truth = rng.random(6000) < 0.6
    right = np.array([0.95, 0.9, 0.9, 0.85, 0.55, 0.5])
    votes = np.where(rng.random((6000, 6)) < right, truth[:, None] * 2 - 1, 1 - truth[:, None] * 2)
    found, table = pii.reliabilities(votes, np.zeros(6000, int), np.ones(6000))
    assert ((found > 0.5) == truth).mean() > 0.96
    assert table[1, 0, 2] == pytest.approx(0.95, abs=0.03) and table[0, 5, 2] == pytest.approx(0.5, abs=0.05)


def test_pattern_codes():
    text = "mail me a.b@c.com or call (555) 010-2030, order 1.2.3.4"
    for c in pii.candidates(text):
        votes, features, kind = pii.unpacked(np.array([c.pattern]))
        expected = pii._votes(text, c.kind, c.start, c.end, c.base)
        assert (votes[0].tolist(), features[0].tolist(), kind[0]) == (*expected, c.kind)


def test_method_adds_spans_and_redacts(docs_of):
    rows = [(i, f"Call my phone (555) 010-{1000 + i} or +1 555 010 {2000 + i}, mail user{i}@mail.com today.") for i in range(60)]
    rows += [(100 + i, f"order version 12{i} 555.010.1{i:03d}9x and part {i}") for i in range(30)]
    got = {r.doc_id: r for r in pii.spans(docs_of(rows)).collect()}
    for i, text in rows[:60]:
        assert [s.kind for s in got[i].spans] == ["phone", "phone", "email"]
        assert [s.base for s in got[i].spans] == [False, True, True]
        assert got[i].redacted == "Call my phone <PHONE> or <PHONE>, mail <EMAIL> today."
    assert all(got[i].redacted == text for i, text in rows[60:])


def test_odd_rows(odd, nothing, docs_of):
    got = pii.spans(odd).collect()
    assert sorted((str(r.doc_id), r.redacted) for r in got) == sorted((str(i), t or "") for i, t in ODD)
    assert all(r.base == "" and not r.spans for r in got)
    assert pii.spans(nothing).count() == 0
    r = pii.spans(docs_of([(1, "\U0001f600 a@b.io")])).first()
    assert r.base == "email:2:8"


def test_very_many_spans_in_one_text():
    """Time in proportion to the spans: 100 000 of them, base and loose ones that meet each other or not."""
    import time

    r = random.Random(8)
    parts = [lambda i: f"+1 555 {i:07}", lambda i: f"a{i}(at)b.com", lambda i: f"x{i}@y.org", lambda i: f"(555) {i % 1000:03}-{i % 10000:04}"]
    text = " and ".join(r.choice(parts)(i) for i in range(100_000))
    model = pii.Model()
    started = time.monotonic()
    found = pii.candidates(text)
    assert len(found) >= 50_000
    pii.accepted(text, model)
    assert time.monotonic() - started < 60


def test_stretches_that_meet():
    r = random.Random(9)
    for _ in range(300):
        spans = sorted((s := r.randrange(50), 0, s + r.randrange(1, 12)) for _ in range(r.randrange(8)))
        taken, apart, kept = pii.Taken(spans), pii.Apart(), []
        for _ in range(20):
            a = r.randrange(50)
            b = a + r.randrange(1, 12)
            assert taken.meets(a, b) == any(s < b and a < e for s, _, e in spans)
            free = not any(s < b and a < e for s, e in kept)
            assert apart.add(a, b) == free
            kept += [(a, b)] if free else []
