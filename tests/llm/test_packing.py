from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from llm.samples import ODD, SF
from tokenizers import Tokenizer

from niaga.llm import bpe, packing
from niaga.llm.queries import op2_packing


def expected(rows):
    whole = Tokenizer.from_file(bpe.vocabulary()["json"])
    return [(i, [*whole.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def check(pieces, rows, window=2048):
    """Each id in one piece, no gap in a sequence, padding only below a full window and never here."""
    left = defaultdict(list)
    for i, ids in expected(rows):
        left[i].append(ids)
    sequences, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        texts[p.doc_id, p.doc_tokens].append(p)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window
    assert sum(len(ids) for many in left.values() for ids in many) == sum(p.length for p in pieces)
    return left, texts


def test_query_holds_every_id_once(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    pieces = op2_packing(spark, SF).collect()
    left, texts = check(pieces, rows)
    for (i, total), own in texts.items():
        (ids,) = left[i]
        assert len(ids) == total
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == total


def test_odd_rows_and_small_windows(odd, nothing):
    pieces = packing.pack(odd, window=64).collect()
    check(pieces, ODD, 64)
    assert {p.doc_id for p in pieces} == {i for i, _ in ODD}
    assert packing.pack(nothing).count() == 0


def test_shards_are_bounded(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 300)
    rows = [(i, f"text number {i} " * 20) for i in range(60)]
    check(packing.pack(docs_of(rows, 2)).collect(), rows)


def test_neighbours_share_rare_terms():
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * t, 1000 * t + 40, (10, 100)) for t in (1, 2, 3)]
    rows = [topics[i % 3][i // 3] for i in range(30)]
    ids, sizes = np.concatenate(rows).astype("<u2"), np.full(30, 100)
    holds = np.bincount(packing._distinct(ids, sizes)[1], minlength=packing.VOCABULARY)
    inverse = np.log1p((30 - holds + 0.5) / (holds + 0.5))
    order = packing.neighbour_order(ids, sizes, inverse, 100.0, 500)
    assert sorted(order) == list(range(30))
    windows = [{int(i) % 3 for i in order[k : k + 5]} for k in range(0, 30, 5)]
    assert all(len(w) == 1 for w in windows)


def test_statistics_count_every_row(docs_of):
    rows = [(i, t) for i, t in enumerate(["a b", "a", "", None, "b b b"])]
    holds, n, mean = packing.term_statistics(packing.encoded(docs_of(rows)))
    own = expected(rows)
    assert n == 5 and mean == sum(len(x) for _, x in own) / 5
    for term in {t for _, x in own for t in x}:
        assert holds[term] == sum(term in x for _, x in own)


def test_rest_is_cut_into_powers_of_two():
    for total in (1, 63, 64, 65, 200, 4096, 5000):
        sizes = np.diff(np.concatenate([[0], packing.boundaries(total, 64)]))
        assert sizes.sum() == total and all(s == 64 or s & (s - 1) == 0 for s in sizes)
        assert (np.diff(sizes) <= 0).all()


def test_related_texts_of_other_files_meet(docs_of, monkeypatch):
    """Pairs that share rare words lie far apart in the input, in partitions of their own."""
    monkeypatch.setattr(packing, "SHARD", 6000)
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("zor", "mik", "plu", "qan", "vex", "tyb", "hux", "jaf") for b in ("dle", "grot", "wump", "shiv", "nock", "brez")]
    topics = [" ".join(rng.choice(rng.permutation(words)[:4], 60)) for _ in range(40)]
    rows = [(k, f"{topics[k % 40]} it is the same as before and so it is") for k in range(120)]
    pieces = packing.pack(docs_of(rows, 12), window=512).collect()
    check(pieces, rows, 512)
    sequences = defaultdict(set)
    for p in pieces:
        sequences[p.sequence_id].add(p.doc_id)
    met = {(a, b) for own in sequences.values() for a in own for b in own if a < b and a % 40 == b % 40}
    assert len({k % 40 for k, _ in met}) >= 36


def test_all_terms_of_a_seed_ask():
    """The seed's neighbour shares only its thirteenth term; the row between shares none."""
    rows = [np.arange(100, 113), np.arange(300, 313), np.array([112] + [*range(400, 412)])]
    ids, sizes = np.concatenate(rows).astype("<u2"), np.full(3, 13)
    inverse = np.ones(packing.VOCABULARY, np.float32)
    inverse[112] = 0.5
    assert [*packing.neighbour_order(ids, sizes, inverse, 13.0, 26)][:2] == [0, 2]


def test_texts_that_meet_none_try_their_next_rare_term():
    keys = np.full((3, packing.KEYS), packing.END, np.uint16)
    keys[0, :2], keys[1, :2], keys[2, :1] = (10, 30), (20, 30), (40,)
    first = np.bincount(keys[:, 0], minlength=packing.VOCABULARY)
    second = np.bincount(keys[:, 1], minlength=packing.VOCABULARY)
    second[packing.END] = 0
    assert packing.settled(keys, [first, second]).tolist() == [1, 1, -1]
    signed = packing.signatures(keys, [first, second], np.zeros(3, np.uint64))
    assert signed[0][:2] == signed[1][:2] == b"\x00\x1e"


def test_added_tokens_in_a_text_have_their_ids(docs_of):
    mark = "<|endoftext|>"
    rows = [(1, f"a{mark}b"), (2, f"{mark}{mark} one {mark}"), (3, f"two words {mark} 日本\n{mark[:-1]}"), (4, "<|endoftext|")]
    whole = Tokenizer.from_file(bpe.vocabulary()["json"])
    assert whole.encode(rows[0][1], add_special_tokens=False).ids == [64, 50256, 65]
    for p in packing.encoded(docs_of(rows)).collect():
        assert np.frombuffer(p.ids, "<u2").tolist() == [*whole.encode(dict(rows)[p.doc_id], add_special_tokens=False).ids, 1]


def test_ids_come_as_arrays_and_equal_the_lists(spark):
    """No list of Python numbers is made for a text: the ids of ``encode`` are those of ``encode_to_numpy``."""
    import inspect

    from niaga.llm import bpe, packing

    place = bpe.vocabulary()
    coder = packing.rank_encoder(place["ranks"], place["pattern"], packing.added_tokens(place["json"]))
    said = ["", "Selamat pagi, dunia 123", "a<|endoftext|>b", "\U0001f600\x00 é中"]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.ids) for r in packing.encoded(docs).collect()}
    assert got == {i: b"".join(n.to_bytes(2, "little") for n in [*coder.encode(t, allowed_special="all"), packing.END]) for i, t in enumerate(said)}
    assert "encode_to_numpy" in inspect.getsource(packing.encoded) and "coder.encode(" not in inspect.getsource(packing.encoded)
