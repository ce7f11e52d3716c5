from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm.samples import ODD, SF, rows_of
from tokenizers import Tokenizer

from niaga.llm import bpe
from niaga.llm.queries import op9_byte_bpe


@pytest.fixture(scope="module")
def reference():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    place = bpe.vocabulary()
    return bpe.Encoder(place["json"], place["pattern"])


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def strange(n, seed=5):
    r = random.Random(seed)
    kinds = [(32, 127), (1, 0x500), (0x2000, 0xD000), (0x10000, 0x20000)]
    mixed = ["".join(chr(r.randrange(*r.choice(kinds))) for _ in range(r.randrange(80))) for _ in range(n)]
    runs = [r.choice("a=- é0\n") * r.randrange(1, 200) + r.choice("ab '") * r.randrange(30) for _ in range(n)]
    return mixed + runs + ["<|endoftext|> and 's 'll", "", " ", "\r\n\r\n  x"]


def test_ids_are_those_of_the_rank_file_and_of_the_whole_tokenizer(coder, reference):
    whole = Tokenizer.from_file(bpe.vocabulary()["json"])
    whole.encode_special_tokens = True
    for text, raw in zip(values := strange(400), coder.encode(values), strict=True):
        assert ids(raw) == reference.encode_ordinary(text) == whole.encode(text, add_special_tokens=False).ids


def test_every_character_is_cut_as_in_the_reference(coder, reference):
    points = [c for c in range(0x3000) if c] + list(range(0xFB00, 0xFFFE, 3)) + list(range(0x10000, 0x1F000, 11))
    values = [f"a{chr(c)}1 {chr(c)}{chr(c)} b" for c in points]
    assert [ids(raw) for raw in coder.encode(values)] == [reference.encode_ordinary(v) for v in values]


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 900)
    place = bpe.vocabulary()
    small = bpe.Encoder(place["json"], place["pattern"])
    for text in ["one two three four five six", "six five one", "two two"]:
        assert ids(small.encode([text])[0]) == reference.encode_ordinary(text)
    assert len(small.known) < 12


def test_offsets_and_split_characters(spark, docs_of):
    text = "né \U0001f600x日"
    row = bpe.encode(docs_of([(1, text)]), offsets=True).first()
    starts, ends = ids(row.starts), ids(row.ends)
    table, at = bpe.byte_table(bpe.vocabulary()["json"])
    pieces = [table[at[i] : at[i + 1]].tobytes() for i in ids(row.ids)]
    assert starts[0] == 0 and ends[-1] == len(text) and b"".join(pieces).decode() == text
    for piece, s, e in zip(pieces, starts, ends, strict=True):
        assert piece in text[s:e].encode()  # whole characters around each token
    assert any(len(text[s:e].encode()) > len(p) for p, s, e in zip(pieces, starts, ends, strict=True))


def test_part_of_a_character_decodes_to_the_replacement(spark, docs_of):
    coded = bpe.encode(docs_of([(1, "\U0001f600")]))
    from pyspark.sql import functions as F

    cut = coded.withColumn("ids", F.substring("ids", 1, 4))
    row = bpe.decode(cut, as_text=True).first()
    assert "�" in row.text and row.decoded in "\U0001f600".encode()


def test_array_form(spark, odd):
    coded = bpe.encode(odd)
    got = {r.n_tokens: r.a for r in coded.filter("doc_id in (4, 7)").select("n_tokens", bpe.as_array("ids").alias("a"), "ids").collect()}
    raw = {r.n_tokens: ids(r.ids) for r in coded.filter("doc_id in (4, 7)").collect()}
    assert got == raw
    assert coded.filter("doc_id = 2").select(bpe.as_array("ids").alias("a")).first().a == []


def test_odd_rows(odd, nothing, reference):
    back = bpe.decode(bpe.encode(odd), as_text=True)
    got = rows_of(back, "doc_id", "text")
    assert got == sorted(((i, t or "") for i, t in ODD), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert bpe.decode(bpe.encode(nothing)).count() == 0


def test_query(spark, reference):
    got = {r.doc_id: r for r in op9_byte_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        own = np.array(reference.encode_ordinary(r.text or ""), "<u4")
        assert got[r.doc_id].n_tokens == len(own)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(own.tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def resident() -> int:
    """Megabytes that this process holds."""
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 >> 20


def test_memory_of_texts_without_blanks():
    """Matches of a script without blanks are mostly new ones: what is remembered is bounded by bytes."""
    place = bpe.vocabulary()
    encoder = bpe.Encoder(place["json"], place["pattern"])
    r = random.Random(4)
    text = lambda n: "\u3002".join("".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(n)) for _ in range(4000))
    encoder.encode([text(12)])
    before = resident()
    for _ in range(50):
        encoder.encode([text(12)])
    assert resident() - before < 150 and encoder.size < 2 * bpe.KNOWN_BYTES
    known = len(encoder.known)
    long = [text(300)]
    assert encoder.encode(long) == encoder.encode(long) and len(encoder.known) - known < 10
