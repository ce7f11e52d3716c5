from __future__ import annotations

import random

import pytest
import public_tokenizers
import sentencepiece
from llm.samples import ODD, SF
from tokenizers import Tokenizer, models

from niaga.llm import unigram
from niaga.llm.queries import op6_unigram_counts


@pytest.fixture(scope="module")
def counter():
    return unigram.Counter(unigram.vocabulary())


@pytest.fixture(scope="module")
def reference():
    """The unigram model of the tokenizers library with the same pieces, byte pieces last so that scores are the same."""
    pieces = unigram.vocabulary()
    low = min(s for _, s in pieces)
    return Tokenizer(models.Unigram([("<unk>", low), *pieces, *((f"<0x{b:02X}>", low) for b in range(256))], 0, True))


def plain(reference, text):
    return len(reference.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0


def test_counts_are_those_of_the_library(counter, reference):
    r = random.Random(6)
    kinds = [(97, 123), (32, 127), (0xC0, 0x250), (0x4E00, 0x4F00), (0x10000, 0x10050)]
    values = ["".join(chr(r.randrange(*r.choice(kinds))) if r.random() < 0.8 else " " for _ in range(r.randrange(60))) for _ in range(800)]
    values += ["  two  blanks ", "▁own", "a" * 500, " ", "\n\n x", "word " * 50, "\U0001f600\U0001f600 x"]
    for text in values:
        text = text.replace("<", "(")  # the library would match the names of byte pieces in a text
        assert counter.count(text)[1] == plain(reference, text), text


def test_best_score_by_all_paths():
    pieces = [("▁", -1.0), ("▁a", -2.0), ("a", -1.0), ("b", -3.0), ("ab", -2.0), ("aba", -4.0), ("ba", -2.0)]
    counter = unigram.Counter(pieces)
    scores = dict(pieces)

    def best(part):
        if not part:
            return 0.0
        options = [scores[part[:n]] + best(part[n:]) for n in range(1, len(part) + 1) if part[:n] in scores]
        if part[0] not in scores:
            options.append(-14.0 + best(part[1:]))
        return max(options)

    for text in ("a", "ab", "abab", "aab", "bcb", "baab", "cc"):
        assert counter.viterbi("▁" + text)[0] == best("▁" + text)


def test_equal_paths_take_the_earliest_start():
    counter = unigram.Counter([("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁aa", -3.0)])
    assert counter.viterbi("▁aa") == (-3.0, 1)


def test_pieces_across_blanks_are_refused():
    with pytest.raises(ValueError):
        unigram.Counter([("a▁b", -1.0)])


def test_forgetting_changes_nothing(monkeypatch, counter):
    monkeypatch.setattr(unigram, "KNOWN_PARTS", 2)
    small = unigram.Counter(unigram.vocabulary())
    for text in ("one two three", "three two four", "one"):
        assert small.count(text) == counter.count(text)


def test_query_and_odd_rows(spark, odd, nothing, counter):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op6_unigram_counts(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got[:100]:
        assert (r.score, r.n_tokens) == counter.count(docs[r.doc_id])
    found = unigram.token_counts(odd).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in ODD)
    assert {r.n_tokens for r in found if r.doc_id in (1, 2)} == {0}
    assert unigram.token_counts(nothing).count() == 0


def test_vocabulary_is_the_file():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert len(unigram.vocabulary()) == model.get_piece_size() - 3 - 256


def test_memory_of_a_very_long_run():
    """A run of characters without a blank holds as many places as the longest piece."""
    import tracemalloc

    counter = unigram.Counter([("\u2581", -1.0), ("a", -2.0), ("aa", -3.0), ("aaaa", -4.0)])
    part = "\u2581" + "aab" * 200_000
    tracemalloc.start()
    score, n = counter.viterbi(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1 + 200_000 * 2 and peak < 5 << 20  # a copy of the text
