"""Words and word runs of many texts at once, as 64-bit hashes in numpy.

A word is a maximal run of bytes other than 0x20 and 0x09 to 0x0D. Its hash is a polynomial over random
byte values modulo 2^64, taken from running sums, so that no Python code runs for a word.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from niaga.llm.common import kept

SEGMENT = 1 << 19  # bytes whose running sums are held at once
_BASE = 0x9E3779B97F4A7C15 | 1
_RUN_BASE = 0xD1342543DE82EF95 | 1


class Words(NamedTuple):
    first: np.ndarray  # byte offset of each word
    last: np.ndarray  # byte offset behind it
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (finalizer of the SplitMix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 .. base^n and their inverses, modulo 2^64."""

    def make(b: int) -> np.ndarray:
        return np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]).cumprod(dtype=np.uint64)

    name = f"powers-{base}"
    have = kept(name, lambda: {"n": -1})
    if have["n"] < n:
        have.update(n=n, up=make(base), down=make(pow(base, -1, 1 << 64)))
    return have["up"], have["down"]


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


def split(data: np.ndarray, offsets: np.ndarray, letters: bool = False) -> Words:
    """letters: words are runs of ASCII letters and bytes of other characters instead."""
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    if letters:
        word[:128] = False
        word[65:91] = word[97:123] = True
    inside = word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(first, last, np.searchsorted(first, offsets))


def hashes(data: np.ndarray, words: Words, lower: bool = False, stems: tuple[int, ...] = ()) -> np.ndarray:
    """A hash for each word, the same wherever it stands. lower: A-Z count as a-z.

    stems: a further row for each number, with hashes of the words' first so many bytes.
    """
    lasts = [words.last, *(np.minimum(words.last, words.first + k) for k in stems)]
    out = np.empty((len(lasts), len(words.first)), np.uint64)
    values, at = _byte_values(lower), 0
    while at < len(words.first):
        begin = words.first[at]
        upto = max(at + 1, int(np.searchsorted(words.last, begin + SEGMENT, "right")))
        size = int(words.last[upto - 1] - begin)
        up, down = _powers(_BASE, max(size, SEGMENT))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[begin : begin + size]] * up[:size], out=sums[1:])
        s = words.first[at:upto] - begin
        before, undo = sums[s], down[s]
        for row, last in zip(out, lasts, strict=True):
            row[at:upto] = (sums[last[at:upto] - begin] - before) * undo
        at = upto
    out = mix(out)
    return out if stems else out[0]


def runs(hashed: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A hash of words i to i + k - 1 for each i (over text borders too: pick the valid ones)."""
    n = len(hashed) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = mix(hashed + np.uint64(salt)) if salt else hashed
    out = np.empty(n, np.uint64)
    step = SEGMENT
    for at in range(0, n, step):
        part = h[at : at + step + k - 1]
        up, down = _powers(_RUN_BASE, SEGMENT + 4096)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        m = len(part) - k + 1
        out[at : at + m] = (sums[k:] - sums[:m]) * down[:m]
    return mix(out)


def run_starts(bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, word index) of every run of k words that lies in one text."""
    counts = np.maximum(np.diff(bounds) - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return text, np.arange(counts.sum()) - np.repeat(before, counts) + np.repeat(bounds[:-1], counts)
