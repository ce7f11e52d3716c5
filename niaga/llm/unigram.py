"""Token counts by a count-only Viterbi over a unigram vocabulary (operator 6).

Aho-Corasick lists every vocabulary piece that ends at each character, longest first. Dynamic programming carries the best
score and its piece count; a later candidate replaces the best one only if it scores more, so of equal paths the one whose last
piece starts first is taken, as in the unigram tokenizers (whose lattice is filled by increasing start). A character that is no
piece costs the least score less ten and counts as its UTF-8 bytes (byte fallback). No path is kept.

Blanks become U+2581 and one is put in front. No piece of the vocabulary has U+2581 behind another character (checked on
loading), so a path always breaks before a run of them: texts are cut there, and a worker remembers the results of short parts.
Scores are whole numbers, so sums are exact and parts add up to the whole text.

The public vocabularies hold no unigram model; pieces and scores of the sentencepiece file are taken as one. Results for odd rows: a
null or empty text has no tokens and score 0; a null id stays null; repeated rows give repeated rows; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from niaga.llm.common import batch, kept, slices, texts

BLANK = "▁"
UNKNOWN = 10.0  # below the least score
KNOWN_PARTS = 300_000  # parts a worker remembers; the older half is then forgotten and counted again when met
SHORT = 48  # characters of a part that is worth remembering


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, without control and byte pieces."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    usual = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in usual]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        if any(re.search(f"[^{BLANK}]{BLANK}", piece) for piece, _ in pieces):
            raise ValueError("a piece holds a blank behind another character: texts can't be cut at blanks")
        self.pieces = ahocorasick.Automaton()
        for piece, score in pieces:
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.longest = max((len(piece) for piece, _ in pieces), default=1)
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN
        self.parts = re.compile(f"{BLANK}+[^{BLANK}]*").findall
        self.known: dict[str, tuple[float, int]] = {}

    def viterbi(self, part: str) -> tuple[float, int]:
        """(best score, its pieces) of one part. Only as many places as the longest piece are held, in a ring."""
        size = self.longest + 1
        score, count = [0.0] + [float("-inf")] * self.longest, [0] * size
        matches = self.pieces.iter(part)
        match = next(matches, None)
        at = 0
        for end, last in enumerate(part, start=1):
            before, at = at, end % size
            best, pieces = float("-inf"), 0
            while match is not None and match[0] == end - 1:
                length, own = match[1]
                begin = (end - length) % size
                value = score[begin] + own
                if value > best:
                    best, pieces = value, count[begin] + 1
                match = next(matches, None)
            if last not in self.single and score[before] + self.unknown > best:
                best, pieces = score[before] + self.unknown, count[before] + len(last.encode())
            score[at], count[at] = best, pieces
        return score[at], count[at]

    def count(self, text: str) -> tuple[float, int]:
        total, pieces, known = 0.0, 0, self.known
        if not text:
            return total, pieces
        for part in self.parts(BLANK + text.replace(" ", BLANK)):
            found = known.get(part)
            if found is None:
                found = self.viterbi(part)
                if len(part) <= SHORT:
                    known[part] = found
            total += found[0]
            pieces += found[1]
        if len(known) > KNOWN_PARTS:
            self.known = dict(islice(known.items(), KNOWN_PARTS // 2, None))
        return total, pieces


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, score) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(f"unigram-{path}", lambda: Counter(vocabulary(path)))
        for part in slices(batches):
            found = [counter.count(text) for text in part.column("text").to_pylist()]
            yield batch(schema, part.column("doc_id"), [n for _, n in found], [s for s, _ in found])

    return texts(docs, id_col, text_col).mapInArrow(work, "doc_id long, n_tokens long, score double")
