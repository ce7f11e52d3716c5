"""Byte-level BPE encoding with offsets, and decoding (operator 9).

Texts are cut by the pattern of the vocabulary. The bytes of a match are written as characters, and the BPE model of the
tokenizers library encodes each distinct match that the worker has not met before, so that merges never cross a match; the
ids of a text are those of its matches in order. Ids are held as little-endian unsigned 32-bit integers in a binary column, the form that is hashed and stored.

Results for odd rows: a null text is encoded as the empty one (no ids); a null id stays null; repeated rows give repeated
rows; other columns of the input are ignored; an empty table gives an empty one. A text of any length is one row.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niaga.llm.common import batch, kept, slices, text_buffer, texts

KNOWN_BYTES = 48 << 20  # of the matches a worker remembers (about); the older half is then forgotten and encoded again when met
SHORT = 64  # characters of a match that is worth remembering
ENTRY = 250  # bytes of a remembered match beside its characters and ids


def vocabulary(name: str = "byte_bpe_50k") -> dict[str, str]:
    """Places of the vocabulary in its two forms, and the pattern that splits texts."""
    import public_tokenizers

    return {
        "json": public_tokenizers.path(f"{name}.json"),
        "ranks": public_tokenizers.path(f"{name}.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def byte_characters() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte: the visible Latin-1 ones stand for themselves, the
    others are moved behind U+0100 in their order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class Encoder:
    """Ids of texts as bytes of unsigned integers of ``width`` bytes."""

    def __init__(self, path: str, pattern: str, width: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model  # the merges alone: no string of a text is a special token
        self.written = {b: ord(c) for b, c in enumerate(byte_characters())}
        self.find = regex.compile(pattern).findall
        self.kind = f"<u{width}"
        self.known: dict[str, bytes] = {}
        self.size = 0  # bytes of what is known (about)

    def match_ids(self, match: str) -> bytes:
        written = match.encode().decode("latin-1").translate(self.written)
        return np.array([token.id for token in self.model.tokenize(written)], self.kind).tobytes()

    def encode(self, values: list[str]) -> list[bytes]:
        matches = [self.find(v) for v in values]
        if self.size > KNOWN_BYTES:
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
            self.size //= 2
        distinct: set[str] = set()
        for found in matches:
            distinct.update(found)
        long: dict[str, bytes] = {}
        for match in distinct.difference(self.known):
            made = self.match_ids(match)
            if len(match) <= SHORT:
                self.known[match] = made
                self.size += ENTRY + 4 * len(match) + len(made)
            else:
                long[match] = made
        ids = {**long, **{m: self.known[m] for m in distinct if m not in long}}.__getitem__ if long else self.known.__getitem__
        return [b"".join(map(ids, found)) for found in matches]


def encoder(path: str, pattern: str, width: int = 4) -> Encoder:
    return kept(f"encoder-{path}-{width}", lambda: Encoder(path, pattern, width))


def _byte_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids one after another, and where each id's bytes begin."""
    from tokenizers import Tokenizer

    byte_of = {c: b for b, c in enumerate(byte_characters())}
    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    pieces = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        pieces[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    ends = np.cumsum([0, *map(len, pieces)])
    return np.frombuffer(b"".join(pieces), np.uint8), ends


def byte_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    return kept(f"bytes-{path}", lambda: _byte_table(path))


def _pieces(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return starts[ids + 1] - starts[ids]


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    offsets: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, ids), with offsets also the first character and the character behind each token.

    ``ids``, ``starts`` and ``ends`` are binary columns of unsigned 32-bit integers (see ``as_array``). A token that holds
    a part of a character counts from that character, and to behind it.
    """
    place = vocabulary()
    path, pattern = path or place["json"], pattern or place["pattern"]
    fields = "doc_id long, n_tokens long, ids binary" + ", starts binary, ends binary" * offsets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        starts = byte_table(path)[1]
        kinds = [pa.field("doc_id", pa.int64()), pa.field("n_tokens", pa.int64())]
        schema = pa.schema(kinds + [pa.field(c, pa.binary()) for c in ("ids", "starts", "ends")[: 3 if offsets else 1]])
        for part in slices(batches):
            coded = coder.encode(part.column("text").to_pylist())
            columns = [part.column("doc_id"), [len(c) // 4 for c in coded], coded]
            if offsets:
                columns += _offsets(part.column("text"), coded, starts)
            yield batch(schema, *columns)

    return texts(docs, id_col, text_col).mapInArrow(work, fields)


def _offsets(column: pa.Array, coded: list[bytes], table: np.ndarray) -> list[list[bytes]]:
    """Character offsets: byte ends of the tokens, mapped by the count of characters begun before each byte."""
    data, at = text_buffer(column)
    first, behind = [], []
    for i, raw in enumerate(coded):
        ends = np.cumsum(_pieces(np.frombuffer(raw, "<u4").astype(np.int64), table))
        begun = np.concatenate([[0], np.cumsum((data[at[i] : at[i + 1]] & 0xC0) != 0x80)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        first.append((begun[starts + 1] - 1 if len(ends) else ends).astype("<u4").tobytes())
        behind.append(begun[ends].astype("<u4").tobytes())
    return [first, behind]


def decode(coded: DataFrame, path: str | None = None, as_text: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded bytes) of the rows of ``encode``; with as_text also the text, in which bytes that
    are no whole characters stand as U+FFFD. An id outside the vocabulary fails the task: nothing is decoded in its place.
    """
    path = path or vocabulary()["json"]
    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
    schema = pa.schema(kinds + [("text", pa.string())] * as_text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts = byte_table(path)
        for part in slices(batches, "ids"):
            ids = [raw or b"" for raw in part.column("ids").to_pylist()]
            out = [_decoded(raw, table, starts) for raw in ids]
            columns = [part.column("doc_id"), [len(raw) // 4 for raw in ids], ids, out]
            yield batch(schema, *columns, *[[b.decode("utf-8", "replace") for b in out]] * as_text)

    fields = "doc_id long, n_tokens long, ids binary, decoded binary" + ", text string" * as_text
    return coded.select("doc_id", "ids").mapInArrow(work, fields)


def _decoded(raw: bytes, table: np.ndarray, starts: np.ndarray) -> bytes:
    ids = np.frombuffer(raw, "<u4").astype(np.int64)
    sizes = _pieces(ids, starts)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return table[np.arange(total) + np.repeat(starts[ids] - ends + sizes, sizes)].tobytes()


def as_array(column: str) -> Column:
    """A binary column of unsigned 32-bit integers as array<long>, for use with SQL functions."""
    byte = lambda i, j: F.hex(F.substring(F.col(column), (i * 4 + j).cast("int"), F.lit(1)))
    number = lambda i: F.conv(F.concat(*[byte(i, j) for j in (4, 3, 2, 1)]), 16, 10).cast("long")
    count = (F.length(column) / 4).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), number)).otherwise(F.array().cast("array<long>"))
