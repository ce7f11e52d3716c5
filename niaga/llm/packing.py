"""Lexical retrieval packing (operator 2): documents that share rare terms fill a training sequence together.

Texts are encoded once and the ids written. Term statistics (documents that hold a token id, mean length) are summed over
the whole corpus. Each text is placed by a rare term that it shares with others anywhere: in ROUNDS rounds, the texts that no
other meets at their rarest shared term go on to their next one, where they meet what was placed there and what goes on with
them. Texts are dealt to shards of bounded size in the order of that term and then of their other rare terms, so a term that
holds more than a shard is split where its texts differ, and how rows lie in files decides nothing but the order of equal texts.

A shard has a BM25 inverted index over token ids. The first unused document seeds a window; all its terms fetch unused
neighbours, best first, which fill the window. A document that overshoots is cut, and its rest seeds the next window, so all
windows of a shard but its rest are full. That rest is cut into sequences whose lengths are powers of two, which take no padding.

Results for odd rows: a null or empty text is the end-of-document id alone; a null id stays null; repeated rows are packed
each; equal BM25 scores go to the earlier row of the shard; a text longer than a shard fills one by itself; other columns
are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm import bpe
from niaga.llm.common import batch, cut, kept, slices, texts

WINDOW = 2048
END = 1  # the id behind each document
SHARD = 4_000_000  # ids in a shard, or one document
KEYS = 8  # rare terms of a text that order it
ROUNDS = 4  # of them, tried in turn until others meet it
FIRST = 64  # neighbours that are put in order before the others
SAMPLED = 128  # texts looked at for the bounds of one shard
SAMPLE_ROWS = 1 << 18  # and of all of them together, at any size of the input
RANGES = 8192  # ranges that the texts are dealt into, at most
K1, B = 1.2, 0.75
VOCABULARY = 1 << 16  # ids are held in two bytes


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that a tokenizers file adds to its vocabulary. Texts are split at them, as the library does by default."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    return {t["content"]: t["id"] for t in added}


def rank_encoder(path: str, pattern: str, added: dict[str, int] | None = None):
    """The vocabulary from its rank file. The ids are those of the tokenizers library for the same vocabulary (``tests/llm``
    compares the two), at a quarter of the time where most words are new."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added or {})


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids): two bytes an id, the end-of-document id included."""
    place = bpe.vocabulary()
    added = {} if path else added_tokens(place["json"])
    path, pattern = path or place["ranks"], pattern or place["pattern"]
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    end = np.array([END], "<u2").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept(f"ranks-{path}-{added}", lambda: rank_encoder(path, pattern, added))
        for part in slices(batches):
            ids = [coder.encode_to_numpy(text, allowed_special="all").astype("<u2").tobytes() + end for text in part.column("text").to_pylist()]
            yield batch(schema, part.column("doc_id"), ids)

    return texts(docs).mapInArrow(work, "doc_id long, ids binary")


def _distinct(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, id, count) of each id of each text, in this order, in four bytes each."""
    kind = np.uint32 if len(sizes) <= 1 << 16 else np.uint64
    key = np.repeat(np.arange(len(sizes), dtype=kind) << kind(16), sizes)
    key |= ids
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])).astype(np.int32) if len(key) else np.zeros(0, np.int32)
    text, term = (key[at] >> kind(16)).astype(np.int32), (key[at] & kind(VOCABULARY - 1)).astype(np.int32)
    return text, term, np.diff(np.append(at, np.int32(len(key))))


def term_statistics(coded: DataFrame) -> tuple[np.ndarray, int, float]:
    """(documents per id, documents, mean ids of a document), over all rows; at most VOCABULARY rows reach the driver."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds, rows, length = np.zeros(VOCABULARY, np.int64), 0, 0
        for part in slices(batches, "ids"):
            raw = part.column("ids").to_pylist()
            sizes = np.array([len(r) // 2 for r in raw])
            holds += np.bincount(_distinct(np.frombuffer(b"".join(raw), "<u2"), sizes)[1], minlength=VOCABULARY)
            rows, length = rows + len(raw), length + int(sizes.sum())
        used = np.flatnonzero(holds)
        yield batch(schema, np.concatenate([used, [-1, -2]]), np.concatenate([holds[used], [rows, length]]))

    holds, rows, length = np.zeros(VOCABULARY), 0, 0
    for r in coded.mapInArrow(work, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r.term >= 0:
            holds[r.term] = r.n
        elif r.term == -1:
            rows = r.n
        else:
            length = r.n
    return holds, rows, length / max(rows, 1)


def rarity(holds: np.ndarray) -> tuple[np.ndarray, int]:
    """(place of each id, number of shared ids): ids that several texts hold come first, the rarest before; equal ones by id."""
    shared = holds > 1
    shared[END] = False
    place = np.empty(VOCABULARY, np.uint16)
    place[np.lexsort((np.arange(VOCABULARY), holds, ~shared))] = np.arange(VOCABULARY)
    return place, int(shared.sum())


def rare_terms(ids: np.ndarray, sizes: np.ndarray, place: np.ndarray, shared: int) -> np.ndarray:
    """(texts, KEYS): the rarest terms of each text that another text holds too, the rarest first; END fills up."""
    text, nth, _ = _distinct(place[ids], sizes)
    begin = np.searchsorted(text, np.arange(len(sizes)))
    which = np.arange(len(text)) - begin[text]
    first = (which < KEYS) & (nth < shared)
    term = np.empty(VOCABULARY, np.uint16)
    term[place] = np.arange(VOCABULARY)
    out = np.full((len(sizes), KEYS), END, np.uint16)
    out[text[first], which[first]] = term[nth[first]]
    return out


def settled(keys: np.ndarray, meets: list[np.ndarray]) -> np.ndarray:
    """The round in which each text met another, or -1."""
    at = np.full(len(keys), -1)
    for r, n in enumerate(meets):
        at[(at < 0) & (n[keys[:, r]] > 1)] = r
    return at


def signatures(keys: np.ndarray, meets: list[np.ndarray], salt: np.ndarray) -> np.ndarray:
    """Byte strings in whose order texts are dealt: the term at which a text met others, its rare terms, the salt."""
    chosen = keys[np.arange(len(keys)), np.maximum(settled(keys, meets), 0)]
    whole = np.concatenate([chosen[:, None].astype(">u2").view(np.uint8), keys.astype(">u2").view(np.uint8), salt.astype(">u8").reshape(-1, 1).view(np.uint8)], axis=1)
    return np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").ravel()


def salts(n: int, before: int) -> np.ndarray:
    """A number of each row of this task that tells equal texts apart."""
    number = np.arange(before, before + n, dtype=np.uint64) + np.uint64(TaskContext.get().partitionId() << 40)
    number *= np.uint64(0x9E3779B97F4A7C15)
    return number ^ (number >> np.uint64(29))


def meetings(light: DataFrame) -> list[np.ndarray]:
    """For each round, how many texts meet at each term: those that settled there and those that try it. VOCABULARY counts a round."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])
    meets: list[np.ndarray] = []
    for r in range(ROUNDS):

        def work(batches: Iterator[pa.RecordBatch], r: int = r, known: tuple = tuple(meets)) -> Iterator[pa.RecordBatch]:
            n = np.zeros(VOCABULARY, np.int64)
            for part in batches:
                keys = np.frombuffer(b"".join(part.column("keys").to_pylist()), np.uint16).reshape(-1, KEYS)
                at = settled(keys, list(known))
                n += np.bincount(keys[np.arange(len(keys)), np.where(at < 0, r, at)], minlength=VOCABULARY)
            n[END] = 0
            used = np.flatnonzero(n)
            yield batch(schema, used, n[used])

        n = np.zeros(VOCABULARY, np.int64)
        for row in light.select("keys").mapInArrow(work, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            n[row.term] = row.n
        meets.append(n)
    return meets


def dealt(coded: DataFrame, holds: np.ndarray, rows: int, total: int) -> DataFrame:
    """(doc_id, ids) in the order of their signatures, each partition about a shard."""
    schema = pa.schema([("keys", pa.binary()), ("salt", pa.int64()), ("size", pa.int64())])
    ranked, shared = rarity(holds)

    def keyed(part: pa.RecordBatch, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = part.column("ids").to_pylist()
        sizes = np.array([len(r) // 2 for r in raw])
        return rare_terms(np.frombuffer(b"".join(raw), "<u2"), sizes, ranked, shared), salts(len(raw), before), sizes

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for part in slices(batches, "ids"):
            keys, salt, sizes = keyed(part, before)
            before += len(keys)
            yield batch(schema, [k.tobytes() for k in keys], salt.view(np.int64), sizes)

    light = cut(coded.mapInArrow(keys_of, "keys binary, salt long, size long"))
    light = light.coalesce(rows // 32_768 + 1)  # some bytes a row
    meets = meetings(light)
    # a quarter above what is needed: bounds are estimates. Beyond RANGES a task cuts several shards from its sorted rows.
    shards = min(RANGES, max(1, -(-total * 5 // (SHARD * 4))))
    every = max(1, rows // min(SAMPLED * shards, SAMPLE_ROWS))
    sample = light.filter(F.pmod(F.xxhash64("keys", "salt"), F.lit(every)) == 0).toArrow()
    bounds = np.zeros(0, "S1")
    if sample.num_rows:
        keys = np.frombuffer(b"".join(sample.column("keys").to_pylist()), np.uint16).reshape(-1, KEYS)
        signed = signatures(keys, meets, sample.column("salt").to_numpy().view(np.uint64))
        order = np.argsort(signed, kind="stable")
        sums = np.cumsum(sample.column("size").to_numpy()[order])
        ends = np.searchsorted(sums, sums[-1] * np.arange(1, shards) / shards)
        bounds = signed[order][ends]
    schema_out = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("signed", pa.binary()), ("shard", pa.int32())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for part in slices(batches, "ids"):
            keys, salt, _ = keyed(part, before)
            before += len(keys)
            signed = signatures(keys, meets, salt)
            shard = np.searchsorted(bounds, signed, "right") if len(bounds) else np.zeros(len(signed), np.int64)
            padded = [x.ljust(signed.itemsize, b"\0") for x in signed.tolist()]
            yield batch(schema_out, part.column("doc_id"), part.column("ids"), padded, shard)

    placed = coded.mapInArrow(place, "doc_id long, ids binary, signed binary, shard int")
    return placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("signed").select("doc_id", "ids")


def neighbour_order(ids: np.ndarray, sizes: np.ndarray, inverse: np.ndarray, mean: float, window: int) -> np.ndarray:
    """The order in which the texts of a shard are laid end to end."""
    n = len(sizes)
    text, term, count = _distinct(ids, sizes)
    length = (K1 * (1 - B + B * sizes / max(mean, 1))).astype(np.float32)
    impact = inverse[term] * count.astype(np.float32) * np.float32(K1 + 1)
    impact /= length[text] + count
    own = np.searchsorted(text, np.arange(n + 1))
    unused, live = np.ones(n, bool), np.arange(n)
    members = impacts = lists = row = dense = np.zeros(0)

    def index() -> None:
        """The lists over the unused texts. Those of common terms are rows of a matrix: quicker to add up, at most four times as large."""
        nonlocal live, members, impacts, lists, row, dense
        live = np.flatnonzero(unused)
        local = np.full(n, -1, np.int32)
        local[live] = np.arange(len(live))
        held = np.flatnonzero(unused[text])
        held = held[np.argsort(term[held].astype(np.uint16), kind="stable")]  # two bytes: numpy then sorts by counting
        lists = np.searchsorted(term[held], np.arange(VOCABULARY + 1))
        members, impacts = local[text[held]].astype(np.intp), impact[held].astype(np.float64)
        common = np.flatnonzero(np.diff(lists) * 4 > len(live))
        row = np.full(VOCABULARY, -1)
        row[common] = np.arange(len(common))
        dense = np.zeros((len(common), len(live)), np.float32)
        inside = row[term[held]] >= 0
        dense[row[term[held[inside]]], members[inside]] = impacts[inside]

    def best(score: np.ndarray) -> Iterator[int]:
        """Texts of a score, the best first; equal ones in their order."""
        near = np.flatnonzero(score)
        value = score[near]
        if len(near) > 4 * FIRST:
            ahead = value >= np.partition(value, len(value) - FIRST)[len(value) - FIRST]
            yield from near[ahead][np.argsort(-value[ahead], kind="stable")].tolist()
            near, value = near[~ahead], value[~ahead]
        yield from near[np.argsort(-value, kind="stable")].tolist()

    order = np.empty(n, np.int64)
    placed, filled, first, seed = 0, 0, 0, -1

    def place(i: int) -> None:
        nonlocal placed, filled, seed
        order[placed] = i
        unused[i] = False
        placed, filled = placed + 1, filled + int(sizes[i])
        if filled >= window:  # its rest begins the next window
            filled, seed = filled % window, i if filled % window else -1

    while placed < n:
        if seed < 0:
            while not unused[first]:
                first += 1
            seed = first
            place(first)
            continue
        if not len(lists) or len(live) > 256 and (n - placed) * 2 < len(live):
            index()
        asked = term[own[seed] : own[seed + 1]]
        few = asked[row[asked] < 0]
        begin, long = lists[few], lists[few + 1] - lists[few]
        at = np.arange(long.sum()) + np.repeat(begin - np.cumsum(long) + long, long)  # the lists end to end
        rows = row[asked[row[asked] >= 0]]
        score = np.add.reduce(dense[rows], axis=0).astype(np.float64)
        score += np.bincount(members[at], impacts[at], len(live))
        score[~unused[live]] = 0
        asking = seed
        for i in best(score):
            place(int(live[i]))
            if seed != asking:
                break
        if seed == asking:  # no neighbour is left: the next unused text seeds what remains of the window
            while first < n and not unused[first]:
                first += 1
            if first < n:
                seed = first
                place(first)
    return order


def boundaries(total: int, window: int) -> np.ndarray:
    """Ends of the sequences that cover ``total`` ids: full windows, then powers of two, the largest first."""
    rest = total % window
    powers = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    return np.concatenate([np.arange(window, total - rest + 1, window), total - rest + np.cumsum(np.array(powers, np.int64))]).astype(np.int64)


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset."""
    coded = cut(encoded(docs, path, pattern))
    holds, rows, mean = term_statistics(coded)
    inverse = np.log1p((rows - holds + 0.5) / (holds + 0.5)).astype(np.float32)
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    schema = pa.schema([*fields, ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def pieces(names: list, raw: list[bytes], sequence: int) -> tuple[pa.RecordBatch, int]:
        sizes = np.array([len(r) // 2 for r in raw])
        order = neighbour_order(np.frombuffer(b"".join(raw), "<u2"), sizes, inverse, mean, window)
        behind = np.cumsum(sizes[order])
        ends = boundaries(int(behind[-1]), window)
        cuts = np.union1d(behind, ends)
        begins = np.concatenate([[0], cuts[:-1]])
        of, within = np.searchsorted(behind, cuts), np.searchsorted(ends, cuts)
        doc = order[of]
        start = begins - (behind[of] - sizes[doc])
        length = cuts - begins
        wide = [np.frombuffer(raw[d], "<u2")[s : s + k].astype("<u4").tobytes() for d, s, k in zip(doc, start, length, strict=True)]
        offset = begins - np.concatenate([[0], ends[:-1]])[within]
        out = batch(schema, [names[d] for d in doc], start, length, wide, sizes[doc], sequence + within, offset)
        return out, sequence + len(ends)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, raw, held, sequence = [], [], 0, TaskContext.get().partitionId() << 40
        for part in slices(batches, "ids"):
            for name, value in zip(part.column("doc_id").to_pylist(), part.column("ids").to_pylist(), strict=True):
                if held and held + len(value) // 2 > SHARD:
                    out, sequence = pieces(names, raw, sequence)
                    yield out
                    names, raw, held = [], [], 0
                names.append(name)
                raw.append(value)
                held += len(value) // 2
        if raw:
            yield pieces(names, raw, sequence)[0]

    spread = dealt(coded, holds, rows, round(mean * rows))
    return spread.mapInArrow(work, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
