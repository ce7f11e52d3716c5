"""Removal of repeated word runs by a compacted de Bruijn graph (operator 7).

A window of ``window`` words is an edge of a de Bruijn graph. A text is a path through it. The path is cut into chunks of
consecutive windows that share their minimizer (the smallest hash of ``ANCHOR`` words in the window), so equal windows
always lie in chunks with the same anchor. A chunk is one record with a hash of its anchor and one of all its words, and
Spark joins compact the graph by them:

* an anchor of one record is unique text and goes no further;
* where all chunks of an anchor are equal, the path does not branch: the smallest doc_id of the anchor holds for all its
  windows at once;
* where they differ, the path branches (a passage begins or ends, a copy was changed). All windows of a chunk repeat the
  first document with an equal chunk. That one document's chunk is read again by its source coordinates and its windows
  are hashed one by one, which finds the windows that stand in a still earlier document.

No pair of texts is ever formed, equal chunks meet in partial aggregates, and hot anchors are joined to one row, which the
skew join splits. Texts are shuffled only where a fixed-size filter says that they may be needed. Words equal words by 64-bit
hashes; chunks and windows also agree in the hash of their anchor, so 128 bits stand for each.

Results for odd rows: a null or empty text has no words; a text shorter than the window is kept whole; rows with a null id
are kept whole and remove nothing; repeated rows count as the same document and remove nothing from each other; equal windows
of one document do not count as repeated; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm import words
from niaga.llm.common import Members, apart, batch, cut, fields, passed, slices, text_buffer, with_rest

WINDOW = 50
ANCHOR = 12
CHUNK = ["h", "s"]


def _anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each i, where the smallest of grams[i : i + width] stands, the leftmost of equal ones."""
    at, value, span = np.arange(len(grams)), grams, 1
    while span < width:
        step = min(span, width - span)
        left, right = value[:-step], value[step:]
        take = left <= right
        at, value = np.where(take, at[:-step], at[step:]), np.where(take, left, right)
        span += step
    return at


def _sums(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = words._powers(words._RUN_BASE, max(len(hashed), words.SEGMENT))
    sums = np.zeros(len(hashed) + 1, np.uint64)
    np.cumsum(hashed * up[: len(hashed)], out=sums[1:])
    return sums, down


def _spans(hashed: np.ndarray, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """A hash of the words first to behind - 1 of each span."""
    sums, down = _sums(hashed)
    return words.mix((sums[behind] - sums[first]) * down[first] + (behind - first).astype(np.uint64)).view(np.int64)


def _chunks(hashed: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash) of each chunk; windows are counted from the slice's first word."""
    text, start = words.run_starts(bounds, window)
    if not len(start):
        return text, start, start, np.zeros(0, np.int64)
    grams = words.runs(hashed, ANCHOR)
    at = _anchors(grams, window - ANCHOR + 1)[start]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(start)) - 1
    return text[head], start[head], start[last], grams[at[head]].view(np.int64)


def chunks(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, row, h, s, place): the chunks of each text; place is 64 * its first window + the number of further ones."""
    kinds = [("doc_id", pa.int64()), ("row", pa.int64()), ("h", pa.int64()), ("s", pa.int64()), ("place", pa.int64())]
    schema = pa.schema(kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_buffer(part.column("text"))
            found = words.split(data, offsets)
            hashed = words.hashes(data, found)
            text, first, last, anchor = _chunks(hashed, found.bounds, window)
            place = 64 * (first - found.bounds[text]) + (last - first)
            own = [part.column(c).to_numpy()[text] for c in ("doc_id", "row")]
            yield batch(schema, *own, anchor, _spans(hashed, first, last + window), place)

    return rows.filter("doc_id is not null").mapInArrow(work, "doc_id long, row long, h long, s long, place long")


def _window_hashes(sources: DataFrame, window: int) -> DataFrame:
    """(doc_id, row, h, first, windows): every window of the listed chunks, read again from the texts that hold them."""
    kinds = [("doc_id", pa.int64()), ("row", pa.int64()), ("h", pa.int64()), ("first", pa.int32()), ("windows", pa.list_(pa.int64()))]
    schema = pa.schema(kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_buffer(part.column("text"))
            found = words.split(data, offsets)
            hashed = words.hashes(data, found)
            listed = part.column("chunks")
            text = np.repeat(np.arange(part.num_rows), [len(c) for c in listed])
            flat = listed.flatten()
            h, place = flat.field("h").to_numpy(), flat.field("place").to_numpy()
            first, n = place // 64, place % 64 + 1
            ends = np.cumsum(n)
            at = np.arange(n.sum()) - np.repeat(ends - n, n)
            start = np.repeat(found.bounds[text] + first, n) + at
            made = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(_spans(hashed, start, start + window)))
            own = [part.column(c).to_numpy()[text] for c in ("doc_id", "row")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, own), pa.array(h), pa.array(first, pa.int32()), made], schema=schema)

    return sources.mapInArrow(work, "doc_id long, row long, h long, first int, windows array<long>")


def _only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose (doc_id, row) ``wanted`` may hold, chosen before any shuffle of texts."""
    members = Members(wanted.select(F.xxhash64("doc_id", "row").alias("key")), "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield part.filter(pa.array(members.holds(part.column("key").to_numpy()))).drop_columns(["key"])

    return rows.withColumn("key", F.xxhash64("doc_id", "row")).mapInArrow(work, rows.schema)


def repeated_spans(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, row, spans): the word spans (first, behind) of each text that an earlier document holds too."""
    every = chunks(rows, window)
    anchors = every.groupBy("h").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("least"), (F.min("s") == F.max("s")).alias("straight")
    )
    shared = every.join(apart(anchors.filter("n > 1").drop("n"), "h"), "h").filter("not straight or least < doc_id")
    shared = cut(shared.select("doc_id", "row", "place", F.when(~F.col("straight"), F.col("h")).alias("h"), F.when(~F.col("straight"), F.col("s")).alias("s")))
    straight = shared.filter("h is null")

    branching = shared.filter("h is not null")
    kinds = branching.groupBy(*CHUNK).agg(F.min(F.struct("doc_id", "row", "place")).alias("source"), F.count("*").alias("n"))
    kinds = cut(kinds.select(*CHUNK, "source.*", "n"))
    several = cut(branching.join(apart(kinds.filter("n > 1").select(*CHUNK, F.col("doc_id").alias("least")), "s"), CHUNK))
    later = several.filter("least < doc_id")
    first_ones = kinds.filter("n = 1").unionByName(several.filter("least = doc_id"), allowMissingColumns=True)
    whole = straight.select("doc_id", "row", "place").unionByName(later.select("doc_id", "row", "place"))
    first = F.floor(F.col("place") / 64).cast("int")
    whole = whole.select("doc_id", "row", first.alias("first"), (first + F.col("place") % 64 + window).cast("int").alias("behind"))

    by_text = first_ones.groupBy("doc_id", "row").agg(F.collect_list(F.struct("h", "place")).alias("chunks"))
    by_text = cut(by_text)
    # a repeated row of one id gives the same windows twice, which no minimum minds
    read = cut(_window_hashes(_only(rows, by_text).join(by_text, ["doc_id", "row"]), window))
    single = read.select("doc_id", "row", "h", "first", F.posexplode("windows").alias("at", "w"))
    least = single.groupBy("h", "w").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    earlier = single.join(apart(least.drop("most"), "w"), ["h", "w"]).filter("least < doc_id")
    begin = F.col("first") + F.col("at")
    earlier = earlier.select("doc_id", "row", begin.alias("first"), (begin + window).alias("behind"))
    return whole.unionByName(earlier).groupBy("doc_id", "row").agg(F.collect_set(F.struct("first", "behind")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, carry: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, changed): kept holds the words that are left, joined by one space; changed is the text
    with its layout where nothing was removed, else kept. Each row of the input gives one row, with carry also all its columns
    as the struct ``rest``."""
    rows = with_rest(docs) if carry else with_rest(docs).drop("rest")
    spans = cut(repeated_spans(rows.select("doc_id", "text", "row"), window))
    kinds = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("changed", pa.string())]
    schema = pa.schema(kinds)
    members = Members(spans.select(F.xxhash64("doc_id", "row").alias("key")), "key")
    made = fields(rows, "doc_id long, n_words long, n_removed long, kept string, changed string")

    def removed(part: pa.RecordBatch, listed: list) -> pa.RecordBatch:
        total, gone, kept, changed = [], [], [], []
        for text, found in zip(part.column("text").to_pylist(), listed, strict=True):
            own = text.encode().split()  # on the same six bytes
            n = len(own)
            if found:
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, [s["first"] for s in found], 1)
                np.add.at(edge, [s["behind"] for s in found], -1)
                own = [own[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
            total.append(n)
            gone.append(n - len(own))
            kept.append(b" ".join(own).decode())
            changed.append(kept[-1] if gone[-1] else text)
        return passed(part, batch(schema, part.column("doc_id"), total, gone, kept, changed))

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rest = part.filter(pa.array(~members.holds(part.column("key").to_numpy())))
            yield removed(rest, [None] * rest.num_rows)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield removed(part, part.column("spans").to_pylist())

    keyed = rows.withColumn("key", F.xxhash64("doc_id", "row"))
    marked = _only(rows, spans).join(spans, ["doc_id", "row"], "left")
    return keyed.mapInArrow(untouched, made).unionByName(marked.mapInArrow(touched, made))
