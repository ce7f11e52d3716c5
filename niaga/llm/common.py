"""Helpers that all operators share: inputs, cut lineage, Arrow batches, state kept by a worker."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from niaga.session import shared_root

SLICE_BYTES = 1 << 20  # text handled at once inside a task
BATCH_BYTES = 8 << 20  # of an Arrow batch; a longer text comes alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text), a null text as the empty one. All other columns are left out, whatever their names.

    Arrow batches of the session are held to BATCH_BYTES, so that texts cross to Python in bounded portions.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def with_rest(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row, rest): as ``texts``, with the text's hash and all columns of the input as one struct."""
    texts(docs)  # bounds the Arrow batches
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"), whole.alias("rest"))


def restored(out: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` from ``rest``, with a changed text and its length."""
    new = F.col(text)
    changed = new != F.coalesce(F.col("rest.text").cast("string"), F.lit(""))
    replaced = {"text": new, "n_chars": F.length(new)}
    columns = [F.col(f"rest.`{c}`") for c in docs.columns]
    columns = [
        F.when(changed, replaced[c].cast(docs.schema[c].dataType)).otherwise(column) if c in replaced else column
        for c, column in zip(docs.columns, columns, strict=True)
    ]
    return out.select(*[column.alias(c) for c, column in zip(docs.columns, columns, strict=True)])


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the rows that no model learns from. A row without an id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there, in the same partitions."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def apart(df: DataFrame, column: str) -> DataFrame:
    """The same rows, with an integer column made anew, so that Spark shuffles them for a join on it.

    An aggregate lies already where its join would need it, and then both run in one stage, in which the skew join cannot
    split a hot key of the other side. This shuffles the (much smaller) aggregate once more and lets it.
    """
    return df.withColumn(column, F.bitwise_not(F.bitwise_not(column)))


def kept(name: str, make: Callable):
    """What a worker process makes once and keeps between its tasks (a tokenizer, a table of powers)."""
    store = sys.__dict__.setdefault("_niaga_kept", {})
    if name not in store:
        store[name] = make()
    return store[name]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut to some megabytes of text; a longer text comes alone."""
    for batch in batches:
        ends = np.cumsum(np.diff(text_buffer(batch.column(column))[1]))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and the n + 1 offsets into them."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def passed(part: pa.RecordBatch, made: pa.RecordBatch) -> pa.RecordBatch:
    """The made columns, and the input's ``rest`` behind them if it has one."""
    return made.append_column("rest", part.column("rest")) if "rest" in part.schema.names else made


def fields(rows: DataFrame, made: str) -> T.StructType:
    """The schema of ``passed`` batches."""
    schema = T.StructType.fromDDL(made)
    return schema.add("rest", rows.schema["rest"].dataType) if "rest" in rows.columns else schema


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Members:
    """A Bloom filter of 64-bit keys, of one size at any number of keys: it may keep more than its keys, never less."""

    BITS = 26  # 8 MB

    def __init__(self, keys: DataFrame, column: str):
        mask = (1 << self.BITS) - 1
        places = F.array(F.col(column).bitwiseAND(mask), F.shiftright(column, 64 - self.BITS).bitwiseAND(mask))
        bits = keys.select(F.explode(places).alias("p")).select(
            F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit")
        )
        words = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.words = np.zeros(1 << self.BITS - 6, np.int64)
        self.words[words.column("word").to_numpy()] = words.column("bits").to_numpy()

    def __getstate__(self) -> bytes:
        """Sent to the tasks compressed: while few bits are set, a small part of its size."""
        return zlib.compress(self.words.tobytes(), 1)

    def __setstate__(self, state: bytes) -> None:
        self.words = np.frombuffer(zlib.decompress(state), np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mask = np.int64((1 << self.BITS) - 1)
        out = np.ones(len(keys), bool)
        for place in (keys & mask, (keys >> np.int64(64 - self.BITS)) & mask):
            out &= (self.words[place >> 6] >> (place & 63)) & 1 == 1
        return out


def without(docs: DataFrame, rejected: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text hash) is not in ``rejected``; of those in ``repeated`` one row each.

    Rows that a fixed-size filter clears stay where they are. Only the others are shuffled for the exact test.
    """
    rows = with_rest(docs).select("doc_id", "row", "rest").withColumn("key", F.xxhash64("doc_id", "row"))
    listed = rejected.select("doc_id", "row")
    if repeated is not None:
        listed = listed.unionByName(repeated.select("doc_id", "row"))
    members = Members(listed.select(F.xxhash64("doc_id", "row").alias("key")), "key")

    def chosen(inside: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                yield part.filter(pa.array(members.holds(part.column("key").to_numpy()) == inside))

        return rows.mapInArrow(work, rows.schema)

    match = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row"] == b["row"])
    doubt = chosen(True)
    listed = rejected.select("doc_id", "row").distinct()
    doubt = doubt.join(listed, match(doubt, listed), "left_anti")
    if repeated is not None:
        again = repeated.select("doc_id", "row").distinct()
        once = doubt.join(again, match(doubt, again), "left_semi").dropDuplicates(["doc_id", "row"])
        doubt = doubt.join(again, match(doubt, again), "left_anti").unionByName(once)
    return chosen(False).unionByName(doubt).select("rest.*")
