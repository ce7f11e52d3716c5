"""Nearest vectors by multi-index hashing (operator 8).

A rotation is learned on a bounded sample (principal directions, then iterative quantisation); the signs of a rotated vector are
its binary code of 64 bits, cut into four substrings of sixteen, each with an index of its own. A code within Hamming distance r of
the query has, by the pigeonhole principle, a substring within floor(r / 4): probing all values that near retrieves every code
within the radius. The found vectors are reranked by their cosine in double precision. The radius grows until a vector nearer than
the k-th one found would lie outside it with a chance of at most ``MISS``: the bits in which two vectors differ are taken as
independent, each with the chance angle / pi, and what true neighbours within the sample need beyond that is added.

Equal vectors are one entry with their smallest ids (a query needs no more than k of them), and queries of equal vectors are asked once.
Each index is dealt to tasks by the first bits of its substring, so that a part has a bounded number of rows; a part that holds more
(a dense group) is cut by a hash. A row is sent once to each of the four indexes, and a query only to the parts whose first bits are within
its probing distance. In a task the part's rows come first and are kept, sorted by their substring; then its queries stream by, however many
they are. A row that several substrings retrieve counts in the first of them, so a round gives no row twice. Each round sends the
queries that are not done yet, with the distances that they still have to probe.

Results for odd rows: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null vec_id, take
no part; vectors are searched among those of their own length; rows that repeat an id and its vector are one row, and a row is no
candidate for a query of its own id; ties go to the smaller vec_id; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from niaga.llm.common import BATCH_BYTES, batch, cut
from niaga.llm.vectors import matrix, unit, usable, vectors

BITS = 64
SUB = 16  # bits of a substring
TABLES = BITS // SUB
SAMPLE = 20_000  # the most vectors that the rotation is learned on
MISS = 0.03
PART = 8192  # rows of an index that meet queries in one task
PREFIX = 14  # the most first bits by which an index is dealt
_ONES = np.array([bin(i).count("1") for i in range(1 << SUB)], np.uint8)


class Learned(NamedTuple):
    rotation: np.ndarray  # (dimensions, BITS)
    slack: int  # bits that true neighbours need beyond the radius of their cosine
    first: int  # the probing distance to begin with


def learned_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 30) -> np.ndarray:
    """(dimensions, bits): principal directions turned so that signs lose little (iterative quantisation).

    Bits beyond the dimensions are random directions.
    """
    random = np.random.default_rng(8)
    d = sample.shape[1]
    x = unit(sample)
    _, directions = np.linalg.eigh(x.T @ x)
    main = directions[:, ::-1][:, : min(bits, d)]
    turn = np.linalg.qr(random.normal(size=(main.shape[1],) * 2))[0]
    y = x @ main
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(y @ turn).T @ y)
        turn = (left @ right).T
    # spread the strong directions over the substrings
    turned = np.column_stack([main @ turn, random.normal(size=(d, bits - main.shape[1]))])
    return turned[:, random.permutation(bits)]


def learned(sample: np.ndarray, k: int = 5, queries: int = 200) -> Learned:
    """The rotation; the bits by which 99 in 100 true neighbours of sampled vectors stay within ``radius`` of the k-th one's
    cosine; and the probing distance that a tenth of them needs."""
    rotation = learned_rotation(sample)
    x, made = unit(sample), codes(sample, rotation)
    beyond, needed = [], []
    for i in range(0, len(x), max(1, len(x) // queries)):
        cosines = x @ x[i]
        cosines[i] = -2
        near = np.argsort(-cosines)[:k]
        reach = radius(float(cosines[near[-1]]))
        beyond += (distances(made[near], made[i]) - reach).tolist()
        needed.append(reach)
    slack = max(0, math.ceil(np.quantile(beyond, 0.99)))
    return Learned(rotation, slack, min(SUB, (int(np.quantile(needed, 0.1)) + slack) // TABLES))


def models(rows: DataFrame, k: int, bound: int = SAMPLE) -> dict[int, Learned]:
    """What is learned for each vector length from a bounded sample; nothing for a length with few vectors."""
    drawn = rows.select("d", "v").orderBy(F.xxhash64("v"), "v").limit(bound).toArrow()
    sizes, out = np.asarray(drawn.column("d")), {}
    for d in np.unique(sizes).tolist():
        own = drawn.column("v").take(pa.array(np.flatnonzero(sizes == d)))
        if len(own) >= 2 * BITS:
            out[d] = learned(matrix(own), k)
    return out


def model_of(found: dict[int, Learned], d: int) -> Learned:
    return found[d] if d in found else Learned(np.random.default_rng(d).normal(size=(d, BITS)), 4, 2)


def codes(v: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """(rows, TABLES) substrings of the binary codes."""
    return np.packbits(unit(v) @ rotation > 0, axis=1).view(">u2").astype(np.uint16)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of codes."""
    return _ONES[a ^ b].astype(np.int64).sum(axis=-1)


def radius(cosine: float, bits: int = BITS, miss: float = MISS) -> int:
    """The least r that a vector of this cosine exceeds in Hamming distance with a chance of at most ``miss``."""
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    total = 0.0
    for r in range(bits + 1):
        total += math.comb(bits, r) * p**r * (1 - p) ** (bits - r)
        if total >= 1 - miss:
            return r
    return bits


_RADII = np.array([radius(i / 1000 - 1) for i in range(2001)])  # of the cosine rounded down: never too small


class Part:
    """A part of one index: its rows sorted by their substring."""

    def __init__(self, table: int, code: np.ndarray, v: np.ndarray, ids: list[np.ndarray]):
        order = np.argsort(code[:, table], kind="stable")
        self.table, self.codes, self.v = table, code[order], v[order]
        self.norm = np.sqrt((self.v * self.v).sum(axis=1))
        self.near = (self.v / self.norm[:, None]).astype(np.float32)  # for a first ranking
        self.ids = [ids[i] for i in order]
        self.values, self.starts = np.unique(self.codes[:, table], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))

    def probe(self, code: np.ndarray, low: int, high: int) -> np.ndarray:
        """Rows whose nearest substring is at a distance of ``low`` to ``high`` of the query's, and that this index is the
        first one to retrieve."""
        apart = _ONES[self.values ^ code[self.table]]
        hit = np.flatnonzero((apart >= low) & (apart <= high))
        sizes = self.ends[hit] - self.starts[hit]
        rows = np.arange(sizes.sum()) + np.repeat(self.starts[hit] - np.cumsum(sizes) + sizes, sizes)
        each = _ONES[self.codes[rows] ^ code]
        return rows[(each.min(axis=1) >= low) & ((each <= high).argmax(axis=1) == self.table)] if len(rows) else rows

    def best(self, rows: np.ndarray, q: np.ndarray, k: int) -> tuple[list[int], list[float]]:
        """(ids, cosines) of the k nearest, nearest first, ties by the smaller id."""
        norm = math.sqrt(float(q @ q))
        if len(rows) > 4 * k:
            rough = self.near[rows] @ (q / norm).astype(np.float32)
            rows = rows[rough >= np.partition(rough, -k)[-k] - 1e-4]  # far more than single precision may err
        scores = (self.v[rows] * q).sum(axis=1) / (self.norm[rows] * norm)
        found = sorted((-s, i) for r, s in zip(rows, scores.tolist(), strict=True) for i in self.ids[r])[:k]
        return [i for _, i in found], [-s for s, _ in found]


def _coded(rows: DataFrame, found: dict[int, Learned], more: str) -> DataFrame:
    """The rows with their codes as four numbers; ``more`` names the other columns."""
    names = [c.split()[0] for c in more.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sizes = np.asarray(part.column("d"))
            made = np.zeros((part.num_rows, TABLES), np.int32)
            for d in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == d)
                made[own] = codes(matrix(part.column("v").take(pa.array(own))), model_of(found, d).rotation)
            code = pa.array(list(made), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), code], [*names, "code"])

    return rows.select(*names).mapInArrow(work, f"{more}, code array<int>")


_GROUP = ["d", "t", "prefix", "salt"]


def _searched(placed: DataFrame, k: int) -> DataFrame:
    """(q, vec_id, score): the k best that each query finds in each part. ``placed`` holds rows (asks false) and queries."""
    schema = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, part = None, [], None
        for whole in batches:
            group = np.column_stack([np.asarray(whole.column(c)) for c in [*_GROUP, "asks"]])
            edges = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist(), len(group)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                own, asks = tuple(group[a, :-1].tolist()), bool(group[a, -1])
                if own != key:
                    key, held, part = own, [], None
                piece = whole.slice(a, b - a)
                if not asks:
                    held.append(piece)
                    continue
                if not held:
                    continue  # a part without rows
                if part is None:
                    t = pa.Table.from_batches(held).combine_chunks()
                    ids = [np.array(i) for i in t.column("ids").to_pylist()]
                    part = Part(key[1], matrix(t.column("code")).astype(np.uint16), matrix(t.column("v")), ids)
                q, code = matrix(piece.column("v")), matrix(piece.column("code")).astype(np.uint16)
                out: list[list] = [[], [], []]
                for i, (asked, low, high) in enumerate(zip(*(piece.column(c).to_pylist() for c in ("q", "low", "high")), strict=True)):
                    ids, scores = part.best(part.probe(code[i], low, high), q[i], k)
                    out[0] += [asked] * len(ids)
                    out[1] += ids
                    out[2] += scores
                yield batch(schema, *out)

    return placed.mapInArrow(work, "q long, vec_id long, score double")


def _next(state: DataFrame, best: DataFrame, found: dict[int, Learned], k: int, step: int) -> DataFrame:
    """The queries that are not done, with the distances to probe next: as far as the k-th one asks, in growing steps."""
    kinds = "q long, d int, v array<double>, code array<int>, low int, high int"
    last = best.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    rows = state.join(last, "q", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            d, high, n, least = (part.column(c).to_numpy(zero_copy_only=False) for c in ("d", "high", "n", "least"))
            slack = np.array([model_of(found, int(x)).slack for x in d], np.int64)
            place = np.clip(np.nan_to_num((least.astype(float) + 1) * 1000, nan=0), 0, 2000).astype(np.int64)
            full = np.nan_to_num(n.astype(float), nan=0) >= k
            wanted = np.where(full, -(-(_RADII[place] + slack + 1) // TABLES) - 1, SUB)
            wanted = np.minimum(np.minimum(wanted, SUB), high + step).astype(np.int32)
            going = pa.array((high < SUB) & (wanted > high))
            own = [part.column(c) for c in ("q", "d", "v", "code")]
            columns = [*own, pa.array(high.astype(np.int32) + 1), pa.array(wanted)]
            yield pa.RecordBatch.from_arrays([c.filter(going) for c in columns], [c.split()[0] for c in kinds.split(", ")])

    return rows.mapInArrow(work, kinds)


def nearest(table: DataFrame, queries: Column | None = None, k: int = 5, part: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row. queries: which rows ask, over vec_id."""
    session = table.sparkSession
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = vectors(table).filter(usable(F.col("v")) & F.col("vec_id").isNotNull()).withColumn("d", F.size("v"))
    rows = rows.dropDuplicates(["vec_id", "v"])
    own = F.row_number().over(Window.partitionBy("d", "v").orderBy("vec_id"))
    entries = rows.withColumn("n", own).filter(F.col("n") <= k + 1).groupBy("d", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = cut(entries)
    found = models(entries, k)
    asking = queries if queries is not None else F.col("vec_id") % 50 == 0
    asked = vectors(table).filter(asking & usable(F.col("v")) & F.col("vec_id").isNotNull()).withColumn("d", F.size("v")).distinct()
    asked = asked.withColumn("h", F.xxhash64("v"))
    state = cut(asked.select("d", "v").distinct()).withColumn("q", F.monotonically_increasing_id())
    first = F.lit(2)
    for d, model in found.items():
        first = F.when(F.col("d") == d, F.lit(model.first)).otherwise(first)
    state = _coded(state, found, "q long, d int, v array<double>").withColumn("low", F.lit(0)).withColumn("high", first)
    state = begun = cut(state)

    coded = cut(_coded(entries, found, "d int, v array<double>, ids array<long>"))
    size = part or PART
    bits = F.least(F.lit(PREFIX), F.ceil(F.log2(F.greatest(F.count("*") / size, F.lit(1)))).cast("int"))
    lengths = coded.groupBy("d").agg(bits.alias("bits"))  # a row for each length of vector
    tables = F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1)))
    index = coded.join(F.broadcast(lengths), "d").withColumn("t", tables).withColumn("prefix", F.expr(f"shiftright(code[t], {SUB} - bits)"))
    parts = index.groupBy("d", "t", "prefix").agg(F.ceil(F.count("*") / size).cast("int").alias("salts"))
    parts = cut(parts)  # at most 2^PREFIX for each index
    salt = F.pmod(F.xxhash64("v"), F.col("salts")).cast("int").alias("salt")
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("q", "long"), ("low", "int"), ("high", "int"))]
    index = index.join(parts, ["d", "t", "prefix"]).select("d", "t", "prefix", salt, F.lit(False).alias("asks"), "v", "code", "ids", *none)

    best, step = None, 2
    while not state.isEmpty():
        masks = F.filter(F.expr("sequence(0, shiftleft(1, bits) - 1)"), lambda x: F.bit_count(x) <= F.col("high"))
        sent = state.join(F.broadcast(lengths), "d").withColumn("t", tables).withColumn("mask", F.explode(masks))
        sent = sent.withColumn("prefix", F.expr(f"shiftright(code[t], {SUB} - bits) ^ mask")).join(parts, ["d", "t", "prefix"])
        sent = sent.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).select(
            *_GROUP, F.lit(True).alias("asks"), "v", "code", F.lit(None).cast("array<long>").alias("ids"), "q", "low", "high"
        )
        placed = index.unionByName(sent).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "asks")
        new = _searched(placed, k + 1)
        every = new if best is None else best.unionByName(new)
        ranked = every.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")))
        best = cut(ranked.filter(F.col("n") <= k + 1).drop("n"))
        state = cut(_next(state, best, found, k + 1, step))
        step *= 2

    if best is None:
        return session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # from vectors back to the rows that ask, without their own id
    named = begun.select("q", "v", F.xxhash64("v").alias("h"))
    rows = asked.select(F.col("vec_id").alias("query_id"), "v", "h").join(named, ["h", "v"]).select("query_id", "q")
    pairs = rows.join(best, "q").filter(F.col("vec_id") != F.col("query_id")).select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
