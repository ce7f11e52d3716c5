"""Near-duplicate vectors by a pivot-permutation index (operator 3).

Reference points are spread out: of a bounded sample of the vectors, one is taken if its cosine to every one taken before is below
``SPREAD``, so a dense group holds few of them, whatever its share of the rows. A vector is described by its nearest reference points in
order (the head of its permutation) and stands in the inverted lists of these pivots. Two vectors of a label are compared if they
share at least ``SHARED`` pivots; the pair belongs to the list of the first shared pivot alone, so it is verified and counted once.
By that order only the first ``near - SHARED + 1`` pivots need lists. Long lists are cut into blocks, and pairs of blocks are
tasks of bounded size. Inside one, shared pivots are counted, candidates verified by their cosine in double precision, and only
link counts and one edge to the block's root leave it, never the pairs. Equal vectors are one class with its number of copies.

Dense groups are exact. A pivot that turned down a ``DENSE`` part of the sample has a ball: a vector at cosine ``SPREAD`` or more to it
is at home there (in the nearest of them) and is in no other kind of list. By the triangle inequality of angles everything that
links with it lies within the angles of ``SPREAD`` and the threshold together, and all these vectors are listed too. In the list of
a ball each pair of which one side is at home is compared; if both sides have homes, in the list of the smaller one alone. A vector
can reach at most 1 / DENSE balls.

The number of pivots grows with the square root of the rows up to MOST, and the head with it. At cosine 0.93 a pair shares three
of the 12 nearest of 256 pivots in more than 99.9 % of cases (measured on the test vectors; ``tests/llm`` checks it).

Results for odd rows: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, have no
links and are their own component; vectors of different lengths are not compared; a null vec_id is linked like any other row but
names no component, and is kept only where no row of its component has an id; repeated rows link with each other and each is
returned; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm import graph
from niaga.llm.common import apart, batch, cut
from niaga.llm.vectors import matrix, unit, usable, vectors

THRESHOLD = 0.93
LEAST, MOST = 256, 4096  # reference points
SHARED = 3  # pivots that a pair must share
SAMPLE = 4  # vectors looked at for one reference point
SPREAD = 0.8  # cosine that two reference points stay below
DENSE = 1 / 64  # part of the sample near one reference point that makes a ball of it
BLOCK = 1024  # members of a list in one block


def spread(sample: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(points, turned down): at most ``most`` vectors of the sample, in its order, that lie apart, and how many others are near each."""
    sample = unit(sample)
    points, near, n = np.empty((most, sample.shape[1])), np.zeros(most, np.int64), 0
    for at in range(0, len(sample), 256):
        part = sample[at : at + 256]
        known = n
        before = part @ points[:known].T
        among = part @ part.T
        taken: list[int] = []
        for i in range(len(part)):
            cosines = np.concatenate([before[i], among[i, taken]])
            if len(cosines) and cosines.max() >= SPREAD:
                near[int(cosines.argmax())] += 1
            elif n < most:
                points[n] = part[i]
                taken.append(i)
                n += 1
    return points[:n], near[:n]


def reference_points(rows: DataFrame, count: int) -> dict[int, tuple[np.ndarray, int]]:
    """About the square root of ``count`` spread-out rows of a sample by the order of their hash; bounded by MOST. Per vector length,
    with the number of balls, whose pivots come first."""
    n = LEAST
    while n < MOST and n * n < count:
        n *= 2
    ordered = rows.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE * n)
    sample = ordered.withColumn("d", F.size("v")).toArrow()
    sizes = sample.column("d").to_numpy()
    out = {}
    for d in np.unique(sizes):
        points, near = spread(matrix(sample.filter(pa.array(sizes == d)).column("v")), n)
        order = np.argsort(-near, kind="stable")
        out[int(d)] = points[order], int((near >= max(1, DENSE * len(sizes))).sum())
    return out


def _points(points: dict[int, tuple[np.ndarray, int]], d: int) -> tuple[np.ndarray, int]:
    """Of one length. Few of them are filled up by random directions."""
    own, balls = points.get(d, (np.zeros((0, d)), 0))
    if len(own) < LEAST // 4:
        own = np.concatenate([own, unit(np.random.default_rng(d).normal(size=(LEAST - len(own), d)))])
    return own, balls


def balls_of(v: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """(home, reach): the ball that each vector is at home in, or -1, and all balls that may hold a vector linked with it."""
    if not len(centres):
        return np.full(len(v), -1, np.int32), [np.zeros(0, np.int32)] * len(v)
    cosines = unit(v) @ centres.T
    home = np.where(cosines.max(axis=1) >= SPREAD, cosines.argmax(axis=1), -1).astype(np.int32)
    wide = np.cos(min(np.pi, np.arccos(SPREAD) + np.arccos(threshold))) - 1e-6
    return home, [np.flatnonzero(row).astype(np.int32) for row in cosines >= wide]


def heads(v: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The nearest pivots of each vector, nearest first. Equal distances: the smaller pivot."""
    near = min(len(points), 12 + 2 * max(0, int(np.log2(len(points))) - 8))
    return np.argsort(-(unit(v) @ points.T), axis=1, kind="stable")[:, :near].astype(np.int32)


def described(rows: DataFrame, points: dict[int, tuple[np.ndarray, int]], threshold: float) -> DataFrame:
    """(c, label, copies, v, head, home, reach): each class with its head of the permutation and its balls."""
    kinds = [("c", pa.int64()), ("label", pa.string()), ("copies", pa.int64()), ("v", pa.list_(pa.float64())), ("head", pa.list_(pa.int32()))]
    schema = pa.schema([*kinds, ("home", pa.int32()), ("reach", pa.list_(pa.int32()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sizes = np.array([len(v) for v in part.column("v")])
            for d in np.unique(sizes):
                p = part.filter(pa.array(sizes == d))
                v = matrix(p.column("v"))
                own, balls = _points(points, int(d))
                home, reach = balls_of(v, own[:balls], threshold)
                yield batch(schema, p.column("c"), p.column("label"), p.column("copies"), p.column("v"), list(heads(v, own)), home, reach)

    return rows.mapInArrow(work, "c long, label string, copies long, v array<double>, head array<int>, home int, reach array<int>")


def _shared(x: dict, y: dict, pivot: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that share enough pivots, the first of them this one."""
    top = int(max(x["head"].max(), y["head"].max())) + 1
    holds = []
    for side in (x, y):
        m = np.zeros((len(side["head"]), top), np.float32)
        m[np.arange(len(m))[:, None], side["head"]] = 1
        holds.append(m)
    shared = (holds[0] @ holds[1].T) >= min(SHARED, x["head"].shape[1])
    if same:
        shared = np.triu(shared, 1)
    i, j = np.nonzero(shared)
    owned = np.zeros(len(i), bool)
    for at in range(0, len(i), 50_000):  # the first pivot that both share
        a, b = holds[0][i[at : at + 50_000]], holds[1][j[at : at + 50_000]]
        owned[at : at + 50_000] = (a * b).argmax(axis=1) == pivot
    return i[owned], j[owned]


def _at_home(x: dict, y: dict, ball: int, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs near the threshold and above whose smaller home is this ball."""
    close = (x["v"] / x["norm"][:, None]) @ (y["v"] / y["norm"][:, None]).T >= threshold - 1e-6
    none = np.iinfo(np.int32).max
    a, b = (np.where(side["home"] < 0, none, side["home"]) for side in (x, y))
    close &= np.minimum(a[:, None], b[None, :]) == ball
    return np.nonzero(np.triu(close, 1) if same else close)


def block_links(x: dict, y: dict, pivot: int, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of x, j of y) that this list owns and whose cosine reaches the threshold. Balls are -1, -2, ..."""
    i, j = _shared(x, y, pivot, same) if pivot >= 0 else _at_home(x, y, -1 - pivot, same, threshold)
    near = np.zeros(len(i), bool)
    for at in range(0, len(i), 100_000):
        a, b = x["v"][i[at : at + 100_000]], y["v"][j[at : at + 100_000]]
        near[at : at + 100_000] = (a * b).sum(axis=1) / (x["norm"][i[at : at + 100_000]] * y["norm"][j[at : at + 100_000]]) >= threshold
    return i[near], j[near]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index reachable from each of n by the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked(classes: DataFrame, points: dict[int, tuple[np.ndarray, int]], threshold: float = THRESHOLD) -> DataFrame:
    """(c, links, root): for each class and block, the copies of other classes linked there, and a class of its block that it
    reaches."""
    rows = cut(described(classes, points, threshold)).withColumn("d", F.size("v"))
    own = F.slice(F.array_sort("head"), F.lit(1), F.greatest(F.size("head") - (SHARED - 1), F.lit(1)))
    own = F.concat(F.when(F.col("home") < 0, own).otherwise(F.array().cast("array<int>")), F.transform("reach", lambda ball: -1 - ball))
    posted = rows.select("label", "d", F.explode(own).alias("pivot"), "c", "copies", "v", "head", "home")
    keys = ["label", "d", "pivot"]
    blocks = rows.select("label", "d", F.explode(own).alias("pivot")).groupBy(keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = posted.join(apart(blocks, "pivot"), keys).withColumn("block", F.pmod(F.xxhash64("c"), "blocks").cast("int"))
    # each block meets itself and every other block of its list
    meets = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meets = meets.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    schema = pa.schema([("c", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def side(t: pa.Table) -> dict:
        v = matrix(t.column("v"))
        return {"v": v, "norm": np.sqrt((v * v).sum(axis=1)), "head": matrix(t.column("head")), "home": t.column("home").to_numpy(), "c": t.column("c").to_numpy(), "copies": t.column("copies").to_numpy()}

    def work(key: tuple, t: pa.Table) -> pa.Table:
        pivot, low, high = (key[k].as_py() for k in (2, 3, 4))
        block = t.column("block").to_numpy()
        if low != high and (block == block[0]).all() or t.num_rows < 2:
            return schema.empty_table()
        x = side(t.filter(pa.array(block == low)))
        y = x if low == high else side(t.filter(pa.array(block == high)))
        i, j = block_links(x, y, pivot, low == high, threshold)
        if not len(i):
            return schema.empty_table()
        shift = 0 if low == high else len(x["c"])
        c = x["c"] if low == high else np.concatenate([x["c"], y["c"]])
        n = np.bincount(i, y["copies"][j], len(c)) + np.bincount(j + shift, x["copies"][i], len(c))
        root = _roots(len(c), i, j + shift)
        at = np.flatnonzero(n)
        return pa.Table.from_batches([batch(schema, c[at], n[at].astype(np.int64), c[root[at]])])

    return meets.drop("blocks", "other").groupBy(*keys, "low", "high").applyInArrow(work, "c long, links long, root long")


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    able = usable(F.col("v")) & F.col("label").isNotNull()
    rows = cut(vectors(table, label_col="label").withColumn("c", F.when(able, F.xxhash64("label", "v"))))
    grouped = rows.filter("c is not null").groupBy("c")
    first = [F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("first")]
    classes = cut(grouped.agg(F.count("*").alias("copies"), *first))
    points = reference_points(classes, classes.count())
    found = cut(linked(classes.select("c", "label", "copies", "v"), points, threshold))
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    roots = graph.components(found.select(F.col("c").alias("a"), F.col("root").alias("b")))
    named = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    named = apart(named, "root")  # dealt by the root anew, so that the rows of a large component can be split
    named = named.join(apart(named.groupBy("root").agg(F.min("first").alias("named")), "root"), "root").join(links, "c", "left")
    named = named.select("c", "named", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    component = F.when(F.col("c").isNull(), F.col("vec_id")).otherwise(F.col("named"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    out = rows.drop("v").join(named, "c", "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id")).withColumn("kept", kept)
