"""Near-duplicate documents by SetSketch registers (operator 5).

The set of a document is its distinct runs of four lower-cased words. Each element is a Poisson process of arrivals at the
registers; a register keeps the exponentially spaced level of its first arrival, ``1 - log_b(time)`` cut to 16 bits, so that
sketches merge by maximum. Arrivals after a time that fits the size of the set are never made: the cost is one draw for an
element and some ten draws for a register, and a sketch with an empty register is made again with more time.

Equal sets become one class first. Bands of registers put classes into buckets. In a bucket each class is compared with one
leader (the class with most copies); the classes that this leaves unlinked are then compared with all members of the bucket that
are not yet connected to them, inside numpy and in blocks of bounded size, so a bucket gives one row for each class and never
its pairs. A pair is estimated by the joint likelihood of its registers and its sizes; what may reach the threshold is confirmed
on full sets made from the texts again. Components follow from the confirmed links.

A pair at similarity 0.8 shares no band with probability 3e-6; the estimate must fall short by more than five of its standard
deviations to lose a pair.

Results for odd rows: a null, empty or blank text has an empty set, is linked with nothing and is kept; a null id is linked like
any other row but never names a component, and is kept only if no row of its component has an id; repeated rows are one class, each
row is returned, and all rows of the smallest id are kept; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm import graph, words
from niaga.llm.common import Members, apart, batch, cut, slices, text_buffer, texts

SHINGLE = 4
SIMILARITY = 80  # per cent
BANDS, ROWS = 25, 4
REGISTERS = BANDS * ROWS
BASE = 1.001  # ratio of neighbouring levels
RATE = 20.0  # arrivals of an element at a register in a unit of time
LEVELS = 65534
MARGIN = 0.2  # five standard deviations of the estimate at the threshold
NO_ID = lambda c: F.coalesce(F.col(c), F.lit((1 << 63) - 1))  # noqa: E731  a null id, as a key behind all others
LEADERS, MEMBERS = 128, 1024  # unlinked classes and members of a bucket in one block, at most
LEADER_ELEMENTS, MEMBER_ELEMENTS = 1 << 19, 1 << 20  # elements of their sets in one block (about), so that long texts make small blocks


def element_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, elements): the distinct elements of each text, sorted, one text after another."""
    found = words.split(data, offsets)
    hashed = words.hashes(data, found, lower=True)
    text, start = words.run_starts(found.bounds, k)
    elements = words.runs(hashed, k)[start] if len(start) else np.zeros(0, np.uint64)
    counts = np.diff(found.bounds)
    few = np.flatnonzero((counts > 0) & (counts < k))
    whole = [words.runs(hashed[found.bounds[i] : found.bounds[i + 1]], int(counts[i]), salt=int(counts[i]))[0] for i in few]
    text = np.concatenate([text, few])
    elements = np.concatenate([elements, np.array(whole, np.uint64)])
    order = np.lexsort((elements, text))
    text, elements = text[order], elements[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (elements[1:] != elements[:-1])
    text, elements = text[new], elements[new]
    return np.searchsorted(text, np.arange(len(offsets))), elements


def signatures(bounds: np.ndarray, elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal sets have equal ones."""
    out = []
    for salt in (1, 2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words.mix(elements + np.uint64(salt)), dtype=np.uint64)])
        out.append(words.mix(sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def _first_arrivals(bounds: np.ndarray, elements: np.ndarray, time: np.ndarray, m: int) -> np.ndarray:
    """(texts, m): time of the first arrival at each register up to ``time`` of the text, infinite without one."""
    sizes = np.diff(bounds)
    first = np.full(len(sizes) * m, np.inf)
    text = np.repeat(np.arange(len(sizes)), sizes)
    x, limit, at = np.zeros(len(elements)), time[text], 0
    while len(elements):
        at += 1
        draw = words.mix(elements + np.uint64(0x632BE59BD9B4E019 * at & (1 << 64) - 1))
        x = x - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * RATE)
        going = x <= limit
        elements, text, x, limit, draw = elements[going], text[going], x[going], limit[going], draw[going]
        np.minimum.at(first, text * m + (words.mix(draw) % np.uint64(m)).astype(np.int64), x)
    return first.reshape(-1, m)


def sketch(bounds: np.ndarray, elements: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """(texts, m) registers; an empty set has zeros."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), m), np.uint16)
    todo, spare = np.flatnonzero(sizes), 9.0
    while len(todo):
        own = np.concatenate([elements[bounds[i] : bounds[i + 1]] for i in todo])
        own_bounds = np.concatenate([[0], np.cumsum(sizes[todo])])
        first = _first_arrivals(own_bounds, own, spare / (RATE * sizes[todo]), m)
        whole = np.isfinite(first).all(axis=1)
        level = np.floor(1 - np.log(first[whole]) / np.log(BASE))
        out[todo[whole]] = np.clip(level, 0, LEVELS + 1)
        todo, spare = todo[~whole], spare * 2
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def likeliest(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity of each pair of sketches (rows) of sets of known sizes, by joint maximum likelihood on a grid."""
    above, below = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    same = a.shape[-1] - above - below
    u, v = (na / (na + nb))[..., None], (nb / (na + nb))[..., None]
    j = np.linspace(0, 1, 101) * np.minimum(u / v, v / u)
    chance = lambda x: np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)
    up, down = chance(u - v * j), chance(v - u * j)
    even = np.clip(1 - up - down, 1e-12, 1)
    value = above[..., None] * np.log(up) + below[..., None] * np.log(down) + same[..., None] * np.log(even)
    return np.take_along_axis(j, value.argmax(axis=-1)[..., None], -1)[..., 0]


def sketched(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, row, n_shingles, c, registers): text hash, set size, class key and sketch of each document; c is null for an
    empty set."""
    kinds = [("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())]
    schema = pa.schema([*kinds, ("registers", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            bounds, elements = element_sets(*text_buffer(part.column("text")), k)
            registers = sketch(bounds, elements)
            own = [part.column("doc_id"), part.column("row"), np.diff(bounds)]
            yield batch(schema, *own, *signatures(bounds, elements), [r.tobytes() for r in registers])

    rows = texts(docs).withColumn("row", F.xxhash64("text"))
    made = rows.mapInArrow(work, "doc_id long, row long, n_shingles long, s1 long, s2 long, registers binary")
    key = F.when(F.col("n_shingles") > 0, F.xxhash64("n_shingles", "s1", "s2"))
    return made.select("doc_id", "row", "n_shingles", key.alias("c"), "registers")


def _matrix(column: pa.Array) -> np.ndarray:
    data, offsets = text_buffer(column)
    return data.view("<u2").reshape(len(offsets) - 1, -1) if len(data) else np.zeros((0, REGISTERS), np.uint16)


def _bands(classes: DataFrame) -> DataFrame:
    """(band, key, c, copies, n): the buckets of each class; key is the band's registers themselves."""
    schema = pa.schema([("c", pa.int64()), ("copies", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keys = _matrix(part.column("registers")).reshape(part.num_rows, BANDS, ROWS)
            packed = np.ascontiguousarray(keys.astype("<u2")).view("<i8").reshape(part.num_rows, BANDS)
            yield batch(schema, part.column("c"), part.column("copies"), part.column("n"), list(packed))

    made = classes.select("c", "copies", "n", "registers").mapInArrow(work, "c long, copies long, n long, keys array<long>")
    return made.select("c", "copies", "n", F.posexplode("keys").alias("band", "key"))


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes allow the threshold and whose estimate may reach it."""
    side = lambda x: classes.select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(f"100 * least(na, nb) >= {SIMILARITY} * greatest(na, nb)")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, 2000):
                p = part.slice(at, 2000)
                near = likeliest(_matrix(p.column("ra")), _matrix(p.column("rb")), p.column("na").to_numpy(), p.column("nb").to_numpy())
                keep = pa.array(near >= SIMILARITY / 100 - MARGIN)
                yield batch(schema, p.column("a").filter(keep), p.column("b").filter(keep))

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(work, "a long, b long")


def _texts_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(c, text) of each class in ``wanted`` (c): one of its texts, read again; others are not shuffled."""
    sources = cut(wanted.distinct().join(classes.select("c", "source.*"), "c"))
    members = Members(sources.select("row"), "row")
    rows = texts(docs).select(NO_ID("doc_id").alias("id"), F.xxhash64("text").alias("row"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield part.filter(pa.array(members.holds(part.column("row").to_numpy())))

    found = rows.mapInArrow(work, "id long, row long, text string").join(sources, ["id", "row"])
    return cut(found.select("c", "text").dropDuplicates(["c"]))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    held = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("c")), classes, docs)
    both = pairs.join(held.select(F.col("c").alias("b"), F.col("text").alias("tb")), "b")
    both = both.join(held.select(F.col("c").alias("a"), F.col("text").alias("ta")), "a")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(iter([whole]), "tb"):
                (ab, ae), (bb, be) = (element_sets(*text_buffer(part.column(x)), k) for x in ("ta", "tb"))
                linked = []
                for i in range(part.num_rows):
                    x, y = ae[ab[i] : ab[i + 1]], be[bb[i] : bb[i + 1]]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * shared >= SIMILARITY * (len(x) + len(y) - shared))
                linked = pa.array(linked, pa.bool_())
                yield batch(schema, part.column("a").filter(linked), part.column("b").filter(linked))

    return both.select("a", "b", "ta", "tb").mapInArrow(work, "a long, b long")


def _remaining(buckets: DataFrame, classes: DataFrame, roots: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Confirmed links (a, b) between classes of a bucket that are not yet connected.

    The leader's component is the bucket's linked part. Every class outside it is compared with every member of another
    component, blocks of LEADERS such classes against blocks of MEMBERS. A first pass over sketches tells which classes may have
    a partner at all; a second one compares the full sets of these. Pairs stay inside a block: what leaves it is one row for a
    class, and one link from a class to a component.
    """
    root = roots.select(F.col("node").alias("c"), "root")
    with_root = buckets.join(root, "c", "left").withColumn("root", F.coalesce("root", "c"))
    # what a bucket holds, from its components: two small aggregates, then one join whose hot buckets can be split
    parts = with_root.groupBy("band", "key", "root").agg(
        F.max((F.col("c") == F.col("leader")).cast("int")).alias("own"), F.count("*").alias("members"), F.sum("n").alias("elements")
    )
    info = parts.groupBy("band", "key").agg(
        F.max(F.struct("own", "root", "members", "elements")).alias("linked"), F.sum("members").alias("members"), F.sum("elements").alias("elements")
    )
    blocks_of = lambda count, most, elements, fit: F.greatest(F.ceil(count / most), F.ceil(elements / fit)).cast("int")
    unlinked, open_elements = F.col("members") - F.col("linked.members"), F.col("elements") - F.col("linked.elements")
    info = info.filter((unlinked > 0) & (F.col("members") > 2)).select(
        "band",
        "key",
        F.col("linked.root").alias("linked"),
        blocks_of(unlinked, LEADERS, open_elements, LEADER_ELEMENTS).alias("lb"),
        blocks_of(F.col("members"), MEMBERS, F.col("elements"), MEMBER_ELEMENTS).alias("mb"),
    )
    found = with_root.join(apart(info, "key"), ["band", "key"]).withColumn("apart", F.col("root") != F.col("linked"))
    rows = cut(found.select("band", "key", "c", "root", "apart", "lb", "mb").join(classes.select("c", "n", "registers"), "c"))
    spread = lambda n, salt: F.pmod(F.xxhash64("c", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["band", "key", "l", "m"]

    def blocks(of: DataFrame, payload: str, work, schema: str) -> DataFrame:
        left = of.filter("apart").withColumn("l", spread("lb", 1)).withColumn("m", every("mb"))
        right = of.withColumn("m", spread("mb", 2)).withColumn("l", every("lb"))
        columns = [*keys, "c", "root", "n", payload]
        return left.select(columns).groupBy(keys).cogroup(right.select(columns).groupBy(keys)).applyInArrow(work, schema)

    def part(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(t.column(c).combine_chunks().to_numpy() for c in ("c", "root", "n"))

    def sets(texts: pa.ChunkedArray, together: bool = False) -> list | Iterator:
        """The sets of all texts, each of its own, or made in slices and given as (bounds, elements) of a slice."""
        made = (element_sets(*text_buffer(p.column("text")), k) for p in slices(pa.table({"text": texts}).to_batches()))
        return made if together else [e[b[i] : b[i + 1]].copy() for b, e in made for i in range(len(b) - 1)]

    def hopeful(x: pa.Table, y: pa.Table) -> pa.Table:
        """The classes of a block that some other one may be linked to, by the sketches."""
        found: set[int] = set()
        if x.num_rows and y.num_rows:
            (cx, ox, nx), (cy, oy, ny) = part(x), part(y)
            rx, ry = (_matrix(t.column("registers").combine_chunks()) for t in (x, y))
            for i in range(len(cx)):
                fit = np.flatnonzero((oy != ox[i]) & (100 * np.minimum(ny, nx[i]) >= SIMILARITY * np.maximum(ny, nx[i])))
                fit = fit[(ry[fit] == rx[i]).mean(axis=1) >= SIMILARITY / 100 - 2 * MARGIN]
                if len(fit):
                    near = likeliest(rx[i : i + 1], ry[fit], np.full(len(fit), nx[i]), ny[fit]) >= SIMILARITY / 100 - MARGIN
                    if near.any():
                        found.add(int(cx[i]))
                        found.update(cy[fit[near]].tolist())
        return pa.table({"c": pa.array(sorted(found), pa.int64())})

    def confirmed(x: pa.Table, y: pa.Table) -> pa.Table:
        """For each class on the left, one link to every component of the block that holds a similar set."""
        a, b = [], []
        if x.num_rows and y.num_rows:
            (cx, ox, _), (cy, oy, _) = part(x), part(y)
            own, at = sets(x.column("text")), 0
            for yb, ye in sets(y.column("text"), True):  # a few texts at once: only the sets of x are held
                upto = at + len(yb) - 1
                sizes, c, o = np.diff(yb), cy[at:upto], oy[at:upto]
                for i, elements in enumerate(own):
                    place = np.minimum(np.searchsorted(elements, ye), len(elements) - 1)
                    shared = np.add.reduceat((elements[place] == ye).astype(np.int64), yb[:-1])
                    linked = (o != ox[i]) & (100 * shared >= SIMILARITY * (len(elements) + sizes - shared))
                    _, one = np.unique(o[linked], return_index=True)
                    a += [int(cx[i])] * len(one)
                    b += c[linked][one].tolist()
                at = upto
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    may = cut(blocks(rows, "registers", hopeful, "c long").distinct())
    if may.isEmpty():
        return may.select(F.col("c").alias("a"), F.col("c").alias("b"))
    again = cut(rows.drop("registers").join(_texts_of(may, classes, docs), "c"))
    return cut(blocks(again, "text", confirmed, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept) of every row; row is the hash of its text. component_id is the smallest doc_id reachable by links."""
    rows = cut(sketched(docs, k))
    classes = cut(
        rows.filter("c is not null")
        .groupBy("c")
        .agg(
            F.min("doc_id").alias("first"),
            F.min(F.struct(NO_ID("doc_id").alias("id"), "row")).alias("source"),
            F.count("*").alias("copies"),
            F.max("n_shingles").alias("n"),
            F.max("registers").alias("registers"),
        )
    )
    bands = _bands(classes)
    lead = bands.groupBy("band", "key").agg(F.count("*").alias("m"), F.max(F.struct("copies", "c")).alias("top"))
    lead = lead.filter("m > 1").select("band", "key", F.col("top.c").alias("leader"))
    buckets = cut(bands.join(apart(lead, "key"), ["band", "key"]))
    star = buckets.filter("c <> leader").select(F.least("c", "leader").alias("a"), F.greatest("c", "leader").alias("b")).distinct()
    links = cut(_confirmed(cut(_likely(star, classes)), classes, docs, k))
    roots = graph.components(links)
    roots = cut(roots)
    rest = _remaining(buckets, classes, roots, docs, k)
    root = classes.select("c", "first").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    if not rest.isEmpty():  # links between components: a much smaller graph of their roots
        of = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
        between = rest.join(of("a"), "a", "left").join(of("b"), "b", "left")
        merged = graph.components(between.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
        root = root.join(merged.select(F.col("node").alias("root"), F.col("root").alias("merged")), "root", "left")
        root = root.select("c", "first", F.coalesce("merged", "root").alias("root"))
    root = apart(root, "root")  # dealt by the root anew, so that the rows of a large component can be split
    named = root.join(apart(root.groupBy("root").agg(F.min("first").alias("component")), "root"), "root").select("c", "component")
    found = rows.select("doc_id", "row", "n_shingles", "c").join(named, "c", "left")
    component = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return found.select("doc_id", "row", "n_shingles", component.alias("component_id")).withColumn("kept", kept)
