"""Merkle manifest of a dataset with a membership proof of every row (operator 13).

Every node of a tree carries the interval [lo, hi) of leaf ranks that it covers. Levels are cut into bands of ``BAND``: a block
of a band holds the at most 32 nodes that enter it, and what they become on its levels, so a block is one bounded row. A node
finds its block by its interval's bucket on the band's level (a join on equal buckets, no range join), its ancestors in the block
are the nodes whose interval contains its own, and its sibling on a level is what its parent's interval holds beyond its own
ancestor's. Paths are attached from the top band down, so each block is joined once with the path of the node above it; the
rows of the upper bands are a 32nd part each. Ranks come from a range shuffle (no task sees a whole tree), and everything is
DataFrame functions; a tree of one language with most rows is spread over all tasks like any other.

Results for odd rows: every row is a leaf, repeated rows too (equal ids stand in the order of their leaves, so the root does not
depend on the order of the input); a null id stands first in its language and is never tampered with; null, empty and very long texts
are hashed as they are; rows without a language are a tree of their own, before the others; a tampered length beyond a
long is the next whole number; a tree of one leaf has the leaf as its root and an empty path; other columns are ignored; an
empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niaga.operators import dense_key
from niaga.session import shared_root

BAND = 5  # levels of a band: a block has at most 2^5 nodes below
TAMPERED = 7  # rows whose id's checksum this divides are changed for the test of the proofs


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length, so that no two rows have the same concatenation."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, changed): the leaf of every row, and that of the tampered row where there is one."""
    c = {name: F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")}
    longer = c["n_chars"].cast("decimal(20,0)") + 1
    fields = {name: field(value) for name, value in c.items()}
    hit = F.crc32(c["doc_id"].cast("string")) % TAMPERED == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), c["lang"]), F.lit("-")).alias("tree"),
        c["doc_id"].cast("long").alias("doc_id"),
        digest(*fields.values()).alias("digest"),
        F.when(hit, digest(*(fields | {"n_chars": field(longer)}).values())).alias("changed"),
    )


class Store:
    """Tables of one manifest in the shared folder, written once and read again."""

    def __init__(self, df: DataFrame):
        context = df.sparkSession.sparkContext
        self.root = f"{shared_root(df.sparkSession)}/niaga/{context.applicationId}/merkle-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(self.path(name))
        return df.sparkSession.read.schema(df.schema).parquet(self.path(name))


def ranked(rows: DataFrame, order: list[str], store: Store, name: str) -> DataFrame:
    """The rows with ``lo``, their rank from 0 in the order of their tree, and ``n``, the leaves of the tree."""
    # equal rows differ in ``at`` only, so that very many of them do not share a range
    rows = store.put(f"{name}-leaves", rows).withColumn("at", F.monotonically_increasing_id())
    numbered = dense_key(rows, "position", ["tree", *order, "at"], store.path(f"{name}-ordered"))
    spans = store.put(f"{name}-spans", numbered.groupBy("tree").agg(F.min("position").alias("first"), F.count("*").alias("n")))
    return numbered.join(spans, "tree").withColumn("lo", F.col("position") - F.col("first")).drop("position", "first", "at")


def more_than_one(level: int) -> Column:
    """Whether the tree has several nodes on this level."""
    return F.shiftright(F.col("n") - 1, level) > 0


def parents(nodes: Column) -> Column:
    """The nodes over runs of two; the last run may have one."""

    def over(i: Column) -> Column:
        left, right = F.get(nodes, 2 * i), F.get(nodes, 2 * i + 1)
        return F.struct(
            left["lo"].alias("lo"),
            F.coalesce(right["hi"], left["hi"]).alias("hi"),
            digest(left["digest"], F.coalesce(right["digest"], F.lit(""))).alias("digest"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), over)


def bands(rows: DataFrame, own: Column, store: Store, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every band, from the leaves up, and (tree, n, digest) of the roots.

    A block has ``members`` (the nodes that enter it, leaves with their ``own`` columns) and its levels ``l0`` to ``l5``; a level
    above the tree's root is null.
    """
    nodes = rows.select("tree", "n", F.struct("lo", (F.col("lo") + 1).alias("hi"), "digest", own.alias("own")).alias("node"))
    found, roots, band, going = [], None, 0, True
    while going:
        base = band * BAND
        blocks = nodes.groupBy("tree", F.shiftright("node.lo", base + BAND).alias("block")).agg(
            F.max("n").alias("n"), F.sort_array(F.collect_list("node")).alias("members")
        )
        label = lambda m: F.struct(m["lo"].alias("lo"), m["hi"].alias("hi"), m["digest"].alias("digest"))
        blocks = blocks.withColumn("l0", F.transform("members", label))
        for j in range(BAND):
            blocks = blocks.withColumn(f"l{j + 1}", F.when(more_than_one(base + j), parents(F.col(f"l{j}"))))
        blocks = store.put(f"{name}-band-{band}", blocks)
        found.append(blocks)
        top = F.coalesce(*[F.col(f"l{j}") for j in range(BAND, -1, -1)])[0]
        above = blocks.select("tree", "n", "block", top.alias("node"))
        ended = above.filter(~more_than_one(base + BAND)).select("tree", "n", F.col("node.digest").alias("digest"))
        roots = ended if roots is None else roots.unionByName(ended)
        nodes = above.filter(more_than_one(base + BAND)).select("tree", "n", "node")
        band, going = band + 1, not nodes.isEmpty()
    return found, store.put(f"{name}-roots", roots)


def contains(node: Column, lo: Column) -> Column:
    return (node["lo"] <= lo) & (lo < node["hi"])


def beyond(parent: Column, lo: Column):
    """Whether a node lies in the parent's interval, but does not cover the leaf ``lo``."""
    return lambda x: (parent["lo"] <= x["lo"]) & (x["hi"] <= parent["hi"]) & ~contains(x, lo)


def attached(blocks: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, node, path, top) of every leaf: ``path`` has a step (left, digest) for each level up to the end of the tree's path in
    ``tops`` (tree, n, path, top). The digest of a step is empty where the node has no sibling."""
    below = None
    for band in range(len(blocks) - 1, -1, -1):
        base = band * BAND
        begins = more_than_one(base) if band else F.lit(True)
        above = tops.filter(begins & ~more_than_one(base + BAND)).select("tree", F.lit(0).cast("long").alias("block"), "path", "top")
        if below is not None:
            above = above.unionByName(below.select("tree", F.shiftright("node.lo", base + BAND).alias("block"), "path", "top"))
        rows = blocks[band].join(above, ["tree", "block"]).withColumn("node", F.explode("members")).drop("members")
        lo, steps = F.col("node.lo"), []
        for j in range(BAND):
            # the parent, then the part of its interval that the node's ancestor on this level does not cover
            rows = rows.withColumn(f"p{j}", F.get(F.filter(f"l{j + 1}", lambda x: contains(x, lo)), F.lit(0)))
            parent = F.col(f"p{j}")
            rows = rows.withColumn(f"s{j}", F.get(F.filter(f"l{j}", beyond(parent, lo)), F.lit(0)))
            other = F.col(f"s{j}")
            step = F.struct(F.coalesce(other["lo"] < lo, F.lit(False)).alias("left"), F.coalesce(other["digest"], F.lit("")).alias("digest"))
            steps.append(F.when(parent.isNotNull(), step))
        own = F.filter(F.array(*steps), lambda s: s.isNotNull())
        below = rows.select("tree", "node", F.concat(own, "path").alias("path"), "top")
    return below


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    step = lambda s, acc: digest(F.when(s["left"], s["digest"]).otherwise(""), acc, F.when(s["left"], "").otherwise(s["digest"]))
    return F.aggregate(path, leaf, lambda acc, s: step(s, acc))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, changed) of every row of documents: its leaf, the roots of its language and of the
    dataset, the steps of its proof from the leaf up, and the leaf of the tampered row (null where it is not tampered with)."""
    store = Store(docs)
    rows = ranked(leaves(docs), ["doc_id", "digest"], store, "rows")
    row_bands, subroots = bands(rows, F.struct("doc_id", "changed"), store, "rows")
    # the subroots are the leaves of one more tree
    langs = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    lang_rows = ranked(langs, ["lang"], store, "langs")
    lang_bands, root = bands(lang_rows, F.struct("lang"), store, "langs")
    steps = F.array().cast("array<struct<left:boolean,digest:string>>")
    over = attached(lang_bands, root.select("tree", "n", steps.alias("path"), F.col("digest").alias("top")))
    ends = over.select(F.col("node.own.lang").alias("tree"), "path", F.struct(F.col("node.digest").alias("subroot"), F.col("top").alias("root")).alias("top"))
    tops = store.put("tops", ends.join(subroots.select("tree", "n"), "tree"))
    found = attached(row_bands, tops)
    return found.select(
        F.col("node.own.doc_id").alias("doc_id"),
        F.col("node.digest").alias("leaf"),
        F.col("top.subroot").alias("subroot"),
        F.col("top.root").alias("root"),
        "path",
        F.col("node.own.changed").alias("changed"),
    )


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): whether each row, tampered with or not, still proves its
    membership."""
    root = folded(F.coalesce("changed", "leaf"), F.col("path"))
    siblings = F.array_join(F.transform("path", lambda s: s["digest"]), "")
    made = manifest(docs).select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), root.alias("folded_root"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))
