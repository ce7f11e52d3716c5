"""Benchmark decontamination by winnowing (operator 12), in DataFrame functions only.

A window is ten consecutive words of an item (all words of a shorter one). Of the five-word runs in each window the one with the
smallest hash is kept: the fingerprint. Documents keep the smallest run of every window of that width in the same way, about two
runs in seven words. Equal windows keep equal runs, so a document that holds a window shares its fingerprint: nothing is missed.
Fingerprints of documents are joined with the distinct fingerprints of the items; each hit is extended to all windows of the
document that hold its run, and these are compared with the windows of the items by their words. Hit words follow from the
union of the matching windows. Items shorter than ten words have a width of their own (at most nine more, each only where
the items need it), with runs of five words or of the whole item.

Joins that grow with the data have one row for a key on their smaller side, written before, so that Spark broadcasts it if it is
small by its size on disk, and otherwise shuffles and splits hot keys. Windows that lie in the same items share a set of items, and
documents that hit the same sets share one combination, so that neither a passage in very many documents nor one in very many
items gives their pairs; the items of a combination are listed once.

Results for odd rows: a null, empty or blank text has no words and is not hit; an item without words has no window; rows that repeat
an item's id are one item with the windows of all of them, and an item without an id marks words but is not listed; repeated
documents have equal results, a null id too; a word of any length is one word; other columns are ignored; without documents
the result is empty, and without items no document is hit.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from niaga.session import shared_root

WINDOW = 10  # words of a window
RUN = 5  # words of a fingerprinted run, at most
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Found(NamedTuple):
    documents: DataFrame  # (doc_id, row, n_words, n_hit, spans, combination) of every document
    combinations: DataFrame  # (combination, items): the sorted ids, as strings, of all items that a combination stands for


def words(text: Column) -> Column:
    """Runs of digits, letters a to z and other characters beyond ASCII, after lower-casing A to Z."""
    plain = F.octet_length(text) == F.length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(lowered, _SEPARATORS), lambda w: w != "")


def run_length(width: int) -> int:
    return min(width, RUN)


def runs(hashed: Column, k: int) -> Column:
    """A hash of each k consecutive words."""
    whole = F.slice(hashed, F.lit(1), F.greatest(F.size(hashed) - (k - 1), F.lit(0)))
    return F.transform(whole, lambda h, i: F.xxhash64(h, *[F.get(hashed, i + j) for j in range(1, k)]))


def smallest(hashes: Column, width: int) -> Column:
    """The smallest hash of each window of so many runs."""
    if width == 1:
        return hashes
    whole = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(0)))
    return F.transform(whole, lambda h, i: F.least(h, *[F.get(hashes, i + j) for j in range(1, width)]))


def kept(hashes: Column, least: Column, width: int, words_wide: int) -> Column:
    """(width, hash, at) of the runs that are the smallest of a window (each of them, where equal runs tie)."""
    placed = F.transform(hashes, lambda h, i: F.struct(F.lit(words_wide).alias("width"), h.alias("hash"), i.alias("at")))
    if width == 1:
        return placed
    most = lambda s: F.greatest(*[F.get(least, s["at"] - j) for j in range(width)])  # noqa: E731  outside: null, skipped
    return F.filter(placed, lambda s: s["hash"] == most(s))


def fingerprints(texts: DataFrame, widths: list[int]) -> DataFrame:
    """(doc_id, row, width, hash, at): the runs that documents keep for windows of each width; ``at`` is the run's first word."""
    rows = texts.select("doc_id", "row", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashed"))
    for k in sorted({run_length(n) for n in widths}):
        rows = rows.withColumn(f"run{k}", runs(F.col("hashed"), k))
    every = []
    for n in widths:
        hashes, wide = F.col(f"run{run_length(n)}"), n - run_length(n) + 1
        rows = rows.withColumn(f"least{n}", smallest(hashes, wide))
        every.append(kept(hashes, F.col(f"least{n}"), wide, n))
    return rows.select("doc_id", "row", F.explode(F.concat(*every)).alias("f")).select("doc_id", "row", "f.*")


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, width, window, hash): the windows of every item, with their fingerprints."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    rows = rows.withColumn("width", F.least(F.size("w"), F.lit(WINDOW)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("width") + 1)
    rows = rows.select("item", "width", F.explode(F.transform(starts, lambda s: F.slice("w", s, F.col("width")))).alias("w"))
    rows = rows.withColumn("hashed", F.transform("w", lambda w: F.xxhash64(w)))
    least = None
    for k in range(1, RUN + 1):
        of_k = F.array_min(runs(F.col("hashed"), k))
        least = F.when(F.col("width") == k if k < RUN else F.col("width") >= k, of_k) if least is None else least.when(
            F.col("width") == k if k < RUN else F.col("width") >= k, of_k
        )
    return rows.select("item", "width", F.array_join("w", " ").alias("window"), least.alias("hash"))


def place(wide: Column | str, first: Column) -> Column:
    return F.shiftleft(first.cast("long"), 4).bitwiseOR(F.col(wide) if isinstance(wide, str) else wide)


def width(place: Column) -> Column:
    return place.bitwiseAND(F.lit(15)).cast("int")


def at(place: Column) -> Column:
    return F.shiftright(place, 4)


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row"] == b["row"])


def find(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Found:
    """Which words of the documents lie in windows of the items, as spans [first, last) of words, and which items these are."""
    spark = docs.sparkSession
    folder = f"{shared_root(spark)}/niaga/{spark.sparkContext.applicationId}/winnowing-{uuid.uuid4().hex}"

    def put(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))

    # the items: their windows, and for each the set of items that hold it, told by a sum that needs no list
    held = put("items", item_windows(items, id_col, text_col).distinct())
    mark = lambda salt: F.bit_xor(F.xxhash64("item", F.lit(salt)))
    windows = held.groupBy("width", "window", "hash").agg(F.count("item").alias("n"), mark(1).alias("x"), mark(2).alias("y"))
    windows = put("windows", windows.select("width", "window", "hash", F.concat_ws(":", "n", "x", "y").alias("set")))
    sample = windows.groupBy("set").agg(F.min(F.struct("width", "window")).alias("one")).select("set", "one.*")
    set_items = put("sets", held.filter("item is not null").join(put("samples", sample), ["width", "window"]).select("set", "item"))
    widths = sorted(r.width for r in windows.select("width").distinct().collect())  # at most WINDOW
    wanted = put("wanted", windows.select("width", "hash").distinct())

    # hits of fingerprints, extended to the windows that hold them, compared by words
    if widths:
        hit = fingerprints(texts, widths).join(wanted, ["width", "hash"], "left_semi").select("doc_id", "row", "width", "at")
        # a place (width and word) is one number: sets of numbers are hashed, sets of structs are searched through
        hit = hit.groupBy("doc_id", "row").agg(F.collect_set(place("width", F.col("at"))).alias("hits"))  # fewer than the words
        hit = put("hits", hit)
        both = texts.join(hit, same_document(texts, hit)).select(texts["doc_id"], texts["row"], words(texts["text"]).alias("w"), "hits")
        first = lambda h: F.greatest(at(h) - width(h) + F.least(width(h), F.lit(RUN)), F.lit(0))
        last = lambda h: F.least(at(h), F.size("w") - width(h))
        starts = lambda h: F.transform(F.sequence(first(h), last(h)), lambda s: place(width(h), s))
        both = both.withColumn("tried", F.array_distinct(F.flatten(F.transform("hits", starts))))
        window = lambda t: F.array_join(F.slice("w", (at(t) + 1).cast("int"), width(t)), " ")
        held_there = lambda t: F.struct(width(t).alias("width"), at(t).cast("int").alias("start"), window(t).alias("window"))
        tried = both.select("doc_id", "row", F.explode(F.transform("tried", held_there)).alias("t")).select("doc_id", "row", "t.*")
        matched = tried.join(windows.select("width", "window", "set"), ["width", "window"])
        matched = matched.select("doc_id", "row", "start", (F.col("start") + F.col("width")).alias("end"), "set")
    else:
        matched = spark.createDataFrame([], "doc_id long, row long, start int, end int, set string")

    # spans: where a window begins behind all earlier ones of its document, a new one begins
    one = Window.partitionBy("doc_id", "row").orderBy("start", "end")
    reached = F.max("end").over(one.rowsBetween(Window.unboundedPreceding, -1))
    islands = matched.withColumn("new", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(one.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy("doc_id", "row", "island").agg(
        F.min("start").alias("first"), F.max("end").alias("last"), F.collect_set("set").alias("sets")
    )
    hits = spans.groupBy("doc_id", "row").agg(
        F.sum(F.col("last") - F.col("first")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("sets")))).alias("sets"),
    )
    hits = put("documents", hits.withColumn("combination", F.sha2(F.concat_ws(",", "sets"), 256)))

    # the items of each combination of sets, listed once
    combined = hits.groupBy("combination").agg(F.first("sets").alias("sets")).select("combination", F.explode("sets").alias("set"))
    listed = put("combined", combined).join(set_items, "set").groupBy("combination").agg(F.sort_array(F.collect_set("item")).alias("items"))
    counted = texts.select("doc_id", "row", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    found = counted.join(hits, same_document(counted, hits), "left").select(
        counted["doc_id"],
        counted["row"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
        "combination",
    )
    return Found(found, put("combinations", listed))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = find(docs, items)
    listed = found.combinations.select(
        "combination", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    )
    return found.documents.join(listed, "combination", "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
