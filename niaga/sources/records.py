"""Records of CSV files whose quoted cells hold line breaks, found by many tasks in one file.

A line begins inside a quoted cell or outside of one, and maps that state to the state behind it: a line without quotes keeps it, a
line of whole cells ends outside from either state, and so on. Such maps compose, so the state at the start of every block of a file
follows from one small row for each block (a prefix scan over the blocks of the file), without reading the file from its
beginning. Blocks without an open cell pass as they are. In the others lines are put together inside their block, and only what
crosses a border, at most two pieces for each block, is joined across blocks.

A quote counts only where a cell begins or a quoted cell goes on; one in the middle of an unquoted cell is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_QUOTED = r'"(?:[^"]++|"")*+'  # a quoted cell up to its closing quote, or to the end
_CELL = rf'(?:[^",][^,]*+|{_QUOTED}"[^,]*+)?+'
_OPEN = rf"(?:{_CELL},)*+{_QUOTED}\z"  # whole cells, then one that is not closed
OPENS = rf"^{_OPEN}"  # of a line that begins outside
STAYS = rf'^(?:[^"]++|"")*+(?:\z|"[^,]*+,{_OPEN})'  # of a line that begins inside

BLOCK = ["file", "block"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, block, pos, line): the lines of the files; block and pos order those of a file."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def _after(begins_inside: Column | bool) -> Column:
    """The state behind a line, from ``opens`` (begun outside) and ``stays`` (begun inside)."""
    inside = begins_inside if isinstance(begins_inside, Column) else F.lit(begins_inside)
    return F.when(inside, F.col("stays")).otherwise(F.col("opens"))


def _composed(window, start: Column | bool) -> Column:
    """The state behind the rows of a window that began with ``start``: the last row with one outcome decides, and each row
    behind it that swaps the states turns it."""
    swaps = F.sum((F.col("opens") & ~F.col("stays")).cast("int")).over(window)
    fixed = F.last(F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").alias("state"), F.col("_swaps").alias("swaps"))), True)
    fixed = fixed.over(window)
    turned = F.coalesce(swaps, F.lit(0)) - F.coalesce(fixed["swaps"], F.lit(0))
    first = start if isinstance(start, Column) else F.lit(start)
    state = F.coalesce(fixed["state"], first)
    return (state.cast("int") + turned) % 2 == 1


def _counted(rows: DataFrame, window) -> DataFrame:
    """With the running number of rows that swap the states."""
    return rows.withColumn("_swaps", F.sum((F.col("opens") & ~F.col("stays")).cast("int")).over(window))


def _maps(rows: DataFrame) -> DataFrame:
    return rows.withColumn("opens", F.rlike("line", F.lit(OPENS))).withColumn("stays", F.rlike("line", F.lit(STAYS)))


def blocks(rows: DataFrame) -> DataFrame:
    """(file, block, begins, open): the state at the start of every block, and whether any of its lines ends or begins inside a cell.

    Lines that keep the state are left out, and no text is shuffled.
    """
    told = _maps(rows.filter(F.contains("line", F.lit('"')))).filter(F.col("opens") | ~F.col("stays")).select(*BLOCK, "pos", "opens", "stays")
    order = Window.partitionBy(*BLOCK).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    told = _counted(told, order).withColumn("out", _composed(order, False)).withColumn("in", _composed(order, True))
    whole = told.groupBy(*BLOCK).agg(
        F.max_by("out", "pos").alias("opens"), F.max_by("in", "pos").alias("stays"), F.bool_or("out").alias("any_out")
    )
    every = rows.groupBy(*BLOCK).agg(F.count("*").alias("lines")).join(whole, BLOCK, "left").select(
        *BLOCK,
        F.coalesce("opens", F.lit(False)).alias("opens"),
        F.coalesce("stays", F.lit(True)).alias("stays"),
        F.coalesce("any_out", F.lit(False)).alias("any_out"),
    )
    along = Window.partitionBy("file").orderBy("block")
    upto, before = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(_composed(before, False), F.lit(False))
    return _counted(every, upto).withColumn("begins", begins).select(*BLOCK, "begins", (F.col("begins") | F.col("any_out")).alias("open"))


def records(rows: DataFrame, held: DataFrame) -> DataFrame:
    """(file, name, block, pos, record, unclosed) of every record; ``pos`` and ``block`` are those of its first line, ``unclosed``
    tells that its file ends inside a quoted cell. ``held`` is the result of ``blocks``."""
    placed = rows.join(held, BLOCK)
    plain = placed.filter(~F.col("open")).select(*BLOCK, "name", "pos", F.col("line").alias("record"), F.lit(False).alias("unclosed"))
    order = Window.partitionBy(*BLOCK).orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    # an identity among the maps swaps nothing and fixes nothing
    mixed = _counted(_maps(placed.filter("open")), upto).withColumn("ends", _composed(upto, F.col("begins")))
    mixed = mixed.withColumn("inside", F.coalesce(F.lag("ends").over(order), F.col("begins")))
    mixed = mixed.withColumn("start", F.last(F.when(~F.col("inside"), F.col("pos")), True).over(upto))
    text = lambda order, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, value))), lambda x: x[value]), "\n")
    pieces = mixed.groupBy(*BLOCK, "start").agg(
        F.first("name").alias("name"), text(["pos"], "line").alias("record"), F.max_by("ends", "pos").alias("ends")
    )
    whole = pieces.filter(F.col("start").isNotNull() & ~F.col("ends"))
    # at most two pieces of a block: what ends an earlier record, and what a later block goes on with
    parts = pieces.filter(F.col("start").isNull() | F.col("ends"))
    along = Window.partitionBy("file").orderBy("block", F.col("start").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("n", F.count("start").over(along))
    joined = parts.groupBy("file", "n").agg(
        F.min("block").alias("block"),
        F.min("start").alias("start"),
        F.first("name").alias("name"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", F.coalesce("start", F.lit(-1)).alias("s"), "record"))), lambda x: x["record"]), "\n"
        ).alias("record"),
        F.max_by("ends", F.struct("block", F.coalesce("start", F.lit(-1)))).alias("unclosed"),
    )
    return (
        plain.unionByName(whole.select(*BLOCK, "name", F.col("start").alias("pos"), "record", F.lit(False).alias("unclosed")))
        .unionByName(joined.select(*BLOCK, "name", F.col("start").alias("pos"), "record", "unclosed"))
    )


def broken_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """The records of the files, and (file, at, top) with the place and text of every file's first line; None if no quoted cell of
    theirs holds a line break: then every line is a record."""
    rows = lines(spark, path)
    if rows.filter(F.contains("line", F.lit('"'))).isEmpty():
        return None
    held = blocks(rows).persist()  # a row for each block
    if held.filter("open").isEmpty():
        return None
    tops = rows.filter("block = 0").groupBy("file").agg(F.min("pos").alias("at"), F.min_by("line", "pos").alias("top"))
    return records(rows, held), tops.persist()  # a row for each file
