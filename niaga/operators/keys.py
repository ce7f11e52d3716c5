"""Dense surrogate keys without a global sort in one task."""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

SAMPLED = 64  # staged rows per range from which the bounds are taken
RANGE_ROWS = 2_000_000  # rows of a range at most (about)
LEAST_ROWS = 25_000  # rows for which a further task is worth it
BUCKET_BYTES = 40_000_000  # of the files of a source, for a bucket of its staged rows: some two million of them
LEAST_BYTES = 1_000_000  # for which a further bucket is worth it
MOST_BUCKETS = 1024  # a task that writes makes a file for each
MOST_WRITERS = 16  # files that a task holds open; rows for more are sorted by file, which costs less than going to and fro between them
BUCKET_ROWS = 5_000  # rows of a file, below which a shuffle is cheaper than buckets
MOST_RANGES = 16_384  # ranges of a table of any size; a range is then larger, and its rows lie in several files
SAMPLE_ROWS = 1 << 18  # rows that the bounds are taken from, at any size of the table

FREQUENT = 64  # rows of a sample of that size which make a key frequent: one in 4096 rows of a large table
CODEC = "zstd"  # of written tables: half the bytes of Spark's default
# of written tables: keys and other columns of many values give up their dictionary early, before it outgrows the cache
STORED = {"compression": CODEC, "parquet.dictionary.page.size": str(1 << 16)}

_POSITION_BITS = 33  # low bits of monotonically_increasing_id: position within its partition
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def write_buckets(rows: DataFrame, column: str, number: int, path: str) -> DataFrame:
    """Write rows to a new folder, dealt into files by a hash of a column: grouping by it needs no shuffle of the frame returned.

    Each task deals its rows to files as it writes. Spark does so only for tables of its catalog: this one is listed
    there while it is written. To every other reader the files are plain ones.
    """
    spark = rows.sparkSession
    table = f"niaga_{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], rows.schema).write.bucketBy(number, column)
    empty.options(**STORED).saveAsTable(table, format="parquet", path=path)
    try:
        rows.write.insertInto(table)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def dense_key(df: DataFrame, key: str, order: list[str], scratch: str) -> DataFrame:
    """Number rows 1..n by ``order`` (a total order), as column ``key``.

    One range shuffle sorts the rows across tasks. The sorted rows are written
    to ``scratch`` with their position inside their range; reading them back
    cuts the lineage, so the positions cannot shift if an executor is lost.
    The number of rows before each range (one row per range, so its size is
    bounded by the partition count) is then added by a broadcast join.
    """
    spark = df.sparkSession
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
        .write.options(**STORED)
        .parquet(scratch)
    )
    schema = StructType([*df.schema.fields, StructField("_position", LongType())])
    placed = spark.read.schema(schema).parquet(scratch)
    part = F.shiftright("_position", _POSITION_BITS)
    within = F.col("_position").bitwiseAND(F.lit(_POSITION_MASK))

    sizes = placed.groupBy(part.alias("_part")).agg((F.max(within) + 1).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(key, F.col("_before") + within + 1)
        .drop("_part", "_before", "_position")
    )


def range_count(rows: int, parallel: int) -> int:
    """Ranges for a table of so many rows: what the tasks can hold, or fewer than run at once for a small one."""
    return min(MOST_RANGES, max(1, math.ceil(rows / RANGE_ROWS), min(parallel, math.ceil(rows / LEAST_ROWS))))


def bucket_count(size: int, parallel: int) -> int:
    """Buckets for the staged rows of a source with files of so many bytes, as ``range_count`` does by rows; 0 for what one task holds."""
    found = min(MOST_BUCKETS, max(math.ceil(size / BUCKET_BYTES), min(parallel, size // LEAST_BYTES)))
    return found if found > 1 else 0


def sample_share(rows: int, ranges: int) -> float:
    """The part of the rows that bounds are taken from: SAMPLED for each range, and never more than SAMPLE_ROWS."""
    return min(1.0, min(SAMPLED * ranges, SAMPLE_ROWS) / max(rows, 1))


def staged_bounds(staged: DataFrame, rows: int, ranges: int) -> list[tuple[int, str]]:
    """At most ``ranges`` - 1 bounds in (day, natural key) order, from a sample of two staged columns of bounded size."""
    if ranges == 1 or not rows:
        return []
    share = sample_share(rows, ranges)
    sample = (staged if share == 1 else staged.sample(share, seed=1)).toArrow()
    days, items = (sample.column(i).to_pylist() for i in (0, 1))
    seen = sorted({(d, i) for d, i in zip(days, items, strict=True) if d is not None and i is not None})
    return sorted({seen[len(seen) * i // ranges] for i in range(1, ranges)} if seen else set())


def frequent_keys(staged: DataFrame, key: str, rows: int) -> list[str]:
    """Keys that a sample of bounded size finds often, 4096 at most; none in a table that one task holds."""
    if rows <= LEAST_ROWS:
        return []
    share = min(1.0, SAMPLE_ROWS / rows)
    sample = staged.select(key) if share == 1 else staged.select(key).sample(share, seed=1)
    often = sample.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") >= FREQUENT)
    return [r[0] for r in often.orderBy(F.desc("count"), key).limit(SAMPLE_ROWS // FREQUENT).collect()]


def _one_for_each(spark: SparkSession, number: int) -> list[int]:
    """A number for each bucket that Spark deals there. With any others two ranges might share a bucket, and rows would be the same."""
    tried = spark.range(32 * number + 1024).select(F.col("id").cast("int").alias("id"))
    found = tried.groupBy(F.pmod(F.hash("id"), F.lit(number)).alias("bucket")).agg(F.min("id").alias("id")).collect()
    return [r["id"] for r in found]


def dense_key_by_day(
    df: DataFrame,
    key: str,
    order: tuple[str, str, str],
    bounds: list[tuple[int, str]],
    calendar: list[int],
    scratch: str,
    buckets: bool = False,
) -> DataFrame:
    """Number the rows that are not set aside 1..n by (day, natural key), as column ``key``.

    ``order`` names the flag of rows set aside, the day and the natural key. ``bounds`` cut the order into ranges, so
    that ``df`` is evaluated once: nothing samples it. A row finds its range by a broadcast row of its day (a row for
    each day of the calendar, with the day's bounds); one shuffle by that number and one sort place the rows, which are
    written with their position. Rows set aside come last in their range and take no number.

    With ``buckets`` there is no shuffle: rows are written as they come, dealt into files by range, and a task that reads a
    range sorts it. The order is total, so that a range read again has the same numbers. This is for ranges of many rows.
    """
    spark = df.sparkSession
    aside, day, item = order
    cuts: dict[int, list[str]] = {}
    for d, i in bounds:
        cuts.setdefault(d, []).append(i)
    before = [(d, bisect_left(bounds, (d, "")), cuts.get(d, [])) for d in calendar]
    days = spark.createDataFrame(before, f"{day} int, _before int, _cuts array<string>")
    found = F.col("_before") + F.size(F.filter("_cuts", lambda b: b <= F.col(item)))
    ranged = (
        df.join(F.broadcast(days), day, "left")
        .withColumn("_range", F.coalesce(found, F.lit(0)))
        .select(*df.columns, "_range")
    )
    if buckets and bounds:
        dealt = _one_for_each(spark, len(bounds) + 1)
        deal = F.broadcast(spark.createDataFrame(list(enumerate(dealt)), "_range int, _deal int"))
        # a range that got no bucket of its own is dealt by its number
        ranged = ranged.join(deal, "_range", "left").withColumn("_deal", F.coalesce("_deal", "_range")).select(*df.columns, "_range", "_deal")
        stored = write_buckets(ranged, "_deal", len(bounds) + 1, scratch)
        inside = Window.partitionBy("_deal", "_range", aside).orderBy(day, item)
        placed = stored.withColumn("_n", F.row_number().over(inside))
        return placed.join(F.broadcast(_starts(stored, aside)), "_range").select(
            *df.columns, F.when(~F.col(aside), F.col("_first") + F.col("_n")).alias(key)
        )
    (
        ranged.repartitionById(len(bounds) + 1, "_range")
        .sortWithinPartitions(aside, day, item)
        .withColumn("_position", F.monotonically_increasing_id())
        .write.options(maxRecordsPerFile=2 * RANGE_ROWS, **STORED)
        .parquet(scratch)
    )
    fields = [StructField("_range", IntegerType()), StructField("_position", LongType())]
    placed = spark.read.schema(StructType([*df.schema.fields, *fields])).parquet(scratch)
    within = F.col("_position").bitwiseAND(F.lit(_POSITION_MASK))
    return (
        placed.join(F.broadcast(_starts(placed, aside)), "_range")
        .withColumn(key, F.when(~F.col(aside), F.col("_first") + within + 1))
        .drop("_range", "_first", "_position")
    )


def _starts(placed: DataFrame, aside: str) -> DataFrame:
    """Numbered rows before each range."""
    sizes = placed.groupBy("_range").agg(F.count_if(~F.col(aside)).alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_first"))
