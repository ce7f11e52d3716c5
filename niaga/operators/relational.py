"""Row-level operators shared by the dimension, fact and report plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from niaga.schemas import ARRIVAL

_SPREAD = 4096  # groups over which rows without a lookup key are spread


def keep_first(
    df: DataFrame,
    key: str,
    arrival: str = ARRIVAL,
    tasks: int | None = None,
    frequent: Sequence[str] = (),
    dealt: DataFrame | None = None,
) -> DataFrame:
    """The first row per key in arrival order.

    Spark plans ``row_number() = 1`` with a group limit before the shuffle as
    well as after it, so each map task sends at most one row per key: a key
    holding a third of the input does not land in one task. Sorting on a hash
    of the key first lets the sort compare numbers; texts with a common prefix
    are compared only where the hashes are equal.

    With ``tasks``, rows are dealt to so many tasks as they are read, and sorted there
    only: a map task of a large table, whose rows are far larger in memory than in their
    file, has no sort to spill. Keys that are ``frequent`` (and null) still take the way
    with a limit before the shuffle. ``dealt`` holds the same rows, stored in buckets of the key:
    a task reads a bucket, and these rows are not shuffled.
    """
    if tasks:
        limited = F.col(key).isNull() | F.col(key).isin(list(frequent))
        rest = df.where(~limited).repartition(tasks, key) if dealt is None else dealt.where(~limited)
        return keep_first(df.where(limited), key, arrival).unionByName(keep_first(rest, key, arrival))
    first = Window.partitionBy("_hash", key).orderBy(arrival)
    return (
        df.withColumn("_hash", F.xxhash64(key))
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .drop("_hash", "_n", arrival)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def lookup(rows: DataFrame, dim: DataFrame, on: str, dim_key: str, spread_by: str) -> DataFrame:
    """Left lookup of ``dim`` columns (all but ``dim_key``) by natural key.

    No broadcast hint: Spark broadcasts a dimension it measures to be small and
    otherwise shuffles, splitting skewed partitions. Rows without a key match
    nothing but would meet in one shuffle partition, so they are spread over
    several thousand stand-in values; a flag keeps these from matching. The
    stand-in takes the place of the key during the join: one text is shuffled,
    not two.
    """
    stand_in = F.concat(F.lit("none-"), F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD)).cast("string"))
    keyed = (
        rows.withColumn("_known", F.col(on).isNotNull())
        .withColumn("_on", F.coalesce(F.col(on), stand_in))
        .drop(on)
    )
    match = (F.col("_on") == F.col("_dim_key")) & F.col("_known")
    return (
        keyed.join(dim.withColumnRenamed(dim_key, "_dim_key"), match, "left")
        .withColumn(on, F.when(F.col("_known"), F.col("_on")))
        .drop("_known", "_on", "_dim_key")
    )


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows by a total order (callers end it with a unique column)."""
    return df.orderBy(*order).limit(n)
