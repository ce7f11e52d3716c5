"""Facts placed by a space-filling curve, so that filters by category, city, site or platform skip files and row groups.

A load writes facts in the order of day and natural key, which only a date window prunes. Here a fact is written once more in the
order of a Z-curve over the day and the dimension columns that pages filter by: each gets a code of ``BITS`` bits, the bits are
interleaved, and one shuffle into ranges of that number makes the files. The codes are columns of the placed fact, so the smallest
and largest code of a row group tell whether it can hold a chosen value. A value's code is the share of the dimension's rows that
come before it, so that few values are spread over all codes as evenly as many. The codes are a stored table (a row for each choice
of a filter), from which a filter takes those of its values. Values that share a code cost a row group read in vain, no more:
the semi join to the dimension stays and decides.

The day's code is its place in the month, the partition of the stored fact. Rows without a member (anonymous hits) have no code.
A cell of the curve with very many rows is cut by its natural keys. An empty fact gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from niaga.operators import STORED
from niaga.plans.pipeline import Mart, path_exists, together
from niaga.schemas import MONTH, TABLES, columns

BITS = 10  # of each code
FILE_ROWS = 1_000_000  # rows of a file (about), which a task sorts in memory
# fact -> columns of dimensions on its curve: (column, dimension, key that it shares with the fact)
CURVES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "fact_orders": (("kategori", "dim_product", "product_key"), ("kota", "dim_customer", "customer_key")),
    "fact_inventory_movements": (("kategori", "dim_product", "product_key"), ("warehouse_name", "dim_warehouse", "warehouse_key")),
    "fact_web_clickstream": (("kota", "dim_customer", "customer_key"), ("platform", "dim_device", "device_key")),
}
CODES = "filter_codes"  # the table of codes in a placed mart
_CODES = columns("column string, value string, code int")


def code_name(column: str) -> str:
    """The column of a placed fact with the codes of a dimension column."""
    return f"_code_{column}"


def codes_of(dim: DataFrame, column: str) -> DataFrame:
    """(column, value, code) of the values of a dimension column: how many of 2^BITS equal parts of its rows lie before each."""
    counts = dim.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ordered = Window.orderBy("value")  # of the choices of a filter, one row each
    before = F.sum("n").over(ordered) - F.col("n")
    total = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return counts.select(F.lit(column).alias("column"), "value", F.floor(before / total * (1 << BITS)).cast("int").alias("code"))


def chosen_codes(mart: Mart, column: str, values: Sequence) -> list[int] | None:
    """The codes of the values that a filter chose; None in a mart that is not placed."""
    if CODES not in mart:
        return None
    found = mart[CODES].where((F.col("column") == column) & F.col("value").isin(list(values)))
    return sorted({r.code for r in found.collect()})  # a row for each chosen value


def with_codes(rows: DataFrame, column: str, codes: list[int] | None) -> DataFrame:
    """Rows that may belong to one of the values with these codes; all rows of a fact that is not placed by the column."""
    if codes is None or code_name(column) not in rows.columns:
        return rows
    return rows.where(F.col(code_name(column)).isin(codes))


def interleaved(codes: list[Column]) -> Column:
    """The place on the Z-curve: bit b of code i is bit len(codes) * b + i of the number."""
    bits = (
        F.shiftleft(F.shiftright(code, b).bitwiseAND(F.lit(1)).cast("long"), len(codes) * b + i)
        for b in range(BITS)
        for i, code in enumerate(codes)
    )
    place = F.lit(0).cast("long")
    for bit in bits:
        place = place.bitwiseOR(bit)
    return place


def placed(mart: Mart, codes: DataFrame, fact: str, files: int) -> DataFrame:
    """The rows of a fact with their codes, in ranges of the curve inside each month."""
    rows, names = mart[fact], []
    for column, dim, key in CURVES[fact]:
        names.append(code_name(column))
        of_values = codes.where(F.col("column") == column).select(F.col("value").alias(column), F.col("code").alias(names[-1]))
        # the value first and its code then: Spark takes a joined dimension for larger than the fact
        rows = rows.join(mart[dim].select(key, F.col(column).alias("_value")), key, "left")
        rows = rows.join(F.broadcast(of_values.withColumnRenamed(column, "_value")), "_value", "left").drop("_value")
    day = F.shiftleft(F.col("date_key") % 100, BITS - 5)  # 1 to 31
    curve = interleaved([day, *(F.coalesce(F.col(c), F.lit(0)) for c in names)])
    # a hash of the natural key cuts a cell that is larger than a range
    order = [MONTH, "_curve", "_cut"]
    laid = rows.withColumn("_curve", curve).withColumn("_cut", F.xxhash64(TABLES[fact].natural_key))
    laid = laid.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return laid.select(*(f.name for f in TABLES[fact].stored_schema if f.name != MONTH), *names, MONTH)


def store_placed(spark: SparkSession, mart: Mart, folder: str, file_rows: int = FILE_ROWS) -> Mart:
    """Write the facts of a mart placed by their curves, and give the mart with them."""

    filters = sorted({(column, dim) for curve in CURVES.values() for column, dim, _ in curve})
    reduce(DataFrame.unionByName, [codes_of(mart[dim], column) for column, dim in filters]).write.mode("overwrite").parquet(f"{folder}/codes")
    codes = spark.read.schema(_CODES).parquet(f"{folder}/codes")

    def write(fact: str) -> None:
        files = max(1, math.ceil(mart[fact].count() / file_rows))
        placed(mart, codes, fact, files).write.partitionBy(MONTH).options(**STORED).mode("overwrite").parquet(f"{folder}/{fact}")

    together(spark, {fact: lambda fact=fact: write(fact) for fact in CURVES})
    # written last: a run without it is read as it was loaded
    codes.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{CODES}")
    return with_placement(spark, mart, folder)


def with_placement(spark: SparkSession, mart: Mart, folder: str) -> Mart:
    """The mart with its placed facts, if they are stored."""
    if not path_exists(spark, f"{folder}/{CODES}/_SUCCESS"):
        return mart
    held = {CODES: spark.read.schema(_CODES).parquet(f"{folder}/{CODES}")}
    for fact in CURVES:
        codes = [StructField(code_name(column), IntegerType()) for column, *_ in CURVES[fact]]
        schema = StructType([*TABLES[fact].stored_schema.fields, *codes])
        held[fact] = spark.read.schema(schema).parquet(f"{folder}/{fact}")
    return mart.replaced(**held)


def placed_folder(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}/placed"
