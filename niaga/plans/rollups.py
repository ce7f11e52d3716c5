"""Stored roll-ups of the facts, and the choice of one that answers a report.

A fact is read once: grouping sets add its rows up to every grain declared here, and one shuffle writes them all, a folder for
each grain. A report asks ``grouped`` for measures of a fact by some keys. The smallest roll-up that holds these keys, the
columns of the report's condition and those of its filters answers, and the fact itself does where none is enough (a filter by
customer and product, or by days that are no whole months on a grain of months). Both ways give the same rows.

Distinct sessions cannot be added up. They are kept as mergeable sketches, so that those of any days, pages and devices are
estimated from the roll-up: with 2^LG_K registers one standard error is SKETCH_ERROR of the count. Reports stay exact; whoever
takes the estimate asks for it (``sessions``).

Roll-ups belong to one run and are listed in a table that is written last: a run without that list is answered from its facts.
An empty fact has empty roll-ups. Rows without a customer are a group of their own, told from "all customers" by the grouping id.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from niaga.operators import STORED
from niaga.plans.pipeline import Mart, latest_run, open_run, path_exists, together
from niaga.plans.placement import placed_folder, with_placement
from niaga.schemas import MONTH, TABLES, columns

LG_K = 14  # 16 384 registers: at most 16 kB for a sketch, less for few sessions
SKETCH_ERROR = 1.04 / math.sqrt(1 << LG_K)
_SET = "rollup"
_LISTED = columns("name string, rows bigint")


@dataclass(frozen=True)
class Rollup:
    name: str
    fact: str
    keys: tuple[str, ...]


_STATUS = ("status_order", "is_delivered", "is_cancelled", "is_returned")  # the flags follow from the status
ROLLUPS = (
    Rollup("orders_by_day", "fact_orders", (MONTH, "date_key", "payment_method_key", *_STATUS)),
    Rollup("orders_by_product", "fact_orders", (MONTH, "product_key", *_STATUS)),
    Rollup("orders_by_customer", "fact_orders", (MONTH, "customer_key", *_STATUS)),
    Rollup("orders_by_day_product", "fact_orders", (MONTH, "date_key", "product_key", "payment_method_key", *_STATUS)),
    Rollup("moves_by_day", "fact_inventory_movements", (MONTH, "date_key", "warehouse_key", "jenis_mutasi")),
    Rollup("moves_by_product", "fact_inventory_movements", (MONTH, "product_key", "warehouse_key", "jenis_mutasi")),
    Rollup("hits_by_day", "fact_web_clickstream", (MONTH, "date_key", "page_key", "device_key")),
)

# measure -> (from the rows of the fact, from the rows of a roll-up)
MEASURES: dict[str, dict[str, tuple[str, str]]] = {
    "fact_orders": {
        "n": ("count(1)", "coalesce(sum(n), 0)"),
        "quantity": ("sum(quantity)", "sum(quantity)"),
        "gross_revenue_idr": ("sum(gross_revenue_idr)", "sum(gross_revenue_idr)"),
        "gross_profit_idr": ("sum(gross_profit_idr)", "sum(gross_profit_idr)"),
        "delivered": ("sum(is_delivered)", "sum(is_delivered * n)"),
        "cancelled": ("sum(is_cancelled)", "sum(is_cancelled * n)"),
        "returned": ("sum(is_returned)", "sum(is_returned * n)"),
    },
    "fact_inventory_movements": {
        "n": ("count(1)", "coalesce(sum(n), 0)"),
        "quantity_change": ("sum(quantity_change)", "sum(quantity_change)"),
        "signed_quantity": ("sum(signed_quantity)", "sum(signed_quantity)"),
    },
    "fact_web_clickstream": {
        "n": ("count(1)", "coalesce(sum(n), 0)"),
        "response_time_ms": ("sum(response_time_ms)", "sum(response_time_ms)"),
        "slowest_ms": ("max(response_time_ms)", "max(slowest_ms)"),
        "sketch": (f"hll_sketch_agg(session_id, {LG_K})", "hll_union_agg(sketch)"),
    },
}
_READ_OF = {"delivered": "is_delivered", "cancelled": "is_cancelled", "returned": "is_returned"}  # keys such a measure reads


def _stored(fact: str) -> list[str]:
    """Measures with a column of their own; the others follow from keys and the count."""
    return [name for name in MEASURES[fact] if name not in _READ_OF]


def _of(fact: str) -> list[Rollup]:
    return [r for r in ROLLUPS if r.fact == fact]


class RolledUp(Mart):
    """A mart with roll-ups. Tables put in the place of a fact are not what its roll-ups were made of, so these go."""

    def __init__(self, tables: Mapping[str, DataFrame], rollups: Mapping[Rollup, tuple[DataFrame, int]]):
        super().__init__(tables)
        self.rollups = dict(rollups)

    def replaced(self, **tables: DataFrame) -> RolledUp:
        kept = {r: held for r, held in self.rollups.items() if r.fact not in tables}
        return RolledUp({**self, **tables}, kept)

    def narrowed(self, smaller: RolledUp, narrow: Callable[[str, DataFrame], DataFrame | None]) -> RolledUp:
        """``smaller`` with those roll-ups of this mart that can be narrowed as its facts were."""
        found = {r: (narrow(r.fact, rows), n) for r, (rows, n) in self.rollups.items()}
        return RolledUp(smaller, {r: held for r, held in found.items() if held[0] is not None})

    def covering(self, fact: str, needed: Iterable[str]) -> DataFrame | None:
        """The smallest roll-up of a fact that holds the columns."""
        fit = [(n, r.name, rows) for r, (rows, n) in self.rollups.items() if r.fact == fact and set(needed) <= set(r.keys)]
        return min(fit, key=lambda f: f[:2])[2] if fit else None


def _source(m: Mapping[str, DataFrame], fact: str, needed: Iterable[str]) -> tuple[DataFrame, int]:
    """The smallest roll-up with the columns and 1, or the fact and 0."""
    found = m.covering(fact, needed) if isinstance(m, RolledUp) else None
    return (m[fact], 0) if found is None else (found, 1)


def rows_of(m: Mapping[str, DataFrame], fact: str, keys: Sequence[str]) -> DataFrame:
    """Rows with these keys, added up or not: for distinct keys, and for measures that are sums of themselves."""
    return _source(m, fact, keys)[0]


def grouped(
    m: Mapping[str, DataFrame],
    fact: str,
    keys: Sequence[str],
    measures: Sequence[str],
    where: Column | str | None = None,
    reads: Sequence[str] = (),
) -> DataFrame:
    """Measures of a fact by keys, under a condition that reads the columns ``reads``.

    From the smallest roll-up of the mart that has all these columns, else from the fact. Without keys one row.
    """
    rows, form = _source(m, fact, {*keys, *reads, *(_READ_OF[name] for name in measures if name in _READ_OF)})
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy(*keys).agg(*(F.expr(MEASURES[fact][name][form]).alias(name) for name in measures))


def sessions(m: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Estimated distinct sessions by keys of the hits (day, page, device), from merged sketches."""
    return grouped(m, "fact_web_clickstream", keys, ["sketch"]).select(*keys, F.hll_sketch_estimate("sketch").alias("sessions"))


# --- storage ------------------------------------------------------------------------------


def _sums(rows: DataFrame, fact: str) -> DataFrame:
    """All roll-ups of a fact in one frame, told apart by the number of their grain."""
    grains = _of(fact)
    every = list(dict.fromkeys(key for r in grains for key in r.keys))
    bits = [sum(1 << (len(every) - 1 - i) for i, key in enumerate(every) if key not in r.keys) for r in grains]
    measures = [F.expr(MEASURES[fact][name][0]).alias(name) for name in _stored(fact)]
    summed = rows.groupingSets([[F.col(k) for k in r.keys] for r in grains], *map(F.col, every)).agg(F.grouping_id().alias("_bits"), *measures)
    number = F.coalesce(*(F.when(F.col("_bits") == b, F.lit(i)) for i, b in enumerate(bits)))
    return summed.withColumn(_SET, number).drop("_bits")


def _write(mart: Mart, folder: str, fact: str) -> list[tuple[str, int]]:
    grains = _of(fact)
    seen = Observation(f"{folder}:{fact}")
    counts = [F.count_if(F.col(_SET) == i).alias(r.name) for i, r in enumerate(grains)]
    _sums(mart[fact], fact).observe(seen, *counts).write.partitionBy(_SET).options(**STORED).mode("overwrite").parquet(f"{folder}/{fact}")
    return [(r.name, seen.get[r.name]) for r in grains]


def folder_of(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}/rollups"


def store_rollups(spark: SparkSession, mart: Mart, folder: str) -> RolledUp:
    """Write the roll-ups of a mart, one scan of each fact, and give the mart with them."""
    made = together(spark, {fact: lambda fact=fact: _write(mart, folder, fact) for fact in MEASURES})
    listed = spark.createDataFrame([row for rows in made.values() for row in rows], _LISTED)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{folder}/listed")
    return with_rollups(spark, mart, folder)


def with_rollups(spark: SparkSession, mart: Mart, folder: str) -> Mart:
    """The mart with the roll-ups that are stored for it, if any are."""
    if not path_exists(spark, f"{folder}/listed"):
        return mart
    sizes = {r["name"]: r["rows"] for r in spark.read.schema(_LISTED).parquet(f"{folder}/listed").collect()}  # a row for each roll-up
    held = {}
    for fact in MEASURES:
        for i, r in enumerate(_of(fact)):
            if r.name in sizes:
                names = [*r.keys, *_stored(fact)]
                rows = spark.read.schema(_schema(fact)).parquet(f"{folder}/{fact}").where(F.col(_SET) == i).select(*names)
                held[r] = rows, sizes[r.name]
    return RolledUp(mart, held)


def _schema(fact: str) -> str:
    """Declared columns of the stored roll-ups of a fact."""
    kinds = {f.name: f.dataType.simpleString() for f in TABLES[fact].stored_schema}
    every = list(dict.fromkeys(key for r in _of(fact) for key in r.keys))
    kind = {"sketch": "binary", "slowest_ms": "int"}
    fields = [f"{k} {kinds[k]}" for k in every] + [f"{name} {kind.get(name, 'bigint')}" for name in _stored(fact)]
    return ", ".join([*fields, f"{_SET} int"])


def open_rolled_up(spark: SparkSession, root: str) -> Mart:
    """The mart published last below ``root``, with its placed facts and its roll-ups if it has any."""
    run_id = latest_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"no published mart below {root}")
    mart = with_placement(spark, open_run(spark, root.rstrip("/"), run_id), placed_folder(root, run_id))
    return with_rollups(spark, mart, folder_of(root, run_id))


def whole_months(first: dt.date, last: dt.date) -> bool:
    """Whether the days are whole months, which a grain of months can tell."""
    return first.day == 1 and (last + dt.timedelta(days=1)).day == 1
