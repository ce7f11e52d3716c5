"""Load on top of the last published run: stable surrogate keys, and only the months that changed are written.

Natural keys keep the surrogate keys of the last run; new ones are numbered behind the highest key ever given, by range counts like
those of a full load. Because the keys stay, an unchanged row of a fact is the same row again, so a month of a fact needs no new files
if the checksum of its rows (count, and two sums of row hashes that do not depend on the order) is that of the last run. The checksum is
taken from the joined rows, so that a changed price, a customer who is now known or another first duplicate counts as a change.
Changed months are written by this run; a table of the run tells for every month of a fact which run holds it.

The last run is the one this load was based on until it is published: a claim file that only one load can create tells two loads on the
same run apart, and the later one starts again on what the other has published.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from niaga.functions import date_key, date_month
from niaga.operators import dense_key
from niaga.operators.constraints import null_counts
from niaga.operators.history import VALID_FROM, VALID_TO, first_versions, merge_versions
from niaga.operators.quality import rule_counts
from niaga.plans import dimensions, facts
from niaga.plans.pipeline import (
    FACT_TOTALS,
    MONTHS,
    SNAPSHOT_DATE,
    Load,
    LoadResult,
    Mart,
    bounded_writes,
    claim,
    finish,
    joined_rows,
    latest_run,
    load_calendar,
    new_load,
    open_run,
    path_exists,
    run_load,
    stage,
    together,
    write_checked,
)
from niaga.schemas import MONTH, ORPHANS, SOURCES, TABLES
from niaga.sources import SourceFrame

# attributes whose changes over time are kept
HISTORY = {
    "dim_customer": ["nama_lengkap", "email", "kota", "account_tier"],
    "dim_product": ["nama_produk", "kategori", "harga_modal_idr", "harga_jual_idr", "is_active"],
}
ATTEMPTS = 3  # loads that may overtake this one before it gives up


class Overtaken(RuntimeError):
    """Another load was published on the same run first."""


def _hashes(names: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; a null is told from a missing value by its place."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in names]
    return F.xxhash64(*fields), F.xxhash64(F.lit(1), *fields)


def _checksums(rows: DataFrame, names: list[str], month: Column) -> DataFrame:
    """(month, rows, x, y): the checksum of the rows of each month."""
    a, b = _hashes(names)
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    return rows.groupBy(month.alias("month")).agg(F.count("*").alias("rows"), wide(a).alias("x"), wide(b).alias("y"))


def _collected(sums: DataFrame) -> dict[int, tuple]:
    return {r.month: (r["rows"], r.x, r.y) for r in sums.collect()}  # a row for each month


def _fact_columns(name: str) -> list[str]:
    return [f.name for f in TABLES[name].schema if f.name != TABLES[name].primary_key]


def _now(name: str, plan: DataFrame) -> tuple[dict[int, tuple], dict[int, tuple]]:
    """Checksums of the months of a fact as it is now, and of its rows set aside, from one pass."""
    table, aside = TABLES[name], facts.ORPHAN_TABLE.get(name)
    kept = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema if f.name != table.primary_key]
    a, b = _hashes(_fact_columns(name))
    month = date_month(F.col("date_key")).alias("month")
    rows = plan.select(facts.ORPHAN, month, *(kept if not aside else [*kept, *_aside_columns(name)]))
    if aside:
        c, d = _hashes([f"_aside_{f.name}" for f in ORPHANS[aside]])
        a, b = F.when(F.col(facts.ORPHAN), c).otherwise(a), F.when(F.col(facts.ORPHAN), d).otherwise(b)
    wide = lambda x: F.sum(x.cast("decimal(38,0)"))
    found = rows.groupBy("month", facts.ORPHAN).agg(F.count("*").alias("rows"), wide(a).alias("x"), wide(b).alias("y")).collect()
    return tuple({r.month: (r["rows"], r.x, r.y) for r in found if r[facts.ORPHAN] == flag} for flag in (False, True))


def _aside_columns(name: str) -> list[Column]:
    return [F.col(f.name).cast(f.dataType).alias(f"_aside_{f.name}") for f in ORPHANS[facts.ORPHAN_TABLE[name]]]


def _aside_month(name: str) -> Column:
    time = {"fact_orders": "order_datetime", "fact_inventory_movements": "movement_datetime"}[name]
    return date_month(date_key(F.col(time)))


def _dictionary(load: Load, base: str, mart: Mart, name: str) -> DataFrame:
    """(natural key, surrogate key) of every member that any run on the way here has seen."""
    table = TABLES[name]
    path = f"{load.root}/runs/{base}/keys_{name}"
    if path_exists(load.spark, path):
        return load.spark.read.schema(load.schema_of_keys(name)).parquet(path)
    return mart[name].select(table.natural_key, table.primary_key)


def _highest(known: DataFrame, key: str) -> int:
    return known.agg(F.max(key)).head()[0] or 0


def _load_dimension(load: Load, base: str, mart: Mart, name: str, tables: Mapping[str, DataFrame], snapshot: dt.date) -> DataFrame:
    """The dimension of this run under the keys of the last one."""
    table = TABLES[name]
    known = _dictionary(load, base, mart, name)
    rows = dimensions.unkeyed_dimension(name, tables, snapshot)
    load.write(None, f"ordered/{name}-known", rows.join(known, table.natural_key, "left"))
    placed = load.spark.read.parquet(load.path("ordered", f"{name}-known"))
    key = table.primary_key
    fresh = dense_key(placed.filter(F.col(key).isNull()).drop(key), "_n", dimensions.KEY_ORDER[name], load.path("ordered", name))
    fresh = fresh.withColumn(key, F.col("_n") + _highest(known, key)).drop("_n")
    every = placed.filter(F.col(key).isNotNull()).unionByName(fresh)
    written = write_checked(load, name, dimensions.declared(name, every))
    load.write(None, f"keys_{name}", known.unionByName(fresh.select(table.natural_key, key)))
    return written


def _keep_history(load: Load, base: str, mart: Mart, name: str, now: DataFrame, snapshot: dt.date) -> None:
    """The versions of a dimension's members up to this run; the first run on the way here had the first ones."""
    key, attributes = TABLES[name].natural_key, HISTORY[name]
    if path_exists(load.spark, f"{load.root}/runs/{base}/history_{name}"):
        before = open_history(load.spark, load.root, base, name)
    else:
        before = first_versions(mart[name], key, attributes)
    at = dt.datetime.combine(snapshot, dt.time())
    load.write(None, f"history_{name}", merge_versions(before, now, key, attributes, at))


def open_history(spark: SparkSession, root: str, run_id: str, name: str) -> DataFrame:
    """(natural key, attributes, valid_from, valid_to) of a dimension's members, as an incremental run stored it."""
    declared = TABLES[name].schema
    kept = [declared[c] for c in [TABLES[name].natural_key, *HISTORY[name]]]
    times = [StructField(c, TimestampNTZType()) for c in (VALID_FROM, VALID_TO)]
    return spark.read.schema(StructType([*kept, *times])).parquet(f"{root.rstrip('/')}/runs/{run_id}/history_{name}")


def _load_fact(load: Load, base: str, mart: Mart, name: str, tables: Mapping[str, DataFrame]) -> list[tuple]:
    """Write the months that changed; returns the rows of the months table."""
    table, key = TABLES[name], TABLES[name].primary_key
    started = dt.datetime.now(dt.UTC)
    held = {r.month: r for r in _months(load, base).filter(F.col("table") == name).collect()}
    before = {m: (r["rows"], r.x, r.y) for m, r in held.items()}
    if not before:
        before = _collected(_checksums(mart[name], _fact_columns(name), F.col(MONTH)))
    # written once: the checksums, the changed months and the rows set aside read it
    joined = load.write(None, f"ordered/{name}-joined", joined_rows(load, name, tables)[0])
    plan = facts.with_measures(name, joined)
    now, aside_now = _now(name, plan)
    aside = facts.ORPHAN_TABLE.get(name)
    aside_before = {}
    if aside:
        aside_before = _collected(_checksums(mart[aside], [f.name for f in ORPHANS[aside]], _aside_month(name)))
    touched = [m for m in sorted({*now, *before}) if now.get(m) != before.get(m)]
    aside_touched = [m for m in sorted({*aside_now, *aside_before}) if aside_now.get(m) != aside_before.get(m)]
    highest = max([r.highest for r in held.values()], default=0) or _highest(mart[name], key)

    month = date_month(F.col("date_key"))
    if touched:
        known = mart[name].filter(F.col(MONTH).isin(touched)).select(table.natural_key, key)
        rows = plan.filter(~F.col(facts.ORPHAN) & month.isin(touched)).join(known, table.natural_key, "left")
        load.write(None, f"ordered/{name}-known", rows)
        placed = load.spark.read.parquet(load.path("ordered", f"{name}-known"))
        order = ["date_key", table.natural_key]
        fresh = dense_key(placed.filter(F.col(key).isNull()).drop(key), "_n", order, load.path("ordered", name))
        fresh = fresh.withColumn(key, F.col("_n") + highest).drop("_n")
        every = placed.filter(F.col(key).isNotNull()).unionByName(fresh)
        stored = facts.stored_fact(name, every.repartitionByRange(*order).sortWithinPartitions(*order))
        written = write_checked(load, name, stored)
        highest = max(highest, _highest(written, key))
    else:
        load.note("fact", name, 0, started, "no month changed")
    if aside:
        fresh = facts.set_aside(name, plan.filter(F.col(facts.ORPHAN) & month.isin(aside_touched)))
        old = mart[aside].filter(~_aside_month(name).isin(aside_touched))
        load.write(None, aside, old.unionByName(fresh) if aside_touched else old)
    run_of = {m: held[m].run_id if m in held else base for m in now if m not in touched}
    return [(name, m, run_of.get(m, load.run_id), *sums, highest) for m, sums in now.items()]


def _months(load: Load, run: str) -> DataFrame:
    path = f"{load.root}/runs/{run}/months"
    if path_exists(load.spark, path):
        return load.spark.read.schema(MONTHS).parquet(path)
    return load.spark.createDataFrame([], MONTHS)


def _measured(load: Load, mart: Mart, name: str) -> None:
    """What a full load observes while it writes a fact, from one scan of all its months."""
    table = TABLES[name]
    counts = {**null_counts(table), **rule_counts(name), **FACT_TOTALS.get(name, {})}
    row = mart[name].agg(F.count("*").alias("rows"), *(F.expr(text).alias(k) for k, text in counts.items())).head()
    load.metrics[name] = row.asDict()


def _attempt(spark: SparkSession, sources: Mapping[str, SourceFrame], root: str, base: str, snapshot: dt.date, strict: bool, publish: bool) -> LoadResult:
    load = new_load(spark, root)
    mart = open_run(spark, load.root, base)
    try:
        with bounded_writes(spark):
            staged = together(spark, {s.staging: lambda n=n: stage(load, n, sources[n], strict) for n, s in SOURCES.items()})
        jobs = {"dim_date": lambda: load_calendar(load)}
        jobs |= {
            name: lambda name=name: _load_dimension(load, base, mart, name, staged, snapshot) for name in dimensions.READS
        }
        tables = staged | together(spark, jobs)
        steps = {name: lambda name=name: _load_fact(load, base, mart, name, {t: tables[t] for t in facts.READS[name]}) for name in facts.READS}
        kept = {f"history_{name}": lambda name=name: _keep_history(load, base, mart, name, tables[name], snapshot) for name in HISTORY}
        made = together(spark, steps | kept)
    except Exception:
        load.save_log()
        raise
    rows = [row for name in facts.READS for row in made[name]]
    spark.createDataFrame(rows, MONTHS).coalesce(1).write.parquet(load.path("months"))
    now = open_run(spark, load.root, load.run_id)
    together(spark, {name: lambda name=name: _measured(load, now, name) for name in facts.READS})
    return finish(load, now, publish, lambda: _claimed(load, base))


def _claimed(load: Load, base: str) -> None:
    if not claim(load.spark, f"{load.root}/claims/after-{base}"):
        raise Overtaken(f"another load was published on run {base}")


def run_incremental(
    spark: SparkSession,
    sources: Mapping[str, SourceFrame],
    root: str,
    snapshot: dt.date = SNAPSHOT_DATE,
    strict_sources: bool = True,
    publish_failed_checks: bool = False,
) -> LoadResult:
    """As ``run_load``, on top of the last published run; a full load if there is none."""
    for _ in range(ATTEMPTS):
        base = latest_run(spark, root)
        if base is None:
            return run_load(spark, sources, root, snapshot, strict_sources, publish_failed_checks)
        try:
            return _attempt(spark, sources, root, base, snapshot, strict_sources, publish_failed_checks)
        except Overtaken:
            continue
    raise Overtaken(f"{ATTEMPTS} other loads were published below {root} meanwhile")


def months_written(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """(table, months, written): the months of each fact of an incremental run, and how many of them it wrote."""
    months = spark.read.schema(MONTHS).parquet(f"{root.rstrip('/')}/runs/{run_id}/months")
    return months.groupBy("table").agg(
        F.count("*").alias("months"), F.count_if(F.col("run_id") == run_id).alias("written")
    )


__all__ = ["Overtaken", "months_written", "open_history", "run_incremental"]
