"""Versions of dimension members over time, and what was valid when an event happened.

A history holds (key, attributes, valid_from, valid_to): one row for each change, and an end where a member was gone. Both operators are windows
over a key's own rows. No range join is planned: events and versions are sorted together, and the last version before an event is
carried along. Keys with very many events are cut into several sorted runs, each of which gets the key's (few) versions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM, VALID_TO = "valid_from", "valid_to"
BEGINNING = dt.datetime(1900, 1, 1)  # the first versions known are taken to have been valid before
RUN_EVENTS = 1_000_000  # events of a key sorted together (about)


def _time(at: dt.datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp_ntz")


def first_versions(rows: DataFrame, key: str, attributes: list[str], since: dt.datetime = BEGINNING) -> DataFrame:
    """The history of members that were never changed."""
    return rows.select(key, *attributes, _time(since).alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO))


def merge_versions(history: DataFrame, rows: DataFrame, key: str, attributes: list[str], at: dt.datetime | Column) -> DataFrame:
    """The history with the members as they are at a time that is not before its latest change.

    A changed member gets a new version, and its last one ends there; a member that is gone ends there; one that returns begins a new
    version; an unchanged one stays as it is. A second merge of the same rows at the same time changes nothing. Members without a
    key are left out. Two merges at one time leave the version of the later one.
    """
    state = F.struct(*attributes)
    now = rows.filter(F.col(key).isNotNull()).select(key, F.struct(state.alias("value")).alias("new"))
    last = Window.partitionBy(key).orderBy(F.desc(VALID_FROM))
    # only a member's last version can end now; earlier ones are passed on
    ranked = history.withColumn("_n", F.row_number().over(last)).withColumn("_last", F.struct(state.alias("value")))
    current = ranked.filter("_n = 1").drop("_n")
    both = current.join(now, key, "full")
    time = _time(at)
    valid = F.col("_last").isNotNull() & F.col(VALID_TO).isNull()
    same = valid & F.col("new").isNotNull() & F.col("_last.value").eqNullSafe(F.col("new.value"))
    ended = F.when(valid & ~same, time).otherwise(F.col(VALID_TO))
    replaced = ended.isNotNull() & (ended <= F.col(VALID_FROM))  # begun at this very time: nothing remains of it
    old = F.when(F.col("_last").isNotNull() & ~replaced, F.struct(F.col("_last.value").alias("value"), F.col(VALID_FROM).alias("a"), ended.alias("b")))
    begun = F.when(F.col("new").isNotNull() & ~same, F.struct(F.col("new.value").alias("value"), time.alias("a"), F.lit(None).cast("timestamp_ntz").alias("b")))
    made = both.select(key, F.explode(F.filter(F.array(old, begun), lambda v: v.isNotNull())).alias("v"))
    made = made.select(key, "v.value.*", F.col("v.a").alias(VALID_FROM), F.col("v.b").alias(VALID_TO))
    return ranked.filter("_n > 1").select(*made.columns).unionByName(made)


def as_of(events: DataFrame, history: DataFrame, key: str, time: str, attributes: list[str], run_events: int = RUN_EVENTS) -> DataFrame:
    """The events with the attributes valid at their time; null before the first version, in a gap, and without a key.

    A version is valid from ``valid_from`` up to, but not at, ``valid_to``.
    """
    counts = events.groupBy(key).count().filter(F.col("count") > run_events)
    runs = counts.select(key, F.ceil(F.col("count") / run_events).cast("int").alias("_runs"))  # hot keys only
    columns = [F.col(f"`{c}`") for c in events.columns]
    cut = events.select(F.struct(*columns).alias("_event"), key, F.col(time).alias("_at")).join(runs, key, "left")
    # a row without a key finds nothing, and is spread like the others
    spread = F.pmod(F.xxhash64("_event"), F.coalesce("_runs", F.when(F.col(key).isNull(), 4096), F.lit(1))).cast("int")
    cut = cut.select(key, spread.alias("_run"), "_at", F.lit(1).alias("_kind"), "_event", F.lit(None).alias("_version"))
    version = F.struct(*attributes, VALID_TO)
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_runs", F.lit(1)) - 1))
    told = history.filter(F.col(key).isNotNull()).select(key, F.col(VALID_FROM).alias("_at"), version.alias("_version")).join(runs, key, "left")
    told = told.select(key, each.alias("_run"), "_at", F.lit(0).alias("_kind"), F.lit(None).alias("_event"), "_version")
    kinds = {"_event": cut.schema["_event"].dataType, "_version": told.schema["_version"].dataType}
    cut = cut.withColumn("_version", F.col("_version").cast(kinds["_version"]))
    told = told.withColumn("_event", F.col("_event").cast(kinds["_event"]))
    order = Window.partitionBy(key, "_run").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = cut.unionByName(told).withColumn("_v", F.last("_version", True).over(order)).filter("_kind = 1")
    holds = F.col("_v").isNotNull() & F.coalesce(F.col("_at") < F.col(f"_v.{VALID_TO}"), F.lit(True)) & F.col(key).isNotNull()
    return seen.select("_event.*", *(F.when(holds, F.col(f"_v.{a}")).alias(a) for a in attributes))
