"""Full load: sources -> staging -> dimensions -> facts -> checks -> publish.

Every step is a table written below one run folder. Readers see a run only
after it is published, so a failed or repeated load never shows half a mart.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from niaga.operators import (
    BUCKET_BYTES,
    BUCKET_ROWS,
    MOST_BUCKETS,
    MOST_WRITERS,
    RANGE_ROWS,
    STORED,
    bucket_count,
    dense_key,
    dense_key_by_day,
    frequent_keys,
    range_count,
    staged_bounds,
    write_buckets,
)
from niaga.operators.constraints import (
    foreign_keys,
    natural_keys,
    null_counts,
    primary_keys,
    primary_keys_hold,
)
from niaga.operators.quality import RULES, observed_suite, rule_counts
from niaga.plans import dimensions, facts
from niaga.schemas import (
    ARRIVAL,
    AUDIT,
    CHECK_RESULT,
    LOADED_AT,
    MONTH,
    ORPHANS,
    SOURCES,
    TABLES,
    columns,
)
from niaga.sources import SourceFrame
from niaga.sources.files import SourceError

SNAPSHOT_DATE = dt.date(2026, 7, 1)  # default day up to which tenure is counted
_PUBLISHED = columns("run_id string, failed_checks int, published_at timestamp")
# months of the facts of an incremental run: where they are, the checksum of their rows, the highest key given so far
_SUM = DecimalType(38, 0)
MONTHS = StructType(
    [
        *columns("table string, month int, run_id string, rows bigint").fields,
        *(StructField(name, _SUM) for name in ("x", "y")),
        *columns("highest bigint").fields,
    ]
)


class ConstraintViolation(RuntimeError):
    """A declared key, NOT NULL or foreign key does not hold; the run is not published."""


class QualityFailure(RuntimeError):
    """A data-quality check failed."""


class Mart(Mapping[str, DataFrame]):
    """The tables of one run by name: staging, dimensions, facts, set-aside rows, audit."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def replaced(self, **tables: DataFrame) -> Mart:
        return Mart({**self._tables, **tables})


@dataclass
class Load:
    """One run while it is being written."""

    spark: SparkSession
    root: str
    run_id: str
    log: list[tuple] = field(default_factory=list)
    metrics: dict[str, dict] = field(default_factory=dict)
    failed_checks: list[str] = field(default_factory=list)
    notes: dict[str, str] = field(default_factory=dict)  # details of these checks
    dealt: dict[str, tuple[DataFrame, int]] = field(default_factory=dict)  # tables stored in buckets, and how many

    def path(self, *parts: str) -> str:
        return "/".join((self.root, "runs", self.run_id, *parts))

    def write(
        self,
        layer: str | None,
        name: str,
        df: DataFrame,
        measures: Mapping[str, Column] | None = None,
        partition_by: str | None = None,
        buckets: tuple[str, int] | None = None,
    ) -> DataFrame:
        """Write one table, logged if it has a layer; counts and measures come from the write.

        With ``buckets`` (a column and a number above 0) the files are dealt by that column: ``dealt`` has the frame that
        needs no shuffle by it. The files are plain ones to every other reader.
        """
        started = dt.datetime.now(dt.UTC)
        seen = Observation(f"{self.run_id}:{name}")
        wanted = {"rows": F.count(F.lit(1)), **(measures or {})}
        watched = df.observe(seen, *(m.alias(k) for k, m in wanted.items()))
        writer = watched.write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        try:
            if buckets and buckets[1]:
                self.dealt[name] = write_buckets(watched, *buckets, self.path(name)), buckets[1]
            else:
                writer.options(**STORED).parquet(self.path(name))
        except Exception as error:
            self._log(layer, name, "FAILED", None, started, type(error).__name__)
            raise
        self.metrics[name] = seen.get
        self._log(layer, name, "SUCCESS", seen.get["rows"], started, "")
        return self.read(name, df.schema)

    def read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def _log(
        self, layer: str | None, name: str, status: str, rows: int | None, started: dt.datetime, notes: str
    ) -> None:
        if layer:
            finished = dt.datetime.now(dt.UTC)
            self.log.append((f"{layer}::{name}", status, rows, started, finished, notes))

    def note(self, layer: str, name: str, rows: int, started: dt.datetime, notes: str) -> None:
        """Log a step that wrote nothing."""
        self._log(layer, name, "SUCCESS", rows, started, notes)

    @staticmethod
    def schema_of_keys(name: str) -> StructType:
        table = TABLES[name]
        return StructType([table.schema[table.natural_key], table.schema[table.primary_key]])

    def save_log(self) -> None:
        """Append the rows of this run to the audit table.

        Their ids are the time of the load, some random bits and the step, so that no
        earlier id is read and two loads on one root share none; they rise with time.
        """
        path = f"{self.root}/etl_run_log"
        started = dt.datetime.strptime(self.run_id[:21], "%Y%m%dT%H%M%S%f").replace(tzinfo=dt.UTC)
        micros = (started - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)
        base = (micros << 12) | (int(self.run_id[-2:], 16) >> 1 << 5)
        steps = [f"staging::{s.staging}" for s in SOURCES.values()]
        steps += [f"{'fact' if t.is_fact else 'dimension'}::{t.name}" for t in TABLES.values()]
        ranked = sorted(self.log, key=lambda r: steps.index(r[0]))
        rows = [(base + i, *r) for i, r in enumerate(ranked, start=1)]
        self.spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("append").parquet(path)


def create_logs(spark: SparkSession, root: str) -> None:
    """Empty audit and publication tables below a new root; existing ones stay."""
    for name, schema in (("etl_run_log", AUDIT), ("published", _PUBLISHED)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/{name}")


def together(spark: SparkSession, jobs: Mapping[str, Callable[[], object]]) -> dict:
    """Independent jobs submitted at once, so small ones fill idle executors."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {n: pool.submit(inheritable_thread_target(spark)(job)) for n, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}


# --- the three layers ---------------------------------------------------------------------


def _bytes(text: str) -> int:
    """A size as Spark's settings state it (``128m``, ``134217728b``)."""
    number = text.strip().lower().removesuffix("b")
    unit = "kmgtp".find(number[-1:]) + 1 if number else 0
    return int(number[:-1] if unit else number) << 10 * unit


@contextmanager
def bounded_writes(spark: SparkSession) -> Iterator[None]:
    """Tasks that write few months or buckets hold a file open for each, and sort their rows by file for more.

    Each open file has buffers and dictionaries for all its columns: a task that goes from one of a hundred files to another with each
    row takes three times as long as one that sorts. To sort in memory, tasks read no more of the sources than half a bucket holds.
    """
    read = "spark.sql.files.maxPartitionBytes"
    least = min(_bytes(spark.conf.get(read)), BUCKET_BYTES // 2)
    wanted = {"spark.sql.maxConcurrentOutputFileWriters": str(MOST_WRITERS), read: str(least)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _buckets(load: Load, name: str, source: SourceFrame) -> tuple[str, int] | None:
    """The natural key of the fact that a source is read for, and buckets for the size of its files."""
    for fact, (staging, *_) in facts.READS.items():
        if staging == SOURCES[name].staging:
            size = sum(file_size(load.spark, path) for path in source.rows.inputFiles())
            return TABLES[fact].natural_key, bucket_count(size, load.spark.sparkContext.defaultParallelism)
    return None


def stage(load: Load, name: str, source: SourceFrame, strict: bool) -> DataFrame:
    """Write one staging table. Unreadable rows go to a table of their own.

    They are counted in the pass that writes the others and read again only if
    there are any. They stop a strict load and are a failed check otherwise.
    """
    declared = SOURCES[name]
    unreadable = Observation(f"{load.run_id}:unreadable:{name}")
    rows = source.counted(unreadable) if source.counted else source.rows
    measures = {}
    if declared.event_time:
        ts = F.col(declared.event_time)
        measures = {"min_ts": F.min(ts), "max_ts": F.max(ts)}
    typed = rows.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.schema),
        ARRIVAL,
        F.current_timestamp().alias(LOADED_AT),
    )
    staged = load.write("staging", declared.staging, typed, measures, buckets=_buckets(load, name, source))
    rejected = unreadable.get["rejected"] if source.counted else 0
    if rejected:
        table = f"rejects_{declared.staging}"
        load.write(None, table, source.rejects)
        load.failed_checks.append(f"unreadable_rows_{name}")
        load.notes[f"unreadable_rows_{name}"] = f"{rejected} rows set aside in {table}"
        if strict:
            raise SourceError(f"{name}: {rejected} unreadable rows set aside in {load.path(table)}")
    return staged


def write_checked(load: Load, name: str, df: DataFrame, measures=None) -> DataFrame:
    """Write a mart table, counting nulls and offending rows in the same pass."""
    table = TABLES[name]
    counts = {**null_counts(table), **rule_counts(name), **(measures or {})}
    return load.write(
        "fact" if table.is_fact else "dimension",
        name,
        df,
        {key: F.expr(text) for key, text in counts.items()},
        partition_by=MONTH if table.is_fact else None,
    )


def load_calendar(load: Load) -> DataFrame:
    """``dim_date`` over the span the staging writes observed."""
    spans = [load.metrics[s.staging] for s in SOURCES.values() if s.event_time]
    first = min(m["min_ts"] for m in spans if m["min_ts"]).date()
    last = max(m["max_ts"] for m in spans if m["max_ts"]).date()
    days = dimensions.calendar(load.spark, first, last)
    return write_checked(load, "dim_date", dimensions.declared("dim_date", days))


def _load_dimension(load: Load, name: str, tables: dict[str, DataFrame], snapshot: dt.date) -> DataFrame:
    rows = dimensions.unkeyed_dimension(name, tables, snapshot)
    key, order = TABLES[name].primary_key, dimensions.KEY_ORDER[name]
    numbered = dense_key(rows, key, order, load.path("ordered", name))
    return write_checked(load, name, dimensions.declared(name, numbered))


FACT_TOTALS = {
    "fact_orders": {"total_revenue": "sum(gross_revenue_idr)"},
    "fact_inventory_movements": {"net_stock_change": "sum(signed_quantity)"},
}


def joined_rows(load: Load, name: str, tables: Mapping[str, DataFrame]) -> tuple[DataFrame, int, int]:
    """First rows of a fact with their dimension keys, the number of staged rows, and of ranges that tasks can hold."""
    staged = facts.READS[name][0]
    count = load.metrics[staged]["rows"]
    at_once = min(int(load.spark.conf.get("spark.sql.shuffle.partitions")), 2 * load.spark.sparkContext.defaultParallelism)
    ranges = range_count(count, at_once)
    frequent = frequent_keys(tables[staged], TABLES[name].natural_key, count)
    dealt, buckets = load.dealt.get(staged, (None, 0))
    if count > 2 * RANGE_ROWS * buckets:  # the files told less than there was
        dealt = None
    return facts.joined_fact(name, dict(tables), ranges, frequent, dealt), count, ranges


def _load_fact(load: Load, name: str, tables: dict[str, DataFrame]) -> None:
    rows, count, ranges = joined_rows(load, name, tables)
    numbered = dense_key_by_day(
        rows,
        TABLES[name].primary_key,
        facts.KEY_ORDER[name],
        staged_bounds(facts.staged_order(name, tables), count, ranges),
        [r.date_key for r in tables["dim_date"].select("date_key").collect()],
        load.path("ordered", name),
        buckets=ranges <= MOST_BUCKETS and count >= BUCKET_ROWS * ranges * load.dealt.get(facts.READS[name][0], (None, ranges))[1],
    )
    numbered = facts.with_measures(name, numbered)
    writes = {
        name: lambda: write_checked(
            load, name, facts.stored_fact(name, numbered), FACT_TOTALS.get(name)
        )
    }
    aside = facts.ORPHAN_TABLE.get(name)
    if aside:
        writes[aside] = lambda: load.write(None, aside, facts.set_aside(name, numbered))
    together(load.spark, writes)


def _build(
    load: Load, sources: Mapping[str, SourceFrame], snapshot: dt.date, strict_sources: bool
) -> None:
    """Write every table of the run, each as soon as the tables it reads are written.

    A failed step is logged before the error goes on.
    """
    written: dict[str, Future] = {}
    try:
        with bounded_writes(load.spark), ThreadPoolExecutor(len(SOURCES) + len(TABLES)) as pool:

            def start(name: str, job: Callable[[dict], object], reads: Iterable[str] = ()) -> None:
                def run():
                    return job({table: written[table].result() for table in reads})

                written[name] = pool.submit(inheritable_thread_target(load.spark)(run))

            for name, source in SOURCES.items():
                start(source.staging, lambda _, n=name: stage(load, n, sources[n], strict_sources))
            timed = [s.staging for s in SOURCES.values() if s.event_time]
            start("dim_date", lambda _: load_calendar(load), timed)
            for name, staging in dimensions.READS.items():
                start(name, lambda t, n=name: _load_dimension(load, n, t, snapshot), [staging])
            for name, reads in facts.READS.items():
                start(name, lambda t, n=name: _load_fact(load, n, t), [*reads, "dim_date"])
        for table in written.values():
            table.result()
    except Exception:
        load.save_log()
        raise


def _verify(load: Load, mart: Mart) -> list[str]:
    """Check constraints, then store the quality suite; returns the failed checks.

    Nulls and rules were counted while writing. Primary keys are compared as bitmaps, and
    counted one by one only if one does not hold. Natural and foreign keys need a shuffle
    each; each result is a row per declared constraint.
    """
    spark = load.spark
    found = together(
        spark,
        {
            "log": load.save_log,
            "pk": lambda: [] if primary_keys_hold(mart) else primary_keys(mart).collect(),
            "unique": lambda: natural_keys(mart).collect(),
            "fk": lambda: foreign_keys(mart).collect(),
        },
    )
    violations = {
        (r.table_name, r.constraint_name): r.violations
        for kind in ("pk", "unique", "fk")
        for r in found[kind]
    }
    for name, table in TABLES.items():
        for constraint in null_counts(table):
            violations[name, constraint] = load.metrics[name][constraint]
    broken = [f"{table} {rule}: {n}" for (table, rule), n in sorted(violations.items()) if n]
    if broken:
        raise ConstraintViolation(f"run {load.run_id} not published: {'; '.join(broken)}")

    suite = observed_suite(
        spark,
        rows={name: metrics["rows"] for name, metrics in load.metrics.items()},
        offending={check: load.metrics[table][check] for check, table, _, _ in RULES},
        duplicates={
            (t.name, t.natural_key): violations[t.name, f"unique({t.natural_key})"]
            for t in TABLES.values()
            if t.natural_key
        },
    )
    if load.failed_checks:  # what staging found stands with the others
        seen = [(name, "FAIL", load.notes[name]) for name in load.failed_checks]
        suite = suite.unionByName(spark.createDataFrame(seen, CHECK_RESULT))
    suite.coalesce(1).write.parquet(load.path("dq_results"))
    results = load.read("dq_results", CHECK_RESULT).where("status = 'FAIL'").collect()
    return sorted(r.check_name for r in results)


# --- entry points -------------------------------------------------------------------------


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    mart: Mart
    failed_checks: tuple[str, ...]
    metrics: Mapping[str, Mapping]


def run_load(
    spark: SparkSession,
    sources: Mapping[str, SourceFrame],
    root: str,
    snapshot: dt.date = SNAPSHOT_DATE,
    strict_sources: bool = True,
    publish_failed_checks: bool = False,
) -> LoadResult:
    """Build a whole mart below ``root`` and publish it.

    A broken constraint always stops the run. A failed quality check stops it
    too, unless ``publish_failed_checks`` says to publish and only report.
    """
    load = new_load(spark, root)
    _build(load, sources, snapshot, strict_sources)
    return finish(load, open_run(spark, load.root, load.run_id), publish_failed_checks)


def finish(
    load: Load, mart: Mart, publish_failed_checks: bool, before: Callable[[], None] | None = None
) -> LoadResult:
    """Check a run that is written, and publish it; ``before`` may refuse."""
    spark = load.spark
    failed = tuple(_verify(load, mart))
    if failed and not publish_failed_checks:
        raise QualityFailure(f"run {load.run_id} not published: {', '.join(failed)}")
    if before:
        before()
    row = [(load.run_id, len(failed), dt.datetime.now(dt.UTC))]
    published = spark.createDataFrame(row, _PUBLISHED).coalesce(1)
    published.write.mode("append").parquet(f"{load.root}/published")
    _remove(spark, load.path("ordered"))  # rows before they were numbered
    mart = mart.replaced(etl_run_log=audit(spark, load.root))  # list its new files
    return LoadResult(load.run_id, mart, failed, load.metrics)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def file_size(spark: SparkSession, path: str) -> int:
    files, place = _file_system(spark, path)
    return files.getFileStatus(place).getLen()


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that does not exist yet; False if another load was first."""
    files, place = _file_system(spark, path)
    files.mkdirs(place.getParent())
    return files.createNewFile(place)


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def new_load(spark: SparkSession, root: str) -> Load:
    load = Load(
        spark,
        root.rstrip("/"),
        f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}",
    )
    create_logs(spark, load.root)
    return load


def build_unpublished(
    spark: SparkSession, sources: Mapping[str, SourceFrame], root: str, snapshot: dt.date = SNAPSHOT_DATE
) -> Mart:
    """A whole mart that is neither checked nor published, to run queries and checks on."""
    load = new_load(spark, root)
    _build(load, sources, snapshot, strict_sources=True)
    load.save_log()
    return open_run(spark, load.root, load.run_id)


def audit(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(f"{root}/etl_run_log")


def open_run(spark: SparkSession, root: str, run_id: str) -> Mart:
    """The tables of one run. Schemas are declared, so no file is opened to infer them."""

    def table(name: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{root}/runs/{run_id}/{name}")

    tables = {s.staging: table(s.staging, s.schema) for s in SOURCES.values()}
    tables |= {t.name: table(t.name, t.stored_schema) for t in TABLES.values() if not t.is_fact}
    facts_at = _months_of(spark, root, run_id)
    for t in TABLES.values():
        if t.is_fact:
            tables[t.name] = _fact_of(spark, root, t.name, facts_at[t.name]) if facts_at else table(t.name, t.stored_schema)
    tables |= {name: table(name, schema) for name, schema in ORPHANS.items()}
    tables["etl_run_log"] = audit(spark, root)
    return Mart(tables)


def _months_of(spark: SparkSession, root: str, run_id: str) -> dict[str, dict[str, list[int]]] | None:
    """{fact: {run: its months}} of an incremental run (a row for each month of a fact), None for a full one."""
    path = f"{root}/runs/{run_id}/months"
    if not path_exists(spark, path):
        return None
    found: dict[str, dict[str, list[int]]] = {t.name: {} for t in TABLES.values() if t.is_fact}
    for r in spark.read.schema(MONTHS).parquet(path).select("table", "run_id", "month").collect():
        found[r.table].setdefault(r.run_id, []).append(r.month)
    return found


def _fact_of(spark: SparkSession, root: str, name: str, held: dict[str, list[int]]) -> DataFrame:
    """A fact whose months lie in several runs."""
    schema = TABLES[name].stored_schema
    parts = []
    for run, months in sorted(held.items()):
        base = f"{root}/runs/{run}/{name}"
        paths = [f"{base}/{MONTH}={m}" for m in sorted(months)]
        parts.append(spark.read.schema(schema).option("basePath", base).parquet(*paths))
    if not parts:
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The run published last below ``root``, not the one that started last."""
    root = root.rstrip("/")
    if not path_exists(spark, f"{root}/published"):
        return None
    runs = spark.read.schema(_PUBLISHED).parquet(f"{root}/published")
    return runs.agg(F.max_by("run_id", F.struct("published_at", "run_id"))).head()[0]


def open_latest(spark: SparkSession, root: str) -> Mart:
    """The mart published last below ``root``."""
    root = root.rstrip("/")
    run_id = latest_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"no published mart below {root}")
    return open_run(spark, root, run_id)
