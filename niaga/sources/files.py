"""CSV sources: header check by name, declared types, unusable rows set apart."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from niaga.lookups import NULL_TOKENS
from niaga.schemas import ARRIVAL, SOURCES, Source
from niaga.sources.records import broken_records


MALFORMED = "_malformed"
_MARK = "\x01"
SURPLUS = "surplus fields"  # the reason of a row with more fields than the header


class SourceError(ValueError):
    """A source that cannot be loaded: missing, empty or without a declared column."""


@dataclass(frozen=True)
class SourceFrame:
    """Typed rows of one source, with ``_arrival``, and the rows that could not be used.

    ``counted`` gives the same rows and lets an observation count the unusable
    ones (as ``rejected``) in the pass that reads them.
    """

    rows: DataFrame
    rejects: DataFrame | None = None
    counted: Callable[[Observation], DataFrame] | None = None


def _csv(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def _parse(column: str, type_name: str) -> Column:
    """Typed value of a text column, null where the text does not fit."""
    text = F.col(column)
    if type_name == "string":
        return text
    if type_name in ("int", "bigint"):
        # whole numbers may be written as 12.0; 12.5 is not one
        number = F.trim(text).try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number.try_cast(type_name))
    return F.trim(text).try_cast(type_name)


def _fields(record: Column, columns: int, multi_line: bool) -> Column:
    """The cells of a record's text, with a mark behind the last one."""
    wider = ", ".join(f"f{i} string" for i in range(columns + 1))
    return F.from_csv(F.concat(record, F.lit(f",{_MARK}")), wider, {"quote": '"', "escape": '"', "multiLine": str(multi_line)})


def _surplus(fields: Column, columns: int) -> Column:
    """Whether there are more cells than columns, also where the surplus one is empty: then the mark lies beyond the columns."""
    return ~F.coalesce(F.array_contains(F.array(*(fields[f"f{i}"] for i in range(columns + 1))), _MARK), F.lit(False))


def _lines(spark: SparkSession, path: str, header: list[str], multi_line: bool) -> DataFrame:
    """The columns of the files, read by Spark's reader: a record for each line, or files read whole."""
    as_text = [StructField(c, StringType()) for c in header]
    # enforceSchema=false checks the header of every file against the first one
    raw = (
        _csv(spark, multi_line)
        .schema(StructType([*as_text, StructField(MALFORMED, StringType())]))
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("enforceSchema", False)
        .csv(path)
    )
    # The reader sets aside the text of rows with too few or too many fields, and would cut the latter.
    fields = _fields(F.regexp_replace(MALFORMED, "[\r\n]+$", ""), len(header), multi_line)
    arrival = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    surplus = F.when(F.col(MALFORMED).isNotNull() & _surplus(fields, len(header)), F.col(MALFORMED))
    return raw.select(*(F.col(f"`{c}`") for c in header), arrival.alias(ARRIVAL), surplus.alias(MALFORMED))


def _records(records: DataFrame, tops: DataFrame, header: list[str]) -> DataFrame:
    """The columns of records that may hold line breaks, without the first line of each file, its header."""
    # headers are checked as the reader does it
    top = _fields(F.regexp_replace("top", "\r$", ""), len(header), True)
    same = ~_surplus(top, len(header))
    for i, c in enumerate(header):
        same = same & F.lower(top[f"f{i}"]).eqNullSafe(F.lower(F.lit(c)))
    if (other := tops.filter(~same).select("file").head()) is not None:
        raise SourceError(f"another header than that of the first file: {other.file}")
    rows = records.join(tops.select("file", "at"), "file").filter((F.col("block") != 0) | (F.col("pos") != F.col("at")))
    rows = rows.withColumn("record", F.regexp_replace("record", "\r$", "")).filter(F.trim("record") != "")
    rows = rows.withColumn("_fields", _fields(F.col("record"), len(header), True))
    cell = lambda i: F.col(f"_fields.f{i}")
    arrival = F.struct(F.col("name").alias("file"), "block", F.col("pos").alias("position"))
    bad = F.when(F.col("unclosed") | _surplus(F.col("_fields"), len(header)), F.col("record"))
    return rows.select(
        *(F.when(cell(i) != _MARK, cell(i)).alias(c) for i, c in enumerate(header)), arrival.alias(ARRIVAL), bad.alias(MALFORMED)
    )


def read_csv(
    spark: SparkSession,
    name: str,
    path: str,
    null_tokens: tuple[str, ...] = NULL_TOKENS,
    multi_line: bool = False,
) -> SourceFrame:
    """One CSV source (a file or a folder of files) as declared columns.

    Quoted cells may hold line breaks, and a file is still read by many tasks: only files that have such cells
    are put together from their lines (``records``). ``multi_line`` has each file read whole by one task instead, for
    files that end their lines otherwise.

    Columns are bound by header name, so their order is free and extra ones are
    ignored. ``_arrival`` holds (file name, block, position), which orders rows
    as they stand in the files however the scan was split. It is shuffled with
    every row, so it holds the name of the file, not its path.
    """
    source = SOURCES[name]
    try:
        header = _csv(spark, multi_line).csv(path).columns
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise SourceError(f"source '{name}' not found: {path}") from error
        raise
    missing = [f.name for f in source.schema if f.name not in header]
    if missing and not header:
        raise SourceError(f"source '{name}' is empty: {path}")
    if missing:
        raise SourceError(f"source '{name}' lacks columns: {', '.join(missing)}")

    broken = None if multi_line else broken_records(spark, path)
    raw = _records(*broken, header) if broken else _lines(spark, path, header, multi_line)
    if not broken and raw.isEmpty():
        raise SourceError(f"source '{name}' is empty: {path}")
    text = raw.select(
        *(
            F.when(~F.col(f.name).isin(*null_tokens), F.col(f.name)).alias(f.name)
            for f in source.schema
        ),
        ARRIVAL,
        MALFORMED,
    )
    return split_rejects(source, text)


def split_rejects(source: Source, text: DataFrame) -> SourceFrame:
    """Type the text columns; set apart rows with a bad value, a required value missing or surplus fields.

    ``_malformed`` holds the text of a row with more fields than the header. None of its values can be
    trusted, as a stray separator may stand in any of them.
    """
    typed = {f.name: _parse(f.name, f.dataType.simpleString()) for f in source.schema}
    bad = []
    for field in source.schema:
        unreadable = F.col(field.name).isNotNull() & typed[field.name].isNull()
        if field.name in source.required:
            unreadable = typed[field.name].isNull()
        bad.append(F.when(unreadable, F.lit(field.name)))
    if MALFORMED not in text.columns:
        text = text.withColumn(MALFORMED, F.lit(None).cast("string"))
    reason = F.concat_ws(", ", F.when(F.col(MALFORMED).isNotNull(), F.lit(SURPLUS)), *bad)

    def usable(df: DataFrame) -> DataFrame:
        return df.where(reason == "").select(
            *(value.alias(name) for name, value in typed.items()), ARRIVAL
        )

    def counted(seen: Observation) -> DataFrame:
        return usable(text.observe(seen, F.count_if(reason != "").alias("rejected")))

    rejects = text.where(reason != "").select(
        reason.alias("bad_columns"), *(f.name for f in source.schema), F.col(MALFORMED).alias("record")
    )
    return SourceFrame(usable(text), rejects, counted)


def read_all(spark: SparkSession, paths: Mapping[str, str], **options) -> dict[str, SourceFrame]:
    """All five declared sources, from ``{source name: path}``."""
    unknown = set(paths) ^ set(SOURCES)
    if unknown:
        raise SourceError(f"sources missing or not declared: {', '.join(sorted(unknown))}")
    return {name: read_csv(spark, name, paths[name], **options) for name in SOURCES}


def export_csv(df: DataFrame, path: str) -> None:
    """Write a report or detail table as CSV with a header, one file per task."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
