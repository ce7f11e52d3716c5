"""Declared constraints as queries: violating rows, and one summary row per constraint.

The summaries are one SQL statement each, so that a statement over all ten
tables is analysed once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.schemas import AUDIT_KEY, TABLES, ForeignKey, Table


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Key values held by more than one row, and a null key."""
    counted = df.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("rows"))
    return counted.where((F.col("rows") > 1) | F.col("key").isNull())


def null_rows(df: DataFrame, table: Table) -> DataFrame:
    """Rows with a null in a NOT NULL column."""
    return df.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in table.not_null)))


def dangling_keys(fact: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Foreign-key values without a parent row, with how many rows hold them.

    Keys are counted before the anti join: the join then sees each key once,
    however many fact rows carry it.
    """
    used = (
        fact.where(F.col(fk.column).isNotNull())
        .groupBy(F.col(fk.column).alias("key"))
        .agg(F.count("*").alias("rows"))
    )
    known = parent.select(F.col(fk.parent_column).alias("key"))
    return used.join(known, "key", "left_anti")


def sql_over(tables: Mapping[str, DataFrame], text: str, names: Iterable[str]) -> DataFrame:
    """Run SQL in which ``{name}`` stands for a table of the mart."""
    used = {name: tables[name] for name in names}
    spark = next(iter(used.values())).sparkSession
    return spark.sql(text, **used)


def _unique(table: str, kind: str, column: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, '{kind}({column})' AS constraint_name,
               count_if(n > 1 OR k IS NULL) AS violations
        FROM (SELECT {column} AS k, count(*) AS n FROM {{{table}}} GROUP BY {column})"""


def _not_null(table: Table) -> str:
    counts = ", ".join(f"count_if({c} IS NULL) AS {c}" for c in table.not_null)
    pairs = ", ".join(f"'not_null({c})', {c}" for c in table.not_null)
    return f"""
        SELECT '{table.name}' AS table_name,
               stack({len(table.not_null)}, {pairs}) AS (constraint_name, violations)
        FROM (SELECT {counts} FROM {{{table.name}}})"""


def _foreign_key(table: Table, fk: ForeignKey) -> str:
    return f"""
        SELECT '{table.name}' AS table_name,
               'fk({fk.column}->{fk.parent})' AS constraint_name,
               coalesce(sum(n), 0) AS violations
        FROM (SELECT {fk.column} AS k, count(*) AS n FROM {{{table.name}}}
              WHERE {fk.column} IS NOT NULL GROUP BY {fk.column}) used
        LEFT ANTI JOIN {{{fk.parent}}} parent ON used.k = parent.{fk.parent_column}"""


def _primary_keys() -> list[str]:
    return [_unique(name, "pk", key) for name, key in [*((t.name, t.primary_key) for t in TABLES.values()), AUDIT_KEY]]


def _natural_keys() -> list[str]:
    return [_unique(t.name, "unique", t.natural_key) for t in TABLES.values() if t.natural_key]


def _foreign_keys() -> list[str]:
    return [_foreign_key(t, fk) for t in TABLES.values() for fk in t.foreign_keys]


def _summary(mart: Mapping[str, DataFrame], statements: list[str]) -> DataFrame:
    used = [name for name in [*TABLES, AUDIT_KEY[0]] if any(f"{{{name}}}" in s for s in statements)]
    return sql_over(mart, "\nUNION ALL\n".join(statements), used)


def primary_keys(mart: Mapping[str, DataFrame]) -> DataFrame:
    return _summary(mart, _primary_keys())


def primary_keys_hold(mart: Mapping[str, DataFrame]) -> bool:
    """Whether every primary key is unique and never null, without a shuffle of the keys.

    Tasks set a bit for each key in bitmaps of 32 768 keys, and only bitmaps are shuffled: for keys that lie together in
    their files, an eighth of a byte a row. As many bits as rows are proof.
    """

    def distinct(table: str, key: str) -> str:
        return f"""
            SELECT sum(rows) AS rows, sum(bitmap_count(bits)) AS keys
            FROM (SELECT count(*) AS rows, bitmap_construct_agg(bitmap_bit_position({key})) AS bits
                  FROM {{{table}}} GROUP BY bitmap_bucket_number({key}))"""

    checked = [*((t.name, t.primary_key) for t in TABLES.values()), AUDIT_KEY]
    text = "\nUNION ALL\n".join(distinct(*each) for each in checked)
    return all((r["rows"] or 0) == (r["keys"] or 0) for r in sql_over(mart, text, [t for t, _ in checked]).collect())


def natural_keys(mart: Mapping[str, DataFrame]) -> DataFrame:
    return _summary(mart, _natural_keys())


def not_null(mart: Mapping[str, DataFrame]) -> DataFrame:
    """One aggregate per table, unpivoted to a row per column."""
    return _summary(mart, [_not_null(t) for t in TABLES.values()])


def foreign_keys(mart: Mapping[str, DataFrame]) -> DataFrame:
    return _summary(mart, _foreign_keys())


def null_counts(table: Table) -> dict[str, str]:
    """Constraint name -> aggregate that counts its violations, to observe while writing."""
    return {f"not_null({c})": f"count_if({c} IS NULL)" for c in table.not_null}
