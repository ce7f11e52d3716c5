"""Run queries in Spark and their SQL in DuckDB and compare the rows.

``python tests/compare.py [sf] [name ...]``
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark_df, con, sql: str) -> str | None:
    """None if names, types and rows agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(names, result.fetchall())
    got_names = spark_df.columns
    got = _rows(got_names, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} != {sorted(names)}"
    for name, kind in spark_df.dtypes:
        if SPARK_TYPES.get(kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected, strict=True):
        if a != b:
            return f"row {a} != {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from niaga.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    print("without oracle:", sorted(set(queries) - set(oracles)), "stray:", set(oracles) - set(queries))
    bad = 0
    for name in only or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name not in oracles:
                print(f"{name:28s} rows only: {df.count()}")
                continue
            problem = compare(df, con, oracles[name])
            rows = df.count() if problem is None else "-"
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", "-"
        bad += problem is not None
        print(f"{name:28s} {'ok' if problem is None else 'DIFF ' + problem} rows={rows} {time.time() - started:.2f}s")
        sys.stdout.flush()
    print("differences:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
