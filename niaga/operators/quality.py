"""Data-quality checks over staging and mart: the 17-check suite and its row-level queries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from niaga.operators.constraints import duplicate_keys, sql_over
from niaga.schemas import TABLES

_UNION_ALL = "\nUNION ALL\n"

# Names of the checks and labels of their numbers.
# (check, staging table, mart table)
ROW_COUNTS = (
    ("row_count_customer_staging_vs_dim", "stg_crm_user_profiles", "dim_customer"),
    ("row_count_product_staging_vs_dim", "stg_mdm_products", "dim_product"),
    ("row_count_orders_staging_vs_fact", "stg_oms_orders", "fact_orders"),
    ("row_count_inventory_staging_vs_fact", "stg_wms_inventory_movements", "fact_inventory_movements"),
    ("row_count_clickstream_staging_vs_fact", "stg_web_clickstream_logs", "fact_web_clickstream"),
)

# (check, table, condition that no row may meet, label of the count)
RULES = (
    ("fk_integrity_fact_orders_customer", "fact_orders", "customer_key IS NULL", "orphan_rows"),
    ("fk_integrity_fact_orders_product", "fact_orders", "product_key IS NULL", "orphan_rows"),
    ("fk_integrity_fact_orders_payment", "fact_orders", "payment_method_key IS NULL", "orphan_rows"),
    ("fk_integrity_fact_inventory_product", "fact_inventory_movements", "product_key IS NULL", "orphan_rows"),
    ("fk_integrity_fact_inventory_warehouse", "fact_inventory_movements", "warehouse_key IS NULL", "orphan_rows"),
    ("fk_integrity_fact_clickstream_page", "fact_web_clickstream", "page_key IS NULL", "orphan_rows"),
    ("fk_integrity_fact_clickstream_device", "fact_web_clickstream", "device_key IS NULL", "orphan_rows"),
    ("business_rule_no_negative_revenue", "fact_orders", "gross_revenue_idr < 0", "negative_rows"),
    ("business_rule_positive_quantity", "fact_orders", "quantity <= 0", "invalid_rows"),
    ("business_rule_non_negative_margin", "dim_product", "margin_idr < 0", "negative_margin_products"),
)

# (check, table, key, label of the count)
UNIQUE = (
    ("uniqueness_fact_orders_order_id", "fact_orders", "order_id", "duplicate_order_id"),
    ("uniqueness_dim_customer_user_id", "dim_customer", "user_id", "duplicate_user_id"),
)


def rule_counts(table: str) -> dict[str, str]:
    """Check name -> aggregate that counts offending rows of one table."""
    return {check: f"count_if({bad})" for check, of, bad, _ in RULES if of == table}


def _measures() -> tuple[str, set[str]]:
    """SQL for every number the suite compares, from one aggregate per table.

    Rows are (check_name, label, loaded, expected); a row-count check has one
    row for each side.
    """
    tables: dict[str, list[tuple[str, str, str, str]]] = {}
    for check, staging, loaded in ROW_COUNTS:
        tables.setdefault(staging, []).append((check, loaded, "count(*)", "expected"))
        tables.setdefault(loaded, []).append((check, loaded, "count(*)", "loaded"))
    for check, table, _, label in RULES:
        tables.setdefault(table, []).append((check, label, rule_counts(table)[check], "loaded"))

    statements = []
    for table, entries in tables.items():
        counts = ", ".join(f"{count} AS m{i}" for i, (_, _, count, _) in enumerate(entries))
        rows = ", ".join(
            f"'{check}', '{label}', "
            + (f"m{i}, CAST(NULL AS BIGINT)" if side == "loaded" else f"CAST(NULL AS BIGINT), m{i}")
            for i, (check, label, _, side) in enumerate(entries)
        )
        statements.append(f"""
            SELECT stack({len(entries)}, {rows}) AS (check_name, label, loaded, expected)
            FROM (SELECT {counts} FROM {{{table}}})""")
    for check, table, key, label in UNIQUE:
        statements.append(f"""
            SELECT '{check}', '{label}', count_if(n > 1), CAST(NULL AS BIGINT)
            FROM (SELECT count(*) AS n FROM {{{table}}} GROUP BY {key})""")
    names = set(tables) | {table for _, table, _, _ in UNIQUE}
    folded = f"""
        SELECT check_name, label, max(loaded) AS loaded, max(expected) AS expected
        FROM ({_UNION_ALL.join(statements)}) GROUP BY check_name, label"""
    return folded, names


def grade(measures: DataFrame) -> DataFrame:
    """(check_name, label, loaded, expected) as (check_name, status, detail).

    A check without an expected number expects 0.
    """
    loaded, expected, label = F.col("loaded"), F.col("expected"), F.col("label")
    found = F.concat(label, F.lit("="), loaded.cast("string"))
    both = F.concat(F.lit("staging="), expected.cast("string"), F.lit(", "), found)
    passed = loaded == F.coalesce(expected, F.lit(0))
    return measures.select(
        "check_name",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        F.when(expected.isNull(), found).otherwise(both).alias("detail"),
    )


def dq_suite(mart: Mapping[str, DataFrame]) -> DataFrame:
    """17 checks as (check_name, status, detail)."""
    return grade(sql_over(mart, *_measures()))


def observed_suite(
    spark: SparkSession,
    rows: Mapping[str, int],
    offending: Mapping[str, int],
    duplicates: Mapping[tuple[str, str], int],
) -> DataFrame:
    """The same 17 checks from numbers observed while the tables were written.

    ``rows`` counts each table, ``offending`` each rule, ``duplicates`` each
    (table, key); all are single numbers, so nothing is scanned again.
    """
    measures = [(check, loaded, rows[loaded], rows[staged]) for check, staged, loaded in ROW_COUNTS]
    measures += [(check, label, offending[check], None) for check, _, _, label in RULES]
    measures += [(check, label, duplicates[table, key], None) for check, table, key, label in UNIQUE]
    schema = "check_name string, label string, loaded bigint, expected bigint"
    return grade(spark.createDataFrame(measures, schema))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- row-level queries: an empty result means valid data ---------------------------------


def dq1_row_counts(mart: Mapping[str, DataFrame]) -> DataFrame:
    # Names of the checks.
    pairs = (
        ("crm_vs_dim_customer", "stg_crm_user_profiles", "dim_customer"),
        ("mdm_vs_dim_product", "stg_mdm_products", "dim_product"),
        ("oms_vs_fact_orders", "stg_oms_orders", "fact_orders"),
        ("wms_vs_fact_inventory", "stg_wms_inventory_movements", "fact_inventory_movements"),
        ("web_vs_fact_clickstream", "stg_web_clickstream_logs", "fact_web_clickstream"),
    )
    text = _UNION_ALL.join(
        f"SELECT '{check}' AS check_name, (SELECT count(*) FROM {{{staging}}}) AS staging_count,"
        f" (SELECT count(*) FROM {{{loaded}}}) AS mart_count"
        for check, staging, loaded in pairs
    )
    return sql_over(mart, text, [t for _, *tables in pairs for t in tables])


def _without_key(mart: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Fact rows that lack a dimension key they must have, with their natural key."""
    table = TABLES[name]
    keys = [
        fk.column
        for fk in table.foreign_keys
        if fk.parent != "dim_date" and fk.column not in table.nullable
    ]
    missing = reduce(lambda a, b: a | b, (F.col(key).isNull() for key in keys))
    return mart[name].select(table.natural_key, *keys).where(missing)


def dq2_orders_null_fk(mart: Mapping[str, DataFrame]) -> DataFrame:
    return _without_key(mart, "fact_orders")


def dq3_moves_null_fk(mart: Mapping[str, DataFrame]) -> DataFrame:
    return _without_key(mart, "fact_inventory_movements")


def dq4_clicks_null_fk(mart: Mapping[str, DataFrame]) -> DataFrame:
    return _without_key(mart, "fact_web_clickstream")


def dq5_duplicates(mart: Mapping[str, DataFrame]) -> DataFrame:
    keys = (
        ("dim_customer", "user_id"),
        ("dim_product", "product_id"),
        ("fact_orders", "order_id"),
    )
    return _union(
        [
            duplicate_keys(mart[table], column)
            .where(F.col("rows") > 1)
            .select(
                F.lit(f"{table}.{column}").alias("kolom"),
                F.col("key").alias("nilai"),
                F.col("rows").alias("jumlah"),
            )
            for table, column in keys
        ]
    )


def dq6_order_rules(mart: Mapping[str, DataFrame]) -> DataFrame:
    return (
        mart["fact_orders"]
        .select("order_id", "quantity", "gross_revenue_idr")
        .where((F.col("quantity") <= 0) | (F.col("gross_revenue_idr") < 0))
    )


def dq7_margin_range(mart: Mapping[str, DataFrame]) -> DataFrame:
    return (
        mart["dim_product"]
        .select("product_id", "margin_idr", "margin_pct")
        .where((F.col("margin_pct") < 0) | (F.col("margin_pct") > 100))
    )


def dq8_date_fk(mart: Mapping[str, DataFrame]) -> DataFrame:
    return (
        mart["fact_orders"]
        .select("order_id", "date_key")
        .join(mart["dim_date"].select("date_key"), "date_key", "left_anti")
        .select("order_id", "date_key")
    )


def audit_ranks(mart: Mapping[str, DataFrame]) -> DataFrame:
    """The steps that ``dq9_audit_history`` shows, numbered as they stand there and without their times."""
    latest = mart["etl_run_log"].orderBy(F.desc("run_id")).limit(20)  # so the window below sees 20 rows
    position = F.row_number().over(Window.orderBy(F.desc("run_id")))
    return latest.select(position.alias("position"), "step_name", "status", "row_count")


def dq9_audit_history(mart: Mapping[str, DataFrame]) -> DataFrame:
    return (
        mart["etl_run_log"]
        .orderBy(F.desc("run_id"))
        .limit(20)
        .select("step_name", "status", "row_count", "started_at", "finished_at")
    )
