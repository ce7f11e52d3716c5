"""A mart with planted faults, on which the integrity queries are proven.

Every fault is an expression over the mart's own rows, in SQL that Spark and DuckDB read alike, so that the number of bad
rows grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

M = TypeVar("M", bound=Mapping[str, DataFrame])

# table -> column -> (rows that get another value, that value)
VALUES = {
    "dim_customer": {
        "user_id": [("customer_key % 223 = 2", "NULL")],
        "kota": [("customer_key % 227 = 3", "NULL")],
        "customer_key": [("customer_key % 229 = 4", "NULL")],
    },
    "dim_product": {
        "margin_pct": [("product_key % 89 = 1", "150.5"), ("product_key % 83 = 2", "-5.25")],
        "margin_idr": [("product_key % 83 = 2", "-10")],
        "kategori": [("product_key % 79 = 3", "NULL")],
    },
    "fact_orders": {
        "customer_key": [("order_key % 97 = 1", "NULL"), ("order_key % 127 = 7", "-1")],
        "product_key": [("order_key % 101 = 2", "NULL")],
        "payment_method_key": [("order_key % 103 = 3", "NULL"), ("order_key % 131 = 8", "99")],
        "quantity": [("order_key % 107 = 4", "0"), ("order_key % 139 = 5", "-3")],
        "gross_revenue_idr": [("order_key % 109 = 5", "-1")],
        "date_key": [("order_key % 113 = 6", "19000101")],
        "status_order": [("order_key % 149 = 9", "NULL")],
    },
    "fact_inventory_movements": {
        "product_key": [("movement_key % 97 = 1", "NULL"), ("movement_key % 127 = 7", "-1")],
        "warehouse_key": [("movement_key % 101 = 2", "NULL"), ("movement_key % 103 = 3", "999")],
        "date_key": [("movement_key % 113 = 6", "19000101")],
    },
    "fact_web_clickstream": {
        "page_key": [("click_key % 97 = 1", "NULL"), ("click_key % 103 = 3", "99")],
        "device_key": [("click_key % 101 = 2", "NULL")],
        "customer_key": [("click_key % 127 = 7", "-1")],
        "session_id": [("click_key % 107 = 4", "NULL")],
    },
}

# table -> rows that come twice
TWICE = {
    "dim_customer": "customer_key % 211 = 1",
    "dim_product": "product_key % 73 = 4",
    "dim_warehouse": "warehouse_key % 7 = 1",
    "dim_page": "page_key = 2",
    "fact_orders": "order_key % 137 = 10",
    "fact_inventory_movements": "movement_key % 137 = 10",
    "fact_web_clickstream": "click_key % 137 = 10",
}
LOGGED_TWICE = "staging::stg_crm_user_profiles"

# The queries that are registered on this mart, under their name and "_faulty".
CHECKED = (
    "dq_suite", "dq2_orders_null_fk", "dq3_moves_null_fk", "dq4_clicks_null_fk", "dq5_duplicates", "dq6_order_rules",
    "dq7_margin_range", "dq8_date_fk", "constraint_pk", "constraint_unique", "constraint_not_null", "constraint_fk",
)


def changed(column: str, cases: list[tuple[str, str]]) -> str:
    return f"CASE {' '.join(f'WHEN {rows} THEN {value}' for rows, value in cases)} ELSE {column} END"


def with_faults(mart: M) -> M:
    tables = {}
    for name in {*VALUES, *TWICE}:
        rows = mart[name]
        kinds = dict(rows.dtypes)
        bad = rows.withColumns({c: F.expr(f"CAST({changed(c, v)} AS {kinds[c]})") for c, v in VALUES.get(name, {}).items()})
        tables[name] = bad.unionByName(rows.where(TWICE[name])) if name in TWICE else bad
    log = mart["etl_run_log"]
    tables["etl_run_log"] = log.unionByName(log.where(F.col("step_name") == LOGGED_TWICE))
    return mart.replaced(**tables)
