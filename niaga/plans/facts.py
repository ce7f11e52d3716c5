"""Fact plans: first row per natural key, dimension lookups, derived measures.

Each plan keeps rows whose user or product is unknown, flagged ``_orphan``, so
that one pass over the source yields both the fact and its set-aside rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.functions import date_key, date_month, whole_seconds
from niaga.lookups import MOVEMENT_DIRECTION, map_value
from niaga.operators import keep_first, lookup
from niaga.schemas import MONTH, ORPHANS, TABLES

ORPHAN = "_orphan"

# Surrogate keys follow time and then the natural key; orphans take no number.
# The same order clusters the rows by month for storage.
KEY_ORDER = {
    "fact_orders": (ORPHAN, "date_key", "order_id"),
    "fact_inventory_movements": (ORPHAN, "date_key", "movement_id"),
    "fact_web_clickstream": (ORPHAN, "date_key", "log_id"),
}
ORPHAN_TABLE = {
    "fact_orders": "orphan_orders",
    "fact_inventory_movements": "orphan_movements",
}


def _flag(status: str, name: str):
    return F.coalesce(F.col("status_order") == status, F.lit(False)).cast("int").alias(name)


def orders(rows: DataFrame, customer: DataFrame, product: DataFrame, payment: DataFrame) -> DataFrame:
    rows = lookup(rows, customer.select("user_id", "customer_key"), "user_id", "user_id", "order_id")
    rows = lookup(
        rows,
        product.select("product_id", "product_key", "harga_modal_idr", "harga_jual_idr"),
        "product_id",
        "product_id",
        "order_id",
    )
    rows = lookup(
        rows,
        payment.select("payment_method_code", "payment_method_key"),
        "metode_pembayaran",
        "payment_method_code",
        "order_id",
    )
    no_user, no_product = F.col("customer_key").isNull(), F.col("product_key").isNull()
    orphan = no_user | no_product
    return rows.select(
        orphan.alias(ORPHAN),
        "order_id",
        date_key(F.col("order_timestamp")).alias("date_key"),
        whole_seconds(F.col("order_timestamp")).alias("order_datetime"),
        "customer_key",
        "product_key",
        "payment_method_key",
        "status_order",
        F.col("jumlah_barang").alias("quantity"),
        F.col("harga_jual_idr").alias("unit_price_idr"),
        F.col("harga_modal_idr").alias("unit_cost_idr"),
        F.when(orphan, F.col("user_id")).alias("user_id"),
        F.when(orphan, F.col("product_id")).alias("product_id"),
    )


def order_measures(rows: DataFrame) -> DataFrame:
    quantity, price, cost = F.col("quantity"), F.col("unit_price_idr"), F.col("unit_cost_idr")
    return rows.select(
        "*",
        (quantity * price).alias("gross_revenue_idr"),
        (quantity * cost).alias("gross_cost_idr"),
        (quantity * price - quantity * cost).alias("gross_profit_idr"),
        _flag("Delivered", "is_delivered"),
        _flag("Cancelled", "is_cancelled"),
        _flag("Returned", "is_returned"),
        F.col("customer_key").isNull().alias("unknown_user"),
        F.col("product_key").isNull().alias("unknown_product"),
    )


def inventory_movements(rows: DataFrame, product: DataFrame, warehouse: DataFrame) -> DataFrame:
    rows = lookup(
        rows, product.select("product_id", "product_key"), "product_id", "product_id", "movement_id"
    )
    rows = lookup(
        rows,
        warehouse.select("warehouse_id", "warehouse_key"),
        "warehouse_id",
        "warehouse_id",
        "movement_id",
    )
    orphan = F.col("product_key").isNull()
    return rows.select(
        orphan.alias(ORPHAN),
        "movement_id",
        date_key(F.col("recorded_timestamp")).alias("date_key"),
        whole_seconds(F.col("recorded_timestamp")).alias("movement_datetime"),
        "product_key",
        "warehouse_key",
        "jenis_mutasi",
        "operator_id",
        F.col("kuantitas_perubahan").alias("quantity_change"),
        F.when(orphan, F.col("product_id")).alias("product_id"),
        F.when(orphan, F.col("warehouse_id")).alias("warehouse_id"),
    )


def movement_measures(rows: DataFrame) -> DataFrame:
    direction = map_value(F.col("jenis_mutasi"), MOVEMENT_DIRECTION, F.lit(0))
    return rows.select(
        "*",
        (F.col("quantity_change") * direction).alias("signed_quantity"),
        F.col("product_key").isNull().alias("unknown_product"),
    )


def web_clickstream(rows: DataFrame, customer: DataFrame, page: DataFrame, device: DataFrame) -> DataFrame:
    rows = lookup(rows, customer.select("user_id", "customer_key"), "user_id", "user_id", "log_id")
    rows = lookup(rows, page.select("page_url", "page_key"), "page_url", "page_url", "log_id")
    rows = lookup(
        rows,
        device.select("device_type_code", "device_key"),
        "device_type",
        "device_type_code",
        "log_id",
    )
    return rows.select(
        F.lit(False).alias(ORPHAN),  # hits of unknown users are kept, without a customer
        "log_id",
        date_key(F.col("hit_timestamp")).alias("date_key"),
        whole_seconds(F.col("hit_timestamp")).alias("hit_datetime"),
        "session_id",
        "customer_key",
        "page_key",
        "device_key",
        "ip_address",
        "response_time_ms",
    )


# Tables each fact reads.
READS = {
    "fact_orders": ("stg_oms_orders", "dim_customer", "dim_product", "dim_payment_method"),
    "fact_inventory_movements": ("stg_wms_inventory_movements", "dim_product", "dim_warehouse"),
    "fact_web_clickstream": ("stg_web_clickstream_logs", "dim_customer", "dim_page", "dim_device"),
}


def joined_fact(
    name: str,
    tables: dict[str, DataFrame],
    tasks: int | None = None,
    frequent: Sequence[str] = (),
    dealt: DataFrame | None = None,
) -> DataFrame:
    """First rows of fact ``name`` with their dimension keys: what is moved and stored while rows are numbered."""
    build = {
        "fact_orders": orders,
        "fact_inventory_movements": inventory_movements,
        "fact_web_clickstream": web_clickstream,
    }[name]
    staged, *dims = (tables[table] for table in READS[name])
    return build(keep_first(staged, TABLES[name].natural_key, tasks=tasks, frequent=frequent, dealt=dealt), *dims)


def with_measures(name: str, rows: DataFrame) -> DataFrame:
    """The columns that follow from others of the row."""
    derive = {"fact_orders": order_measures, "fact_inventory_movements": movement_measures}.get(name)
    return derive(rows) if derive else rows


def stored_fact(name: str, keyed: DataFrame) -> DataFrame:
    """Declared columns plus the month. The rows come in the order of their keys, so each file covers few days."""
    table = TABLES[name]
    return keyed.where(~F.col(ORPHAN)).select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema),
        date_month(F.col("date_key")).alias(MONTH),
    )


def staged_order(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """(day, natural key) of the staged rows of a fact."""
    staged = tables[READS[name][0]]
    times = {"fact_orders": "order_timestamp", "fact_inventory_movements": "recorded_timestamp"}
    return staged.select(date_key(F.col(times.get(name, "hit_timestamp"))), TABLES[name].natural_key)


def set_aside(name: str, keyed: DataFrame) -> DataFrame:
    """Rows left out of fact ``name``."""
    schema = ORPHANS[ORPHAN_TABLE[name]]
    return keyed.where(F.col(ORPHAN)).select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema)
    )
