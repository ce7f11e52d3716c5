"""Dimension plans. Those with a surrogate key get it from ``dense_key`` when loaded."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from niaga.functions import date_key, elapsed_days, title_case, whole_seconds
from niaga.lookups import (
    DAY_NAMES,
    FUNNEL_PAGES,
    MONTH_NAMES,
    OTHER_PAYMENT_CATEGORY,
    PAYMENT_METHODS,
    UNKNOWN_PAGE,
    map_value,
)
from niaga.operators import distinct_values, keep_first
from niaga.schemas import LOADED_AT, SOURCES, TABLES

MARGIN_DAYS = 3  # days the calendar extends beyond the data on each side


def date_span(staged: dict[str, DataFrame]) -> DataFrame:
    """Earliest and latest event over all sources that carry a time, as one row."""
    spans = []
    for source in SOURCES.values():
        if source.event_time:
            ts = F.col(source.event_time)
            spans.append(
                staged[source.staging].agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
            )
    union = spans[0]
    for span in spans[1:]:
        union = union.unionByName(span)
    return union.agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day from ``first`` to ``last``, both widened by the margin."""
    margin = dt.timedelta(days=MARGIN_DAYS)
    days = F.sequence(F.lit(first - margin), F.lit(last + margin), F.expr("interval 1 day"))
    day = F.col("full_date")
    weekday = F.weekday(day)  # Monday 0 .. Sunday 6
    return (
        spark.range(1)
        .select(F.explode(days).alias("full_date"))
        .select(
            date_key(day).alias("date_key"),
            day,
            F.dayofmonth(day).alias("day"),
            map_value(weekday, dict(enumerate(DAY_NAMES))).alias("day_name"),
            F.month(day).alias("month"),
            map_value(F.month(day), dict(enumerate(MONTH_NAMES, start=1))).alias("month_name"),
            F.quarter(day).alias("quarter"),
            F.year(day).alias("year"),
            F.weekofyear(day).alias("week_of_year"),
            (weekday >= 5).cast("int").alias("is_weekend"),
        )
    )


def customers(crm: DataFrame, snapshot: dt.date) -> DataFrame:
    signup = F.col("signup_timestamp")
    return keep_first(crm, "user_id").select(
        "user_id",
        "nama_lengkap",
        "email",
        "kota",
        "account_tier",
        F.to_date(signup).alias("signup_date"),
        whole_seconds(signup).alias("signup_datetime"),
        elapsed_days(signup, snapshot).alias("tenure_days_as_of_load"),
        F.current_timestamp().alias(LOADED_AT),
    )


def products(mdm: DataFrame) -> DataFrame:
    margin = F.col("harga_jual_idr") - F.col("harga_modal_idr")
    price = F.nullif(F.col("harga_jual_idr"), F.lit(0).cast("bigint"))
    percent = margin.cast("double") / price.cast("double") * 100
    return keep_first(mdm, "product_id").select(
        "product_id",
        "nama_produk",
        "kategori",
        "harga_modal_idr",
        "harga_jual_idr",
        margin.alias("margin_idr"),
        # half-even on the scaled double, as the published margins are rounded
        (F.rint(percent * 100) / 100).alias("margin_pct"),
        F.col("is_active").cast("int").alias("is_active"),
        F.current_timestamp().alias(LOADED_AT),
    )


def warehouses(wms: DataFrame) -> DataFrame:
    """``WH-JAKARTA-01`` gives name Jakarta and code 01."""
    code = F.col("warehouse_id")
    parts = F.split(code, "-")
    return distinct_values(wms, "warehouse_id").select(
        code,
        F.coalesce(title_case(F.get(parts, F.lit(1))), code).alias("warehouse_name"),
        F.coalesce(F.get(parts, F.lit(2)), F.lit("")).alias("warehouse_code"),
    )


def payment_methods(oms: DataFrame) -> DataFrame:
    code = F.col("metode_pembayaran")
    names = {k: v[0] for k, v in PAYMENT_METHODS.items()}
    categories = {k: v[1] for k, v in PAYMENT_METHODS.items()}
    return distinct_values(oms, "metode_pembayaran").select(
        code.alias("payment_method_code"),
        map_value(code, names, code).alias("payment_method_name"),
        map_value(code, categories, F.lit(OTHER_PAYMENT_CATEGORY)).alias("payment_category"),
    )


def devices(web: DataFrame) -> DataFrame:
    """``Mobile-Android`` gives platform Mobile and system Android (the rest after the first dash)."""
    code = F.col("device_type")
    dash = F.instr(code, "-")
    return distinct_values(web, "device_type").select(
        code.alias("device_type_code"),
        F.substring_index(code, "-", 1).alias("platform"),
        F.when(dash > 0, F.substr(code, dash + 1)).otherwise("").alias("operating_system"),
    )


def pages(web: DataFrame) -> DataFrame:
    url = F.col("page_url")
    stages = {k: v[0] for k, v in FUNNEL_PAGES.items()}
    positions = {k: v[1] for k, v in FUNNEL_PAGES.items()}
    return distinct_values(web, "page_url").select(
        url,
        map_value(url, stages, F.lit(UNKNOWN_PAGE[0])).alias("funnel_stage"),
        map_value(url, positions, F.lit(UNKNOWN_PAGE[1])).alias("funnel_order"),
    )


# Order that surrogate keys follow, per dimension.
KEY_ORDER = {
    "dim_customer": ["user_id"],
    "dim_product": ["product_id"],
    "dim_warehouse": ["warehouse_id"],
    "dim_payment_method": ["payment_method_code"],
    "dim_device": ["device_type_code"],
    "dim_page": ["funnel_order", "page_url"],
}


# Staging table each dimension reads.
READS = {
    "dim_customer": "stg_crm_user_profiles",
    "dim_product": "stg_mdm_products",
    "dim_warehouse": "stg_wms_inventory_movements",
    "dim_payment_method": "stg_oms_orders",
    "dim_device": "stg_web_clickstream_logs",
    "dim_page": "stg_web_clickstream_logs",
}


def unkeyed_dimension(name: str, staged: dict[str, DataFrame], snapshot: dt.date) -> DataFrame:
    """Dimension ``name`` without its surrogate key."""
    rows = staged[READS[name]]
    if name == "dim_customer":
        return customers(rows, snapshot)
    build = {
        "dim_product": products,
        "dim_warehouse": warehouses,
        "dim_payment_method": payment_methods,
        "dim_device": devices,
        "dim_page": pages,
    }[name]
    return build(rows)


def declared(name: str, df: DataFrame) -> DataFrame:
    """Columns of ``df`` in the declared order and types of table ``name``."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].schema))
