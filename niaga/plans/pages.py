"""Interactive use of a mart: filters, ad-hoc SQL, filter choices, page queries.

A filter turns a mart into a smaller mart, on which every report runs as it is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from niaga.functions import date_key_of
from niaga.plans.pipeline import Mart
from niaga.plans.placement import chosen_codes, with_codes
from niaga.plans.reports import Tables, between_days, e2_category_risk_fixed
from niaga.plans.rollups import RolledUp, grouped, whole_months
from niaga.schemas import MONTH

Choices = Mapping[str, Sequence]

# Filter column -> (dimension that holds it, key that dimension shares with facts).
_FILTER_DIMENSION = {
    "kategori": ("dim_product", "product_key"),
    "kota": ("dim_customer", "customer_key"),
    "account_tier": ("dim_customer", "customer_key"),
    "payment_method_name": ("dim_payment_method", "payment_method_key"),
    "platform": ("dim_device", "device_key"),
    "warehouse_name": ("dim_warehouse", "warehouse_key"),
}


def apply_filters(
    mart: Mart, choices: Choices, days: tuple[dt.date, dt.date] | None = None
) -> Mart:
    """A mart restricted to the chosen values and date range; an empty choice is no filter.

    The predicates are put on the dimensions, and each fact that has the key is
    semi-joined to the rows left. ``status_order`` and the dates are columns of
    the fact itself and reach its scan, as do the codes of chosen values in a fact
    placed by them. Stored roll-ups are restricted alike, and
    left out where they lack a column that a filter needs.
    """
    chosen = {column: list(values) for column, values in choices.items() if values}
    status = chosen.pop("status_order", None)
    unknown = set(chosen) - set(_FILTER_DIMENSION)
    if unknown:
        raise ValueError(f"no such filter: {', '.join(sorted(unknown))}")

    kept = {}
    for column, values in chosen.items():
        dim, _key = _FILTER_DIMENSION[column]
        kept[dim] = kept.get(dim, mart[dim]).where(F.col(column).isin(values))
    codes = {column: chosen_codes(mart, column, values) for column, values in chosen.items()}

    def narrow(fact: str, rows: DataFrame) -> DataFrame | None:
        """Rows of a fact, or of a roll-up of it, under the filters; None if they lack a column of a filter."""
        have, wanted = set(rows.columns), set(mart[fact].columns)
        if days and "date_key" in have:
            rows = between_days(rows, *days)
        elif days and whole_months(*days):
            rows = rows.where(F.col(MONTH).between(*(date_key_of(day) // 100 for day in days)))
        elif days:
            return None
        if status and "status_order" in wanted:
            if "status_order" not in have:
                return None
            rows = rows.where(F.col("status_order").isin(status))
        for column, found in codes.items():
            rows = with_codes(rows, column, found)
        for dim in kept:
            key = next(k for d, k in _FILTER_DIMENSION.values() if d == dim)
            if key in have:
                rows = rows.join(kept[dim].select(key), key, "left_semi")
            elif key in wanted:
                return None
        return rows

    facts = ("fact_orders", "fact_inventory_movements", "fact_web_clickstream")
    smaller = mart.replaced(**kept, **{fact: narrow(fact, mart[fact]) for fact in facts})
    return mart.narrowed(smaller, narrow) if isinstance(mart, RolledUp) else smaller


def run_query(spark: SparkSession, mart: Mart, sql: str, args: dict | list | None = None) -> DataFrame:
    """A parameterised SELECT over the tables of a mart, by their names.

    The tables are bound to the statement by a WITH clause, not registered in the session, so marts do not shadow each
    other. The text is run as a subquery: a statement that is no query does not parse.
    """
    used = [name for name in mart if name in sql]
    tables = ", ".join(f"{name} AS (SELECT * FROM {{{name}}})" for name in used)
    query = sql.strip().rstrip(";").replace("{", "{{").replace("}", "}}") if used else sql.strip().rstrip(";")
    text = f"{f'WITH {tables} ' if used else ''}SELECT * FROM (\n{query}\n)"
    return spark.sql(text, args=args, **{name: mart[name] for name in used})


def get_distinct(mart: Tables, table: str, column: str) -> DataFrame:
    """Sorted distinct non-null values of a column: the choices of a filter."""
    values = mart[table].select(column).where(F.col(column).isNotNull()).distinct()
    return values.orderBy(column)


def distinct_values(mart: Tables) -> DataFrame:
    """The choices of every dashboard filter, as (column_name, value)."""
    choices = (
        ("dim_customer", "kota"),
        ("dim_customer", "account_tier"),
        ("dim_product", "kategori"),
        ("dim_warehouse", "warehouse_name"),
        ("dim_device", "platform"),
    )
    frames = [
        get_distinct(mart, table, column).select(
            F.lit(column).alias("column_name"), F.col(column).alias("value")
        )
        for table, column in choices
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.orderBy("column_name", "value")


def order_date_span(mart: Tables) -> DataFrame:
    """First and last calendar date that has an order."""
    used = mart["fact_orders"].select("date_key").distinct()
    return (
        mart["dim_date"]
        .join(used, "date_key", "left_semi")
        .agg(F.min("full_date").alias("min_d"), F.max("full_date").alias("max_d"))
    )


# --- page queries that are not reports ------------------------------------------------------


def sales_detail(mart: Tables) -> DataFrame:
    """Order rows with their dimension labels, for a detail table or CSV export."""
    return (
        mart["fact_orders"]
        .join(mart["dim_date"].select("date_key", "full_date"), "date_key")
        .join(mart["dim_product"].select("product_key", "nama_produk", "kategori"), "product_key")
        .join(mart["dim_customer"].select("customer_key", "nama_lengkap", "kota"), "customer_key")
        .join(
            mart["dim_payment_method"].select("payment_method_key", "payment_method_name"),
            "payment_method_key",
        )
        .select(
            "order_id",
            "full_date",
            "nama_lengkap",
            "kota",
            "nama_produk",
            "kategori",
            "payment_method_name",
            "status_order",
            "quantity",
            "gross_revenue_idr",
            "gross_profit_idr",
        )
    )


def customer_detail(mart: Tables) -> DataFrame:
    """Customers, for a detail table or CSV export."""
    return mart["dim_customer"].select(
        "user_id", "nama_lengkap", "kota", "account_tier", "signup_date", "tenure_days_as_of_load"
    )


def web_detail(mart: Tables) -> DataFrame:
    """Hits with their page and device."""
    return (
        mart["fact_web_clickstream"]
        .join(mart["dim_date"].select("date_key", "full_date"), "date_key")
        .join(mart["dim_page"].select("page_key", "page_url", "funnel_stage"), "page_key")
        .join(mart["dim_device"].select("device_key", "platform", "operating_system"), "device_key")
        .select(
            "log_id",
            "full_date",
            "session_id",
            "page_url",
            "funnel_stage",
            "platform",
            "operating_system",
            "response_time_ms",
        )
    )


def inventory_detail(mart: Tables) -> DataFrame:
    """Movements with their product and warehouse."""
    return (
        mart["fact_inventory_movements"]
        .join(mart["dim_date"].select("date_key", "full_date"), "date_key")
        .join(mart["dim_product"].select("product_key", "product_id", "nama_produk", "kategori"), "product_key")
        .join(
            mart["dim_warehouse"].select("warehouse_key", "warehouse_name", "warehouse_code"), "warehouse_key"
        )
        .select(
            "movement_id",
            "full_date",
            "product_id",
            "nama_produk",
            "kategori",
            "warehouse_name",
            "warehouse_code",
            "jenis_mutasi",
            "quantity_change",
            "signed_quantity",
        )
    )


def daily_sales(mart: Tables) -> DataFrame:
    daily = grouped(mart, "fact_orders", ["date_key"], ["gross_revenue_idr", "gross_profit_idr"])
    daily = daily.withColumnsRenamed({"gross_revenue_idr": "revenue", "gross_profit_idr": "profit"})
    return (
        daily.join(mart["dim_date"].select("date_key", "full_date"), "date_key")
        .select("full_date", "revenue", "profit")
        .orderBy("full_date")
    )


def signup_trend(mart: Tables) -> DataFrame:
    day = F.col("signup_date")
    month = F.make_date(F.year(day), F.month(day), F.lit(1))
    return (
        mart["dim_customer"]
        .groupBy(month.alias("signup_month"))
        .agg(F.count("*").alias("new_customers"))
        .orderBy("signup_month")
    )


def warehouse_volume(mart: Tables) -> DataFrame:
    per_site = grouped(mart, "fact_inventory_movements", ["warehouse_key"], ["n", "quantity_change"])
    return (
        per_site.join(
            mart["dim_warehouse"].select("warehouse_key", "warehouse_name"), "warehouse_key"
        )
        .groupBy("warehouse_name")
        .agg(F.sum("n").alias("movements"), F.sum("quantity_change").alias("units"))
        .orderBy("warehouse_name")
    )


def category_scatter(mart: Tables) -> DataFrame:
    """Revenue against defect units per category, each side counted once."""
    return e2_category_risk_fixed(mart).select(
        "kategori",
        F.col("total_revenue_idr").alias("revenue"),
        F.col("total_unit_rusak").alias("defect_units"),
    )
