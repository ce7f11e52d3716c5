"""Every query by name, as a function of (session, folder of test tables)."""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from niaga.functions import date_key
from niaga.operators import constraints, quality
from niaga.operators.history import as_of, first_versions, merge_versions
from niaga.plans import dimensions, kpis, pages, reports
from niaga.plans.faults import CHECKED, with_faults
from niaga.plans.incremental import months_written, run_incremental
from niaga.plans.pipeline import LoadResult, Mart, build_unpublished, run_load
from niaga.plans.placement import store_placed
from niaga.plans.rollups import SKETCH_ERROR, RolledUp, sessions, store_rollups
from niaga.schemas import LOADED_AT, MONTH, ORPHANS, SOURCES, TABLES
from niaga.session import shared_root
from niaga.sources import SourceFrame, export_csv, read_csv, sample_sources

Query = Callable[[SparkSession, str], DataFrame]

SNAPSHOT = dt.date(2024, 2, 1)
CHANGES = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))  # when members of the dimensions change
HISTORY_READ = {"dim_product": ["harga_jual_idr"], "dim_customer": ["account_tier"]}
WINDOW = (dt.date(2024, 1, 1), dt.date(2024, 1, 30))

SALES_FILTER = {
    "kategori": ["ECONOMY", "PROMO", "STANDARD"],
    "kota": [f"NATION_{i}" for i in range(0, 25, 2)],
    "payment_method_name": ["OVO", "GoPay", "COD"],
    "status_order": ["Delivered", "Shipped", "Pending", "Returned"],
}
SALES_DAYS = (dt.date(2024, 1, 5), dt.date(2024, 1, 24))
CUSTOMER_FILTER = {"account_tier": ["Gold", "Platinum"], "kota": SALES_FILTER["kota"]}
WEB_FILTER = {"platform": ["Mobile"]}
STOCK_FILTER = {"warehouse_name": ["Asia", "Middle East"], "kategori": SALES_FILTER["kategori"]}

PARAM_QUERY = """
    SELECT c.kota, count(*) AS orders, sum(o.gross_revenue_idr) AS revenue
    FROM fact_orders o JOIN dim_customer c ON o.customer_key = c.customer_key
    WHERE c.account_tier = :tier AND o.date_key BETWEEN :first AND :last
    GROUP BY c.kota
    ORDER BY c.kota
"""

# Queries that need nothing but a mart.
REPORTS: dict[str, Callable[[Mart], DataFrame]] = {
    f.__name__: f
    for f in (
        quality.dq_suite,
        quality.dq9_audit_history,
        quality.dq1_row_counts,
        quality.dq2_orders_null_fk,
        quality.dq3_moves_null_fk,
        quality.dq4_clicks_null_fk,
        quality.dq5_duplicates,
        quality.dq6_order_rules,
        quality.dq7_margin_range,
        quality.dq8_date_fk,
        pages.distinct_values,
        pages.order_date_span,
        kpis.run_metrics,
        kpis.kpi_summary,
        kpis.kpi_margin,
        kpis.home_kpis,
        kpis.home_source_counts,
        kpis.fmt_kpi_labels,
        kpis.ins_dormant_share,
        kpis.ins_net_stock_by_wh,
        kpis.ins_platform_share,
        kpis.ins_slowest_page,
        kpis.ins_city_extremes,
        kpis.ins_fulfilment_rates,
        reports.a1_monthly_kpi,
        reports.a2_category_revenue,
        reports.a3_top_products,
        reports.a4_status_share,
        reports.a5_payment_pref,
        reports.a6_city_revenue,
        reports.b1_tier_segment,
        reports.b2_top_customers,
        reports.b3_dormant,
        reports.c1_funnel,
        reports.c2_page_latency,
        reports.c3_device_split,
        reports.c4_conversion,
        reports.d1_low_stock,
        reports.d2_movement_summary,
        reports.d3_top_defects,
        reports.e2_category_risk,
        reports.e2_category_risk_fixed,
        reports.chart_daily_revenue,
        reports.chart_category_revenue,
        reports.chart_status,
        reports.chart_payment,
        reports.chart_funnel,
        reports.chart_device,
        reports.chart_top_products,
        reports.chart_warehouse_pivot,
    )
}

# Reports that stored roll-ups answer without a scan of a fact.
ROLLED_UP = (
    "a1_monthly_kpi a2_category_revenue a3_top_products a4_status_share a5_payment_pref a6_city_revenue b1_tier_segment"
    " b2_top_customers b3_dormant c2_page_latency d1_low_stock d2_movement_summary d3_top_defects kpi_margin"
    " ins_fulfilment_rates ins_net_stock_by_wh ins_platform_share chart_daily_revenue chart_category_revenue chart_status"
    " chart_payment chart_device chart_top_products chart_warehouse_pivot"
).split()

_marts: dict[tuple[str, str], Mart] = {}
_loads: dict[tuple[str, str], tuple[LoadResult, LoadResult, str]] = {}
_rolled_up: dict[tuple[str, str], RolledUp] = {}
_placed: dict[tuple[str, str], Mart] = {}
_building = threading.Lock()


def mart_of(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart of one folder of test tables, loaded on first use in a session.

    It is written below the shared folder, as a load writes it; later queries
    scan those tables instead of repeating de-duplication and key lookups.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    with _building:
        if key not in _marts:
            folder = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
            root = f"{shared_root(spark)}/niaga/{key[0]}/{folder}"
            _marts[key] = build_unpublished(spark, sample_sources(spark, sf_dir), root, SNAPSHOT)
        return _marts[key]


def rolled_up(spark: SparkSession, sf_dir: str) -> RolledUp:
    """The same mart with roll-ups of its facts, stored on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    mart = mart_of(spark, sf_dir)
    with _building:
        if key not in _rolled_up:
            folder = f"{shared_root(spark)}/niaga/{key[0]}/rollups-{uuid.uuid4().hex}"
            _rolled_up[key] = store_rollups(spark, mart, folder)
        return _rolled_up[key]


def placed_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The same mart with its facts placed by the columns of the filters, stored on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    mart = mart_of(spark, sf_dir)
    with _building:
        if key not in _placed:
            _placed[key] = store_placed(spark, mart, f"{shared_root(spark)}/niaga/{key[0]}/placed-{uuid.uuid4().hex}")
        return _placed[key]


def use_mart(spark: SparkSession, sf_dir: str, mart: Mart) -> None:
    """Answer queries on ``sf_dir`` from a mart that is already loaded."""
    _marts[spark.sparkContext.applicationId, sf_dir] = mart


def _on_mart(report: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(mart_of(spark, sf_dir))


def _filtered(report: Callable[[Mart], DataFrame], choices, days=None) -> Query:
    return _on_mart(lambda m: report(pages.apply_filters(m, choices, days)))


def _staged(name: str) -> Query:
    names = [f.name for f in SOURCES[name].schema]
    return lambda spark, sf_dir: sample_sources(spark, sf_dir)[name].rows.select(*names)


def _table(name: str) -> Query:
    schema = TABLES[name].schema if name in TABLES else ORPHANS[name]
    names = [f.name for f in schema if f.name not in (LOADED_AT, MONTH)]
    return _on_mart(lambda m: m[name].select(*names))


def _span(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = {SOURCES[n].staging: s.rows for n, s in sample_sources(spark, sf_dir).items()}
    return dimensions.date_span(rows)


def _date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = sample_sources(spark, sf_dir)["web_clickstream_logs"].rows
    return hits.groupBy(date_key(F.col("hit_timestamp")).alias("date_key")).agg(
        F.count("*").alias("n")
    )


def _param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    args = {"tier": "Gold", "first": 20240105, "last": 20240124}
    return pages.run_query(spark, mart_of(spark, sf_dir), PARAM_QUERY, args)


def _narrow(m: Mart) -> DataFrame:
    report = reports.e2_category_risk(m)
    return report.select(*(F.col(c).cast("bigint").alias(c) if t.startswith("decimal") else c for c, t in report.dtypes))


def _line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose names hold line breaks, quotes and separators, written as CSV files and read back by many tasks."""
    names = [f.name for f in SOURCES["crm_user_profiles"].schema]
    broken = F.concat("nama_lengkap", F.lit('\n"'), "kota", F.lit('",\r\n'), "account_tier")
    people = sample_sources(spark, sf_dir)["crm_user_profiles"].rows.withColumn("nama_lengkap", broken)
    folder = f"{shared_root(spark)}/niaga/{spark.sparkContext.applicationId}/csv-{uuid.uuid4().hex}"
    export_csv(people.select(names), folder)
    return read_csv(spark, "crm_user_profiles", folder).rows.select(names)


def _spread_over_months(sources: dict[str, SourceFrame]) -> dict[str, SourceFrame]:
    """The sources with their orders moved by nought to four months, by the day of the month."""
    moved = F.col("order_timestamp") + F.make_ym_interval(F.lit(0), F.dayofmonth("order_timestamp") % 5)
    orders = sources["oms_orders"].rows.withColumn("order_timestamp", moved)
    return {**sources, "oms_orders": SourceFrame(orders)}


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[LoadResult, LoadResult, str]:
    """A load of the sources as they were, with other quantities on the 7th and without orders of the 8th, and one on top of it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _building:
        if key not in _loads:
            root = f"{shared_root(spark)}/niaga/{key[0]}/incremental-{uuid.uuid4().hex}"
            now = _spread_over_months(sample_sources(spark, sf_dir))
            day = F.dayofmonth("order_timestamp")
            orders = now["oms_orders"].rows
            old = orders.join(orders.filter(day != 8).select("order_id").distinct(), "order_id", "left_semi")
            old = old.withColumn("jumlah_barang", F.col("jumlah_barang") + (day == 7).cast("int"))
            first = run_load(spark, {**now, "oms_orders": SourceFrame(old)}, root, SNAPSHOT, publish_failed_checks=True)
            second = run_incremental(spark, now, root, SNAPSHOT, publish_failed_checks=True)
            _loads[key] = first, second, root
        return _loads[key]


def _incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of a mart after the second load, by natural keys."""
    m = _two_loads(spark, sf_dir)[1].mart
    return (
        m["fact_orders"]
        .join(m["dim_customer"].select("customer_key", "user_id"), "customer_key")
        .join(m["dim_product"].select("product_key", "product_id"), "product_key")
        .select("order_id", "date_key", "order_datetime", "user_id", "product_id", "status_order", "quantity", "gross_profit_idr")
    )


def _incremental_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each fact: rows, rows whose key the second load changed, months, and months that it wrote."""
    first, second, root = _two_loads(spark, sf_dir)
    counts = None
    for t in TABLES.values():
        if t.is_fact:
            before = first.mart[t.name].select(t.natural_key, F.col(t.primary_key).alias("before"))
            now = second.mart[t.name].select(t.natural_key, t.primary_key).join(before, t.natural_key, "left")
            changed = F.count_if(F.col("before") != F.col(t.primary_key)).alias("changed")
            row = now.agg(F.lit(t.name).alias("table"), F.count("*").alias("n"), changed)
            counts = row if counts is None else counts.unionByName(row)
    return counts.join(months_written(spark, root, second.run_id), "table")


def _changing(m: Mart, table: str, day: dt.datetime, step: int) -> DataFrame:
    """A dimension as it was from a day on: prices of every third product, or tiers of every fourth customer, differ."""
    rows = m[table]
    number = F.regexp_extract(TABLES[table].natural_key, "[0-9]+", 0).cast("long")
    if table == "dim_product":
        return rows.withColumn("harga_jual_idr", F.col("harga_jual_idr") + F.when(number % 3 == step, 1000 * step).otherwise(0))
    return rows.withColumn("account_tier", F.when(number % 4 == step, F.lit(f"Tier {step}")).otherwise(F.col("account_tier")))


def _histories(m: Mart) -> dict[str, DataFrame]:
    """The versions of products and customers after two changes."""
    found = {}
    for table, attributes in HISTORY_READ.items():
        key = TABLES[table].natural_key
        found[table] = first_versions(m[table], key, attributes)
        for step, day in enumerate(CHANGES, start=1):
            found[table] = merge_versions(found[table], _changing(m, table, day, step), key, attributes, day)
    return found


def _history_versions(m: Mart) -> DataFrame:
    return _histories(m)["dim_product"]


def _orders_as_of(m: Mart) -> DataFrame:
    """Orders with the price and the tier valid when they were placed."""
    found = _histories(m)
    rows = (
        m["fact_orders"]
        .select("order_id", "order_datetime", "quantity", "customer_key", "product_key")
        .join(m["dim_customer"].select("customer_key", "user_id"), "customer_key")
        .join(m["dim_product"].select("product_key", "product_id"), "product_key")
        .drop("customer_key", "product_key")
    )
    rows = as_of(rows, found["dim_product"], "product_id", "order_datetime", ["harga_jual_idr"])
    rows = as_of(rows, found["dim_customer"], "user_id", "order_datetime", ["account_tier"])
    return rows.withColumn("revenue_idr", F.col("quantity") * F.col("harga_jual_idr"))


def _on_rollups(report: Callable[[Mart], DataFrame], choices=None, days=None) -> Query:
    narrowed = (lambda m: pages.apply_filters(m, choices or {}, days)) if choices or days else (lambda m: m)
    return lambda spark, sf_dir: report(narrowed(rolled_up(spark, sf_dir)))


def _on_placed(report: Callable[[Mart], DataFrame], choices, days=None) -> Query:
    return lambda spark, sf_dir: report(pages.apply_filters(placed_mart(spark, sf_dir), choices, days))


def _sketched(key: str) -> Callable[[Mart], DataFrame]:
    """Distinct sessions by a key, and whether the estimate from merged sketches is as near as it states (four standard errors)."""

    def report(m: Mart) -> DataFrame:
        exact = m["fact_web_clickstream"].groupBy(key).agg(F.countDistinct("session_id").alias("exact"))
        near = F.abs(F.col("sessions") - F.col("exact")) <= 4 * SKETCH_ERROR * F.col("exact") + 1
        return exact.join(sessions(m, [key]), key, "left").select(key, "exact", F.coalesce(near, F.lit(False)).alias("near"))

    return report


def _audit(m: Mart) -> DataFrame:
    return m["etl_run_log"].select("step_name", "status", "row_count")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "stg_crm": _staged("crm_user_profiles"),
        "stg_mdm": _staged("mdm_products"),
        "stg_oms": _staged("oms_orders"),
        "stg_wms": _staged("wms_inventory_movements"),
        "stg_web": _staged("web_clickstream_logs"),
        "csv_line_breaks": _line_breaks,
        "incremental_orders": _incremental_orders,
        "incremental_keys": _incremental_keys,
        "history_versions": _on_mart(_history_versions),
        "orders_as_of": _on_mart(_orders_as_of),
        "date_span": _span,
        "date_key_expr": _date_keys,
        "param_query": _param_query,
        "audit_row_counts": _on_mart(_audit),
        "constraint_pk": _on_mart(constraints.primary_keys),
        "constraint_unique": _on_mart(constraints.natural_keys),
        "constraint_not_null": _on_mart(constraints.not_null),
        "constraint_fk": _on_mart(constraints.foreign_keys),
    }
    for name in [*TABLES, *ORPHANS]:
        q[name] = _table(name)
    q |= {name: _on_mart(report) for name, report in REPORTS.items()}
    q["dq9_audit_history"] = _on_mart(quality.audit_ranks)
    # the report has DECIMAL(38, 0) totals; those of the test tables fit a BIGINT, which every tool compares alike
    q["e2_category_risk"] = _on_mart(_narrow)
    q["e1_daily_summary"] = _on_mart(lambda m: reports.e1_daily_summary(m, *WINDOW))

    constraint = {
        "constraint_pk": constraints.primary_keys,
        "constraint_unique": constraints.natural_keys,
        "constraint_not_null": constraints.not_null,
        "constraint_fk": constraints.foreign_keys,
    }
    for name in CHECKED:
        report = constraint.get(name) or REPORTS[name]
        q[f"{name}_faulty"] = _on_mart(lambda m, report=report: report(with_faults(m)))

    q |= {f"rollup_{name}": _on_rollups(REPORTS[name]) for name in ROLLED_UP}
    products = {column: values for column, values in SALES_FILTER.items() if column != "kota"}
    q |= {
        "rollup_e1_daily_summary": _on_rollups(lambda m: reports.e1_daily_summary(m, *WINDOW)),
        "rollup_page_category": _on_rollups(reports.a2_category_revenue, products, SALES_DAYS),
        "rollup_page_sales_city": _on_rollups(reports.a6_city_revenue, SALES_FILTER, SALES_DAYS),
        "rollup_page_web_latency": _on_rollups(reports.c2_page_latency, WEB_FILTER),
        "rollup_page_inventory_volume": _on_rollups(pages.warehouse_volume, STOCK_FILTER),
        "rollup_page_inventory_defects": _on_rollups(reports.d3_top_defects, STOCK_FILTER),
        "sketch_daily_sessions": _on_rollups(_sketched("date_key")),
        "sketch_page_sessions": _on_rollups(_sketched("page_key"), days=SALES_DAYS),
        "sketch_device_sessions": _on_rollups(_sketched("device_key"), WEB_FILTER),
    }

    q |= {
        "placed_page_sales_daily": _on_placed(pages.daily_sales, SALES_FILTER, SALES_DAYS),
        "placed_page_sales_category": _on_placed(reports.a2_category_revenue, SALES_FILTER, SALES_DAYS),
        "placed_page_sales_filtered": _on_placed(pages.sales_detail, SALES_FILTER, SALES_DAYS),
        "placed_page_web_latency": _on_placed(reports.c2_page_latency, WEB_FILTER),
        "placed_page_inventory_volume": _on_placed(pages.warehouse_volume, STOCK_FILTER),
        "placed_page_inventory_defects": _on_placed(reports.d3_top_defects, STOCK_FILTER),
        "placed_fact_orders": lambda spark, sf_dir: placed_mart(spark, sf_dir)["fact_orders"].select(
            *(f.name for f in TABLES["fact_orders"].schema)
        ),
    }

    def sales(report):
        return _filtered(report, SALES_FILTER, SALES_DAYS)

    q |= {
        "page_sales_filtered": sales(pages.sales_detail),
        "page_sales_daily": sales(pages.daily_sales),
        "page_sales_category": sales(reports.a2_category_revenue),
        "page_sales_city": sales(reports.a6_city_revenue),
        "page_sales_status": sales(reports.a4_status_share),
        "page_sales_payment": sales(reports.a5_payment_pref),
        "page_sales_top": sales(reports.a3_top_products),
        "page_customer_tier": _filtered(reports.b1_tier_segment, CUSTOMER_FILTER),
        "page_customer_top": _filtered(reports.b2_top_customers, CUSTOMER_FILTER),
        "page_customer_dormant": _filtered(reports.b3_dormant, CUSTOMER_FILTER),
        "page_signup_trend": _filtered(pages.signup_trend, CUSTOMER_FILTER),
        "page_web_platform": _filtered(reports.c1_funnel, WEB_FILTER),
        "page_web_device": _filtered(reports.c3_device_split, WEB_FILTER),
        "page_web_latency": _filtered(reports.c2_page_latency, WEB_FILTER),
        "page_web_conversion": _filtered(reports.c4_conversion, WEB_FILTER),
        "page_inventory_filtered": _filtered(reports.d1_low_stock, STOCK_FILTER),
        "page_inventory_volume": _filtered(pages.warehouse_volume, STOCK_FILTER),
        "page_inventory_defects": _filtered(reports.d3_top_defects, STOCK_FILTER),
        "page_exec_scatter": _on_mart(pages.category_scatter),
        "page_sales_kpi": sales(kpis.kpi_summary),
        "page_web_kpi": _filtered(kpis.kpi_summary, WEB_FILTER),
        "page_inventory_kpi": _filtered(kpis.kpi_summary, STOCK_FILTER),
        "page_customer_detail": _filtered(pages.customer_detail, CUSTOMER_FILTER),
        "page_web_detail": _filtered(pages.web_detail, WEB_FILTER),
        "page_inventory_detail": _filtered(pages.inventory_detail, STOCK_FILTER),
    }
    return q
