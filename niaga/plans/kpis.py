"""Headline numbers, insights and run metrics. No cross join: see ``fold_rows``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.functions import fold_rows, mean, number_label, percent_label, ratio_round, rupiah_label
from niaga.plans.reports import Tables, c2_page_latency, c4_conversion, never_ordered
from niaga.plans.rollups import grouped


def _order_totals(m: Tables) -> DataFrame:
    names = {
        "gross_revenue_idr": "total_revenue",
        "gross_profit_idr": "total_profit",
        "n": "total_orders",
        "delivered": "_delivered",
        "cancelled": "_cancelled",
    }
    return grouped(m, "fact_orders", [], list(names)).withColumnsRenamed(names)


def _headline(m: Tables) -> DataFrame:
    return fold_rows(
        _order_totals(m),
        m["dim_customer"].agg(F.count("*").alias("total_customers")),
        m["dim_product"].agg(F.count("*").alias("total_products")),
        m["fact_web_clickstream"].agg(F.countDistinct("session_id").alias("sessions")),
        grouped(m, "fact_inventory_movements", [], ["signed_quantity"]).withColumnRenamed("signed_quantity", "net_stock"),
    )


def kpi_summary(m: Tables) -> DataFrame:
    revenue, orders = F.col("total_revenue"), F.col("total_orders")
    return _headline(m).select(
        "total_revenue",
        "total_profit",
        "total_orders",
        "total_customers",
        mean(revenue, orders).alias("avg_order_value"),
        ratio_round(F.col("_delivered"), orders, 1, factor=100).alias("delivered_rate"),
        ratio_round(F.col("_cancelled"), orders, 1, factor=100).alias("cancelled_rate"),
        F.col("sessions").alias("total_web_sessions"),
        "total_products",
        F.col("net_stock").alias("net_stock_change"),
    )


def home_kpis(m: Tables) -> DataFrame:
    return kpi_summary(m).select(
        "total_revenue",
        "total_profit",
        "total_orders",
        F.col("avg_order_value").alias("aov"),
        "total_customers",
        F.col("total_web_sessions").alias("total_sessions"),
        "delivered_rate",
        F.col("net_stock_change").alias("net_stock"),
    )


def kpi_margin(m: Tables) -> DataFrame:
    totals = _order_totals(m)
    margin = ratio_round(F.col("total_profit"), F.col("total_revenue"), 1, factor=100)
    return totals.select(margin.alias("margin_pct"))


def fmt_kpi_labels(m: Tables) -> DataFrame:
    """The headline numbers as display labels."""
    margin = F.col("total_profit").cast("double") / F.col("total_revenue") * 100
    net = F.col("net_stock_change")
    sign = F.when(net >= 0, "+").otherwise("")
    return kpi_summary(m).select(
        rupiah_label(F.col("total_revenue")).alias("revenue_label"),
        rupiah_label(F.col("total_profit")).alias("profit_label"),
        percent_label(margin).alias("margin_label"),
        number_label(F.col("total_orders")).alias("orders_label"),
        rupiah_label(F.col("avg_order_value")).alias("aov_label"),
        percent_label(F.col("delivered_rate")).alias("delivered_label"),
        number_label(F.col("total_customers")).alias("customers_label"),
        number_label(F.col("total_web_sessions")).alias("sessions_label"),
        F.concat(sign, number_label(net)).alias("net_stock_label"),
    )


def home_source_counts(m: Tables) -> DataFrame:
    # Labels of the sources.
    sources = (
        ("CRM (dim_customer)", "dim_customer"),
        ("MDM (dim_product)", "dim_product"),
        ("OMS (fact_orders)", "fact_orders"),
        ("WMS (fact_inventory_movements)", "fact_inventory_movements"),
        ("Web Analytics (fact_web_clickstream)", "fact_web_clickstream"),
    )
    counts = [
        m[table].agg(F.count("*").alias("baris")).select(F.lit(label).alias("sumber"), "baris")
        for label, table in sources
    ]
    return reduce(DataFrame.unionByName, counts)


def run_metrics(m: Tables) -> DataFrame:
    """What a load reports while it runs, as (metric, value)."""
    metrics = (
        ("total_revenue", "fact_orders", F.sum("gross_revenue_idr")),
        ("net_stock_change", "fact_inventory_movements", F.sum("signed_quantity")),
        ("distinct_sessions", "fact_web_clickstream", F.countDistinct("session_id")),
        ("orphan_orders", "orphan_orders", F.count("*")),
        ("orphan_movements", "orphan_movements", F.count("*")),
    )
    rows = [
        m[table].agg(measure.alias("value")).select(F.lit(name).alias("metric"), "value")
        for name, table, measure in metrics
    ]
    return reduce(DataFrame.unionByName, rows)


# --- insights -----------------------------------------------------------------------------


def ins_dormant_share(m: Tables) -> DataFrame:
    dormant = never_ordered(m).agg(F.count("*").alias("dormant_customers"))
    everyone = m["dim_customer"].agg(F.count("*").alias("total_customers"))
    return fold_rows(dormant, everyone).withColumn(
        "dormant_pct",
        ratio_round(F.col("dormant_customers"), F.col("total_customers"), 1, factor=100),
    )


def ins_net_stock_by_wh(m: Tables) -> DataFrame:
    per_site = grouped(m, "fact_inventory_movements", ["warehouse_key"], ["signed_quantity"])
    return (
        per_site.join(m["dim_warehouse"].select("warehouse_key", "warehouse_name"), "warehouse_key")
        .groupBy("warehouse_name")
        .agg(F.sum("signed_quantity").alias("net_stock"))
        .withColumn("needs_restock", (F.col("net_stock") < 0).cast("int"))
        .orderBy("net_stock", "warehouse_name")
    )


def ins_platform_share(m: Tables) -> DataFrame:
    per_device = grouped(m, "fact_web_clickstream", ["device_key"], ["n"])
    hits = (
        per_device.join(m["dim_device"].select("device_key", "platform"), "device_key")
        .groupBy("platform")
        .agg(F.sum("n").alias("hits"))
    )
    total = hits.agg(F.sum("hits")).scalar()
    return hits.withColumn("share_pct", ratio_round(F.col("hits"), total, 1, factor=100)).orderBy(
        F.desc("hits"), "platform"
    )


def ins_slowest_page(m: Tables) -> DataFrame:
    return c2_page_latency(m).select("page_url", "avg_response_time_ms").limit(1)


def ins_city_extremes(m: Tables) -> DataFrame:
    """Cities with the best and the worst conversion; the first by name among equals."""
    rates = c4_conversion(m).select("kota", "conversion_rate_pct")
    best = F.struct(-F.col("conversion_rate_pct"), "kota")
    worst = F.struct("conversion_rate_pct", "kota")
    ends = rates.agg(
        F.min_by(F.struct("kota", "conversion_rate_pct"), best).alias("best"),
        F.min_by(F.struct("kota", "conversion_rate_pct"), worst).alias("worst"),
    )
    return ends.select(
        F.col("best.kota").alias("best_city"),
        F.col("best.conversion_rate_pct").alias("best_rate_pct"),
        F.col("worst.kota").alias("worst_city"),
        F.col("worst.conversion_rate_pct").alias("worst_rate_pct"),
    )


def ins_fulfilment_rates(m: Tables) -> DataFrame:
    totals = grouped(m, "fact_orders", [], ["n", "delivered", "cancelled", "returned"])
    return totals.select(
        *(
            ratio_round(F.col(c), F.col("n"), 1, factor=100).alias(f"{c}_pct")
            for c in ("delivered", "cancelled", "returned")
        )
    )
