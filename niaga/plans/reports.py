"""The report catalogue over a mart: sales, customers, web, inventory, cross-domain.

Facts are aggregated by surrogate key before a dimension that can grow with the
data is joined, so such a join sees one row per key whatever the skew of the
fact. No join carries a broadcast hint: Spark broadcasts a side it measures to
be small and otherwise shuffles.

``grouped`` takes the sums of a fact from the smallest stored roll-up that has them, where the mart has roll-ups.

Product and customer keys are numbered in the order of their natural keys, so
ties at a top-k cut are broken on the key, before the dimension is joined.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niaga.functions import date_key_of, ratio_round
from niaga.lookups import DEFECT, MOVEMENT_DIRECTION
from niaga.operators import top
from niaga.plans.rollups import grouped, rows_of
from niaga.schemas import MONTH

Tables = Mapping[str, DataFrame]


def _count(alias: str) -> Column:
    return F.count("*").alias(alias)


def _sum(column: str, alias: str | None = None) -> Column:
    return F.sum(column).alias(alias or column)


def in_days(first: dt.date, last: dt.date) -> Column:
    """Whether a row lies in a date window; the month condition prunes stored partitions."""
    low, high = date_key_of(first), date_key_of(last)
    return F.col(MONTH).between(low // 100, high // 100) & F.col("date_key").between(low, high)


def between_days(fact: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return fact.where(in_days(first, last))


def with_share(counts: DataFrame, column: str, alias: str, scale: int) -> DataFrame:
    """Share of each group in the total, in percent. Reads the grouped rows only."""
    total = counts.agg(F.sum(column)).scalar()
    return counts.withColumn(alias, ratio_round(F.col(column), total, scale, factor=100))


# --- A. sales -----------------------------------------------------------------------------


def a1_monthly_kpi(m: Tables) -> DataFrame:
    daily = grouped(m, "fact_orders", ["date_key"], ["n", "quantity", "gross_revenue_idr", "gross_profit_idr"])
    return (
        daily.join(m["dim_date"].select("date_key", "year", "month", "month_name"), "date_key")
        .groupBy("year", "month", "month_name")
        .agg(
            _sum("n", "total_order"),
            _sum("quantity", "total_unit_terjual"),
            _sum("gross_revenue_idr", "total_revenue_idr"),
            _sum("gross_profit_idr", "total_profit_idr"),
        )
        .withColumn(
            "avg_order_value_idr", ratio_round(F.col("total_revenue_idr"), F.col("total_order"), 0)
        )
        .orderBy("year", "month")
    )


def _per_product(m: Tables, delivered: bool = False) -> DataFrame:
    measures = ["n", "quantity", "gross_revenue_idr", "gross_profit_idr"]
    return grouped(m, "fact_orders", ["product_key"], measures, *_only(delivered))


def _only(delivered: bool) -> tuple:
    return ("is_delivered = 1", ["is_delivered"]) if delivered else ()


def a2_category_revenue(m: Tables) -> DataFrame:
    margin_bp = F.rint(F.col("margin_pct") * 100).cast("bigint")
    return (
        _per_product(m)
        .join(m["dim_product"].select("product_key", "kategori", "margin_pct"), "product_key")
        .groupBy("kategori")
        .agg(
            _sum("n", "total_order"),
            _sum("quantity", "total_unit_terjual"),
            _sum("gross_revenue_idr", "total_revenue_idr"),
            _sum("gross_profit_idr", "total_profit_idr"),
            F.sum(F.col("n") * margin_bp).alias("_bp"),
        )
        # the margin is averaged over orders, in whole hundredths of a percent
        .withColumn("avg_margin_pct", ratio_round(F.col("_bp"), F.col("total_order"), 0) / 100)
        .drop("_bp")
        .orderBy(F.desc("total_revenue_idr"), "kategori")
    )


def a3_top_products(m: Tables, n: int = 10) -> DataFrame:
    best = top(
        _per_product(m, delivered=True),
        n,
        F.desc("gross_revenue_idr"),
        F.asc("product_key"),
    )
    return (
        best.join(m["dim_product"], "product_key")
        .select(
            "product_id",
            "nama_produk",
            "kategori",
            F.col("quantity").alias("total_unit_terjual"),
            F.col("gross_revenue_idr").alias("total_revenue_idr"),
            F.col("gross_profit_idr").alias("total_profit_idr"),
        )
        .orderBy(F.desc("total_revenue_idr"), "product_id")
    )


def a4_status_share(m: Tables) -> DataFrame:
    counts = grouped(m, "fact_orders", ["status_order"], ["n"]).withColumnRenamed("n", "jumlah_order")
    return with_share(counts, "jumlah_order", "persentase", 2).orderBy(
        F.desc("jumlah_order"), "status_order"
    )


def _by_payment(m: Tables, *names: str) -> DataFrame:
    per_key = grouped(m, "fact_orders", ["payment_method_key"], ["n", "gross_revenue_idr"])
    return (
        per_key.join(m["dim_payment_method"], "payment_method_key")
        .groupBy(*names)
        .agg(_sum("n", "total_order"), _sum("gross_revenue_idr", "total_revenue_idr"))
    )


def a5_payment_pref(m: Tables) -> DataFrame:
    return (
        _by_payment(m, "payment_method_name", "payment_category")
        .withColumn(
            "avg_order_value_idr", ratio_round(F.col("total_revenue_idr"), F.col("total_order"), 0)
        )
        .orderBy(F.desc("total_revenue_idr"), "payment_method_name")
    )


def _per_customer(m: Tables, delivered: bool = False) -> DataFrame:
    return grouped(m, "fact_orders", ["customer_key"], ["n", "gross_revenue_idr"], *_only(delivered))


def a6_city_revenue(m: Tables) -> DataFrame:
    return (
        _per_customer(m)
        .join(m["dim_customer"].select("customer_key", "kota"), "customer_key")
        .groupBy("kota")
        .agg(
            _count("jumlah_pelanggan"),  # one row per customer by now
            _sum("n", "total_order"),
            _sum("gross_revenue_idr", "total_revenue_idr"),
        )
        .withColumn(
            "revenue_per_customer_idr",
            ratio_round(F.col("total_revenue_idr"), F.col("jumlah_pelanggan"), 0),
        )
        .orderBy(F.desc("total_revenue_idr"), "kota")
    )


# --- B. customers -------------------------------------------------------------------------


def b1_tier_segment(m: Tables) -> DataFrame:
    return (
        m["dim_customer"]
        .select("customer_key", "account_tier")
        .join(_per_customer(m), "customer_key", "left")
        .groupBy("account_tier")
        .agg(
            _count("jumlah_pelanggan"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_order"),
            _sum("gross_revenue_idr", "total_revenue_idr"),
        )
        .withColumn(
            "avg_order_value_idr", ratio_round(F.col("total_revenue_idr"), F.col("total_order"), 0)
        )
        .orderBy(F.desc_nulls_last("total_revenue_idr"), "account_tier")
    )


def b2_top_customers(m: Tables, n: int = 10) -> DataFrame:
    best = top(
        _per_customer(m, delivered=True),
        n,
        F.desc("gross_revenue_idr"),
        F.asc("customer_key"),
    )
    return (
        best.join(m["dim_customer"], "customer_key")
        .select(
            "user_id",
            "nama_lengkap",
            "kota",
            "account_tier",
            F.col("n").alias("total_order"),
            F.col("gross_revenue_idr").alias("total_belanja_idr"),
        )
        .orderBy(F.desc("total_belanja_idr"), "user_id")
    )


def never_ordered(m: Tables) -> DataFrame:
    """Customers without any order."""
    buyers = rows_of(m, "fact_orders", ["customer_key"]).select("customer_key").distinct()
    return m["dim_customer"].join(buyers, "customer_key", "left_anti")


def b3_dormant(m: Tables, n: int = 20) -> DataFrame:
    return top(
        never_ordered(m).select(
            "user_id",
            "nama_lengkap",
            "kota",
            "account_tier",
            "signup_date",
            "tenure_days_as_of_load",
        ),
        n,
        F.desc_nulls_last("tenure_days_as_of_load"),
        F.asc("user_id"),
    )


# --- C. web -------------------------------------------------------------------------------


def c1_funnel(m: Tables) -> DataFrame:
    # a page has one key, so hits and sessions are final before the page is joined
    per_page = m["fact_web_clickstream"].groupBy("page_key").agg(
        _count("total_hit"), F.countDistinct("session_id").alias("unique_session")
    )
    return (
        per_page.join(m["dim_page"], "page_key")
        .select("funnel_order", "funnel_stage", "page_url", "total_hit", "unique_session")
        .orderBy("funnel_order", "page_url")
    )


def c2_page_latency(m: Tables) -> DataFrame:
    per_page = grouped(m, "fact_web_clickstream", ["page_key"], ["n", "response_time_ms", "slowest_ms"])
    return (
        per_page.join(m["dim_page"].select("page_key", "page_url"), "page_key")
        .select(
            "page_url",
            F.col("n").alias("total_hit"),
            ratio_round(F.col("response_time_ms"), F.col("n"), 1).alias("avg_response_time_ms"),
            F.col("slowest_ms").alias("max_response_time_ms"),
        )
        .orderBy(F.desc("avg_response_time_ms"), "page_url")
    )


def c3_device_split(m: Tables) -> DataFrame:
    return (
        m["fact_web_clickstream"]
        .select("device_key", "session_id")
        .join(m["dim_device"], "device_key")
        .groupBy("platform", "operating_system")
        .agg(_count("total_hit"), F.countDistinct("session_id").alias("unique_session"))
        .orderBy(F.desc("total_hit"), "platform", "operating_system")
    )


def c4_conversion(m: Tables) -> DataFrame:
    # distinct visitors and buyers first: hits and orders of a customer never meet
    visitors = (
        m["fact_web_clickstream"]
        .select("customer_key")
        .where(F.col("customer_key").isNotNull())
        .distinct()
    )
    buyers = rows_of(m, "fact_orders", ["customer_key"]).select("customer_key").distinct().withColumn("ordered", F.lit(1))
    return (
        visitors.join(m["dim_customer"].select("customer_key", "kota"), "customer_key")
        .join(buyers, "customer_key", "left")
        .groupBy("kota")
        .agg(_count("jumlah_visitor"), F.count("ordered").alias("jumlah_yang_order"))
        .withColumn(
            "conversion_rate_pct",
            ratio_round(F.col("jumlah_yang_order"), F.col("jumlah_visitor"), 2, factor=100),
        )
        .orderBy(F.desc("conversion_rate_pct"), "kota")
    )


# --- D. inventory -------------------------------------------------------------------------


def d1_low_stock(m: Tables, n: int = 20) -> DataFrame:
    # several sites share a warehouse name: with the name joined first, one shuffle adds up the rows
    per_name = (
        rows_of(m, "fact_inventory_movements", ["product_key", "warehouse_key"])
        .select("product_key", "warehouse_key", "signed_quantity")
        .join(m["dim_warehouse"].select("warehouse_key", "warehouse_name"), "warehouse_key")
        .groupBy("product_key", "warehouse_name")
        .agg(_sum("signed_quantity", "estimasi_stok_bersih"))
    )
    lowest = top(
        per_name, n, F.asc("estimasi_stok_bersih"), F.asc("product_key"), F.asc("warehouse_name")
    )
    return (
        lowest.join(m["dim_product"].select("product_key", "product_id", "nama_produk"), "product_key")
        .select("product_id", "nama_produk", "warehouse_name", "estimasi_stok_bersih")
        .orderBy("estimasi_stok_bersih", "product_id", "warehouse_name")
    )


def _by_warehouse_and_type(m: Tables) -> DataFrame:
    measures = ["n", "quantity_change", "signed_quantity"]
    per_site = grouped(m, "fact_inventory_movements", ["warehouse_key", "jenis_mutasi"], measures)
    return per_site.join(
        m["dim_warehouse"].select("warehouse_key", "warehouse_name"), "warehouse_key"
    )


def d2_movement_summary(m: Tables) -> DataFrame:
    position = F.coalesce(
        *(
            F.when(F.col("jenis_mutasi") == kind, F.lit(i))
            for i, kind in enumerate(MOVEMENT_DIRECTION, start=1)
        )
    )
    return (
        _by_warehouse_and_type(m)
        .groupBy("warehouse_name", "jenis_mutasi")
        .agg(
            _sum("n", "jumlah_transaksi"),
            _sum("quantity_change", "total_unit_bergerak"),
            _sum("signed_quantity", "net_effect_terhadap_stok"),
        )
        .orderBy("warehouse_name", position, "jenis_mutasi")
    )


def d3_top_defects(m: Tables, n: int = 10) -> DataFrame:
    # a product without defect movements has sum 0 and is left out anyway
    per_product = (
        grouped(
            m,
            "fact_inventory_movements",
            ["product_key"],
            ["quantity_change", "n"],
            F.col("jenis_mutasi") == DEFECT,
            ["jenis_mutasi"],
        )
        .select("product_key", F.col("quantity_change").alias("total_unit_rusak"), F.col("n").alias("jumlah_kejadian"))
        .where("total_unit_rusak > 0")
    )
    worst = top(per_product, n, F.desc("total_unit_rusak"), F.asc("product_key"))
    return (
        worst.join(m["dim_product"], "product_key")
        .select("product_id", "nama_produk", "kategori", "total_unit_rusak", "jumlah_kejadian")
        .orderBy(F.desc("total_unit_rusak"), "product_id")
    )


# --- E. cross-domain ----------------------------------------------------------------------


def e1_daily_summary(m: Tables, first: dt.date, last: dt.date) -> DataFrame:
    window = in_days(first, last)

    def daily(name: str, **names: str) -> DataFrame:
        sums = grouped(m, name, ["date_key"], list(names), window, [MONTH, "date_key"])
        return sums.withColumnsRenamed(names)

    sales = daily("fact_orders", n="total_order", gross_revenue_idr="total_revenue_idr")
    web = (
        between_days(m["fact_web_clickstream"], first, last)
        .groupBy("date_key")
        .agg(_count("total_web_hit"), F.countDistinct("session_id").alias("unique_session"))
    )
    moves = daily("fact_inventory_movements", n="total_pergerakan_gudang")
    measures = [
        "total_order",
        "total_revenue_idr",
        "total_web_hit",
        "unique_session",
        "total_pergerakan_gudang",
    ]
    return (
        m["dim_date"]
        .select("date_key", "full_date")
        .where(F.col("full_date").between(F.lit(first), F.lit(last)))
        .join(sales, "date_key", "left")
        .join(web, "date_key", "left")
        .join(moves, "date_key", "left")
        .select("full_date", *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in measures))
        .orderBy("full_date")
    )


def _product_risk(m: Tables) -> DataFrame:
    """Per product: revenue and order count, defect units and movement count (null if none)."""
    sales = grouped(m, "fact_orders", ["product_key"], ["n", "gross_revenue_idr"])
    sales = sales.withColumnsRenamed({"n": "orders", "gross_revenue_idr": "revenue"})
    broken = F.when(F.col("jenis_mutasi") == DEFECT, F.col("quantity_change")).otherwise(0)
    moves = m["fact_inventory_movements"].groupBy("product_key").agg(
        _count("moves"), F.sum(broken).alias("defect_units")
    )
    return (
        m["dim_product"]
        .select("product_key", "kategori")
        .join(sales, "product_key", "left")
        .join(moves, "product_key", "left")
    )


def e2_category_risk(m: Tables) -> DataFrame:
    """Revenue and defects per category as the joined report counts them.

    Joining orders and movements on the product repeats each order once per
    movement and each movement once per order. The repeated sums are computed
    from per-product totals, without building the joined rows. They grow with the
    square of the data, so they are DECIMAL(38, 0).
    """

    def at_least_one(column: str) -> Column:
        return F.greatest(F.coalesce(F.col(column), F.lit(0)), F.lit(1)).cast("decimal(18,0)")

    def wide(column: Column) -> Column:
        return F.coalesce(column, F.lit(0)).cast("decimal(19,0)")

    def total(product: Column) -> Column:
        return F.sum(product).cast("decimal(38,0)")

    return (
        _product_risk(m)
        .groupBy("kategori")
        .agg(
            total(F.when(F.col("revenue").isNotNull(), wide(F.col("revenue")) * at_least_one("moves"))).alias(
                "total_revenue_idr"
            ),
            total(wide(F.col("defect_units")) * at_least_one("orders")).alias("total_unit_rusak"),
        )
        .orderBy(F.desc_nulls_last("total_revenue_idr"), "kategori")
    )


def e2_category_risk_fixed(m: Tables) -> DataFrame:
    """The same report with every order and movement counted once."""
    return (
        _product_risk(m)
        .groupBy("kategori")
        .agg(
            _sum("revenue", "total_revenue_idr"),
            F.coalesce(F.sum("defect_units"), F.lit(0)).alias("total_unit_rusak"),
        )
        .orderBy(F.desc_nulls_last("total_revenue_idr"), "kategori")
    )


# --- charts -------------------------------------------------------------------------------


def chart_daily_revenue(m: Tables) -> DataFrame:
    daily = grouped(m, "fact_orders", ["date_key"], ["gross_revenue_idr"])
    return (
        daily.join(m["dim_date"].select("date_key", "full_date"), "date_key")
        .select("full_date", F.col("gross_revenue_idr").alias("revenue"))
        .orderBy("full_date")
    )


def chart_category_revenue(m: Tables) -> DataFrame:
    per_product = grouped(m, "fact_orders", ["product_key"], ["gross_revenue_idr"])
    return (
        per_product.join(m["dim_product"].select("product_key", "kategori"), "product_key")
        .groupBy("kategori")
        .agg(_sum("gross_revenue_idr", "revenue"))
        .orderBy(F.desc("revenue"), "kategori")
    )


def chart_status(m: Tables) -> DataFrame:
    counts = grouped(m, "fact_orders", ["status_order"], ["n"])
    return with_share(counts, "n", "share_pct", 1).orderBy(F.desc("n"), "status_order")


def chart_payment(m: Tables) -> DataFrame:
    return (
        _by_payment(m, "payment_method_name")
        .select(
            "payment_method_name",
            F.col("total_order").alias("n"),
            F.col("total_revenue_idr").alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "payment_method_name")
    )


def chart_funnel(m: Tables) -> DataFrame:
    # several unknown pages share a stage, so a session is counted per stage, not per page
    seen = m["fact_web_clickstream"].select("page_key", "session_id")
    return (
        seen.join(m["dim_page"].select("page_key", "funnel_order", "funnel_stage"), "page_key")
        .groupBy("funnel_order", "funnel_stage")
        .agg(F.countDistinct("session_id").alias("sessions"))
        .orderBy("funnel_order", "funnel_stage")
    )


def chart_device(m: Tables) -> DataFrame:
    counts = (
        grouped(m, "fact_web_clickstream", ["device_key"], ["n"])
        .join(m["dim_device"].select("device_key", "device_type_code"), "device_key")
        .select("device_type_code", "n")
    )
    return with_share(counts, "n", "share_pct", 1).orderBy(F.desc("n"), "device_type_code")


def chart_top_products(m: Tables, n: int = 10) -> DataFrame:
    """Best products by name: products sharing a name count as one."""
    per_product = grouped(m, "fact_orders", ["product_key"], ["gross_revenue_idr"], *_only(delivered=True))
    per_name = (
        per_product.join(m["dim_product"].select("product_key", "nama_produk"), "product_key")
        .groupBy("nama_produk")
        .agg(_sum("gross_revenue_idr", "revenue"))
    )
    return top(per_name, n, F.desc("revenue"), F.asc("nama_produk"))


def chart_warehouse_pivot(m: Tables) -> DataFrame:
    return (
        _by_warehouse_and_type(m)
        .groupBy("warehouse_name")
        .pivot("jenis_mutasi", list(MOVEMENT_DIRECTION))
        .agg(F.sum("quantity_change"))
        .fillna(0)
        .orderBy("warehouse_name")
    )
