"""The load on a hand-made company: the branches the generated tables do not reach."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from conftest import CRM, MDM, OMS, at, source_frames
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from niaga.operators.constraints import dangling_keys, duplicate_keys, null_rows
from niaga.operators.quality import dq1_row_counts, dq_suite
from niaga.plans import dimensions, kpis, pages, pipeline, reports
from niaga.plans.pipeline import (
    ConstraintViolation,
    QualityFailure,
    open_latest,
    run_load,
)
from niaga.schemas import FACTS, LOADED_AT, TABLES
from niaga.sources import SourceFrame
from niaga.sources.files import SourceError, split_rejects
from niaga.schemas import SOURCES

SNAPSHOT = dt.date(2026, 7, 1)


def table(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("mart"))
    return root, run_load(spark, source_frames(spark), root, SNAPSHOT, publish_failed_checks=True)


@pytest.fixture(scope="module")
def mart(loaded):
    return loaded[1].mart


def test_written_tables_are_small(spark, tmp_path, monkeypatch):
    """Compressed by zstd; columns that follow from others are not moved and written before the rows are numbered."""
    monkeypatch.setattr(pipeline, "_remove", lambda *_: None)
    done = run_load(spark, source_frames(spark), str(tmp_path), SNAPSHOT, publish_failed_checks=True)
    base = f"{tmp_path}/runs/{done.run_id}"
    for name in ("stg_oms_orders", "dim_customer", "fact_orders", "ordered/fact_orders"):
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{base}/{name}/**/*.parquet", recursive=True)]
        used = {f.row_group(g).column(0).compression for f in files for g in range(f.num_row_groups)}
        assert used == {"ZSTD"}, (name, used)
    derived = {"gross_revenue_idr", "gross_cost_idr", "gross_profit_idr", "is_delivered", "is_cancelled", "is_returned"}
    assert not derived & set(spark.read.parquet(f"{base}/ordered/fact_orders").columns)
    assert "signed_quantity" not in spark.read.parquet(f"{base}/ordered/fact_inventory_movements").columns


def test_customers_keep_first_and_count_tenure(mart):
    assert table(mart["dim_customer"], "customer_key", "user_id", "nama_lengkap", "tenure_days_as_of_load") == [
        (1, "U1", "Ani", 181),
        (2, "U2", "Budi", 0),  # one second short of a day
        (3, "U3", "Citra", 60),
    ]


def test_products_derive_margin(mart):
    got = table(mart["dim_product"], "product_key", "product_id", "margin_idr", "margin_pct", "is_active")
    assert got == [(1, "P1", 40, 40.0, 1), (2, "P2", -20, -20.0, 0), (3, "P3", 800, 100.0, 1)]


def test_warehouse_ids_are_taken_apart(mart):
    assert table(mart["dim_warehouse"], "warehouse_id", "warehouse_name", "warehouse_code") == [
        ("WH", "WH", ""),
        ("WH-JAKARTA-01", "Jakarta", "01"),
        ("WH-JAKARTA-02", "Jakarta", "02"),
        ("WH-X", "X", ""),
    ]


def test_mini_dimensions_with_unmapped_codes(mart):
    assert table(mart["dim_payment_method"], *TABLES["dim_payment_method"].names) == [
        (1, "BARTER", "BARTER", "Lainnya"),
        (2, "GOPAY", "GoPay", "E-Wallet"),
        (3, "OVO", "OVO", "E-Wallet"),
        (4, "VA_BCA", "Virtual Account - BCA", "Virtual Account"),
    ]
    assert table(mart["dim_device"], *TABLES["dim_device"].names) == [
        (1, "Kiosk", "Kiosk", ""),
        (2, "Mobile-Android", "Mobile", "Android"),
        (3, "Tablet-Fire-OS", "Tablet", "Fire-OS"),
    ]
    assert table(mart["dim_page"], *TABLES["dim_page"].names) == [
        (1, "/about", "0. Unknown", 0),
        (2, "/promo", "0. Unknown", 0),
        (3, "/home", "1. Landing", 1),
        (4, "/checkout", "5. Conversion", 5),
    ]


def test_calendar(spark, mart):
    days = mart["dim_date"]
    # 2026-01-01 is the first signup kept or not: the dropped row of U2 counts as well
    assert days.agg(F.min("full_date"), F.max("full_date")).head() == (
        dt.date(2024, 12, 29),
        dt.date(2026, 7, 3),
    )
    assert days.count() == 552
    turn = dimensions.calendar(spark, dt.date(2025, 1, 1), dt.date(2024, 12, 30))
    got = table(turn, "date_key", "day_name", "month_name", "quarter", "year", "week_of_year", "is_weekend")
    assert got[:2] == [
        (20241229, "Minggu", "Desember", 4, 2024, 52, 1),
        (20241230, "Senin", "Desember", 4, 2024, 1, 0),
    ]
    assert got[-1] == (20250102, "Kamis", "Januari", 1, 2025, 1, 0)


def test_order_fact(mart):
    columns = ["order_key", "order_id", "date_key", "customer_key", "product_key", "payment_method_key",
               "gross_revenue_idr", "gross_cost_idr", "gross_profit_idr",
               "is_delivered", "is_cancelled", "is_returned"]
    assert table(mart["fact_orders"], *columns) == [
        (1, "O1", 20260601, 1, 1, 3, 200, 120, 80, 1, 0, 0),
        (2, "O2", 20260601, 1, 2, 1, 100, 120, -20, 0, 1, 0),
        (3, "O6", 20260604, 2, 1, 4, 300, 180, 120, 0, 0, 1),
        (4, "O7", 20260604, 2, 3, 2, 800, 0, 800, 1, 0, 0),
    ]
    aside = table(mart["orphan_orders"], "order_id", "user_id", "product_id", "unknown_user", "unknown_product")
    assert aside == [
        ("O3", "U9", "P1", True, False),
        ("O4", "U2", "P9", False, True),
        ("O5", None, "P1", True, False),
    ]


def test_movement_fact(mart):
    got = table(mart["fact_inventory_movements"], "movement_key", "movement_id", "product_key", "signed_quantity")
    assert got == [(1, "M1", 1, 50), (2, "M2", 1, -20), (3, "M3", 1, -5), (4, "M4", 2, -5), (5, "M6", 2, 0)]
    assert table(mart["orphan_movements"], "movement_id", "warehouse_id") == [("M5", "WH-JAKARTA-01")]


def test_click_fact_keeps_anonymous_hits(mart):
    got = table(mart["fact_web_clickstream"], "log_id", "session_id", "customer_key", "page_key", "device_key")
    assert got == [
        ("L1", "S1", 1, 3, 2),
        ("L2", "S1", 1, 2, 2),
        ("L3", "S1", 1, 1, 2),
        ("L4", "S2", None, 3, 1),
        ("L5", "S3", None, 4, 3),
        ("L6", "S4", 3, 3, 1),
    ]
    first = mart["fact_web_clickstream"].where("log_id = 'L1'").head()
    assert first.hit_datetime == dt.datetime(2026, 6, 1, 9)  # stored to the second


def test_rows_are_kept_or_set_aside(mart):
    distinct_orders = mart["stg_oms_orders"].select("order_id").distinct().count()
    assert mart["fact_orders"].count() + mart["orphan_orders"].count() == distinct_orders


def test_keys_are_dense(mart):
    for t in TABLES.values():
        if t.name != "dim_date":
            low, high, n = mart[t.name].agg(F.min(t.primary_key), F.max(t.primary_key), F.count("*")).head()
            assert (low, high) == (1, n), t.name


def test_quality_suite_and_load_metrics(loaded):
    result = loaded[1]
    suite = {r.check_name: (r.status, r.detail) for r in dq_suite(result.mart).collect()}
    assert len(suite) == 17
    assert suite["row_count_orders_staging_vs_fact"] == ("FAIL", "staging=8, fact_orders=4")
    assert suite["business_rule_non_negative_margin"] == ("FAIL", "negative_margin_products=1")
    assert suite["fk_integrity_fact_orders_customer"] == ("PASS", "orphan_rows=0")
    assert set(result.failed_checks) == {k for k, v in suite.items() if v[0] == "FAIL"}
    stored = result.mart["fact_orders"].sparkSession.read.parquet(
        f"{loaded[0]}/runs/{result.run_id}/dq_results"
    )
    assert {r.check_name: (r.status, r.detail) for r in stored.collect()} == suite
    assert result.metrics["fact_orders"]["rows"] == 4
    assert result.metrics["fact_orders"]["total_revenue"] == 1400
    assert result.metrics["fact_inventory_movements"]["net_stock_change"] == 20
    assert result.metrics["orphan_orders"]["rows"] == 3
    assert result.mart["etl_run_log"].where("status = 'SUCCESS'").count() == 15
    counts = {r.check_name: (r.staging_count, r.mart_count) for r in dq1_row_counts(result.mart).collect()}
    assert counts["crm_vs_dim_customer"] == (4, 3)


def test_run_metrics_agree_with_the_load(mart):
    got = {r.metric: r.value for r in kpis.run_metrics(mart).collect()}
    assert got == {
        "total_revenue": 1400,
        "net_stock_change": 20,
        "distinct_sessions": 4,
        "orphan_orders": 3,
        "orphan_movements": 1,
    }


def test_second_load_gives_the_same_tables(spark, loaded):
    root, first = loaded
    second = run_load(spark, source_frames(spark), root, SNAPSHOT, publish_failed_checks=True)
    assert second.run_id > first.run_id
    assert not os.path.exists(f"{root}/runs/{second.run_id}/ordered")
    latest = open_latest(spark, root)
    for t in TABLES.values():
        assert table(latest[t.name], *t.names) == table(first.mart[t.name], *t.names)
    log = latest["etl_run_log"].orderBy("run_id").collect()
    assert len({r.run_id for r in log}) == 30  # numbered by load and step
    assert [r.step_name for r in log[:15]] == [r.step_name for r in log[15:]]
    assert [r.step_name.split("::")[0] for r in log[15:]] == ["staging"] * 5 + ["dimension"] * 7 + ["fact"] * 3
    assert {r.status for r in log} == {"SUCCESS"}


def test_facts_are_stored_by_month_and_pruned(mart):
    window = reports.between_days(mart["fact_orders"], dt.date(2026, 6, 4), dt.date(2026, 6, 30))
    assert window.count() == 2
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan
    assert all("date_month=202606" in f for f in mart["fact_orders"].inputFiles())


# --- reports on ties and edge rows --------------------------------------------------------------


def test_category_risk_equals_the_joined_report(mart):
    joined = (
        mart["dim_product"].alias("p")
        .join(mart["fact_orders"].alias("o"), "product_key", "left")
        .join(mart["fact_inventory_movements"].alias("i"), "product_key", "left")
        .groupBy("kategori")
        .agg(
            F.sum("gross_revenue_idr").alias("total_revenue_idr"),
            F.sum(F.expr("CASE WHEN jenis_mutasi = 'ADJUSTMENT_DEFECT' THEN quantity_change ELSE 0 END"))
            .alias("total_unit_rusak"),
        )
    )
    columns = ["kategori", "total_revenue_idr", "total_unit_rusak"]
    assert table(reports.e2_category_risk(mart), *columns) == table(joined, *columns)
    assert table(reports.e2_category_risk_fixed(mart), *columns) == [("Apparel", 1300, 5), ("Home", 100, 5)]


def test_reports_on_the_small_mart(mart):
    assert table(reports.b3_dormant(mart), "user_id", "tenure_days_as_of_load") == [("U3", 60)]
    funnel = table(reports.chart_funnel(mart), "funnel_order", "funnel_stage", "sessions")
    assert funnel == [(0, "0. Unknown", 1), (1, "1. Landing", 3), (5, "5. Conversion", 1)]
    conversion = table(reports.c4_conversion(mart), "kota", "jumlah_visitor", "jumlah_yang_order", "conversion_rate_pct")
    assert conversion == [("Jakarta", 1, 1, 100.0), ("Medan", 1, 0, 0.0)]
    tiers = table(reports.b1_tier_segment(mart), "account_tier", "jumlah_pelanggan", "total_order", "avg_order_value_idr")
    assert tiers == [("Gold", 2, 2, 550.0), ("Silver", 1, 2, 150.0)]
    top = [tuple(r) for r in reports.a3_top_products(mart).collect()]
    assert top == [("P3", "Sepatu", "Apparel", 1, 800, 800), ("P1", "Tas", "Apparel", 2, 200, 80)]
    pivot = table(reports.chart_warehouse_pivot(mart), "warehouse_name", "INBOUND", "RETUR_STOCK", "OUTBOUND", "ADJUSTMENT_DEFECT")
    assert pivot == [("Jakarta", 50, 0, 20, 0), ("WH", 0, 0, 0, 5), ("X", 0, 0, 0, 5)]


def test_reports_on_an_empty_fact(mart):
    empty = mart.replaced(fact_orders=mart["fact_orders"].where("false"))
    assert reports.a1_monthly_kpi(empty).count() == 0
    assert table(reports.b1_tier_segment(empty), "total_order", "total_revenue_idr", "avg_order_value_idr") == [
        (0, None, None),
        (0, None, None),
    ]
    kpi = kpis.kpi_summary(empty).head()
    assert (kpi.total_orders, kpi.total_revenue, kpi.avg_order_value, kpi.delivered_rate) == (0, None, None, None)
    labels = kpis.fmt_kpi_labels(empty).head()
    assert (labels.revenue_label, labels.delivered_label, labels.orders_label) == ("Rp0", "0%", "0")


def test_daily_totals_cover_the_fact(mart):
    summary = reports.e1_daily_summary(mart, dt.date(2024, 1, 1), dt.date(2027, 1, 1))
    assert summary.count() == 552
    assert summary.agg(F.sum("total_order"), F.sum("total_web_hit")).head() == (4, 6)


# --- filters and ad-hoc SQL ---------------------------------------------------------------------


def test_filters(mart):
    def orders(choices, days=None):
        return sorted(r.order_id for r in pages.apply_filters(mart, choices, days)["fact_orders"].collect())

    assert orders({}) == ["O1", "O2", "O6", "O7"]
    assert orders({"kategori": [], "kota": []}) == ["O1", "O2", "O6", "O7"]
    assert orders({"kategori": ["Apparel"], "kota": ["Medan"]}) == ["O6", "O7"]
    assert orders({"account_tier": ["Silver"], "status_order": ["Delivered"]}) == ["O1"]
    assert orders({"payment_method_name": ["GoPay", "OVO"]}) == ["O1", "O7"]
    assert orders({}, (dt.date(2026, 6, 2), dt.date(2026, 6, 30))) == ["O6", "O7"]
    with pytest.raises(ValueError, match="no such filter: colour"):
        orders({"colour": ["red"]})
    stock = pages.apply_filters(mart, {"warehouse_name": ["Jakarta"]})
    assert stock["fact_inventory_movements"].count() == 3
    assert stock["fact_orders"].count() == 4  # orders have no warehouse


def test_parameterised_sql(spark, mart):
    sql = "SELECT order_id FROM fact_orders WHERE quantity >= ? AND status_order = ?"
    assert table(pages.run_query(spark, mart, sql, [2, "Returned"]), "order_id") == [("O6",)]
    assert [r.kota for r in pages.get_distinct(mart, "dim_customer", "kota").collect()] == ["Jakarta", "Medan"]
    assert pages.order_date_span(mart).head() == (dt.date(2026, 6, 1), dt.date(2026, 6, 4))


# --- what stops a load ----------------------------------------------------------------------------


def test_broken_constraint_is_not_published(spark, tmp_path):
    rows = [*CRM, ("U4", "Dewi", "d@x.id", None, "Gold", at("2026-05-01 12:00:00"))]
    with pytest.raises(ConstraintViolation, match=r"dim_customer not_null\(kota\): 1"):
        run_load(spark, source_frames(spark, crm_user_profiles=rows), str(tmp_path), SNAPSHOT)
    assert spark.read.parquet(f"{tmp_path}/published").count() == 0


def test_zero_price_breaks_the_margin(spark, tmp_path):
    rows = [*MDM, ("P0", "Hadiah", "Home", 5, 0, True)]
    with pytest.raises(ConstraintViolation, match=r"dim_product not_null\(margin_pct\): 1"):
        run_load(spark, source_frames(spark, mdm_products=rows), str(tmp_path), SNAPSHOT)


def test_failed_check_is_not_published(spark, tmp_path):
    with pytest.raises(QualityFailure, match="business_rule_non_negative_margin"):
        run_load(spark, source_frames(spark), str(tmp_path), SNAPSHOT)
    assert spark.read.parquet(f"{tmp_path}/published").count() == 0


def rejecting(spark) -> dict[str, SourceFrame]:
    source = SOURCES["oms_orders"]
    text = spark.createDataFrame(
        [(*map(str, r), i) for i, r in enumerate(OMS[:2])] + [("O9", "U1", "P1", "x", "soon", "OVO", "Pending", 9)],
        [f.name for f in source.schema] + ["_arrival"],
    )
    return source_frames(spark) | {"oms_orders": split_rejects(source, text)}


def test_unreadable_rows_stop_a_strict_load(spark, tmp_path):
    with pytest.raises(SourceError, match="oms_orders: 1 unreadable rows"):
        run_load(spark, rejecting(spark), str(tmp_path), SNAPSHOT)


def test_unreadable_rows_are_set_aside_otherwise(spark, tmp_path):
    result = run_load(
        spark, rejecting(spark), str(tmp_path), SNAPSHOT, strict_sources=False, publish_failed_checks=True
    )
    assert result.mart["fact_orders"].count() == 2
    assert "unreadable_rows_oms_orders" in result.failed_checks
    stored = spark.read.parquet(f"{tmp_path}/runs/{result.run_id}/dq_results").where("check_name = 'unreadable_rows_oms_orders'")
    assert [(r.status, r.detail) for r in stored.collect()] == [("FAIL", "1 rows set aside in rejects_stg_oms_orders")]
    aside = spark.read.parquet(f"{tmp_path}/runs/{result.run_id}/rejects_stg_oms_orders").collect()
    assert [(r.order_id, r.bad_columns) for r in aside] == [("O9", "jumlah_barang, order_timestamp")]


def test_sources_without_usable_rows(spark, tmp_path):
    result = run_load(
        spark, source_frames(spark, oms_orders=[], mdm_products=[]), str(tmp_path), SNAPSHOT, publish_failed_checks=True
    )
    assert result.mart["fact_orders"].count() == result.mart["dim_payment_method"].count() == 0
    assert result.mart["orphan_movements"].count() == 6
    assert result.metrics["fact_orders"]["rows"] == 0
    assert kpis.kpi_margin(result.mart).head().margin_pct is None


def test_failed_step_is_logged(spark, tmp_path):
    frames = source_frames(spark)
    broken = frames["oms_orders"].rows.withColumn("jumlah_barang", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        run_load(spark, frames | {"oms_orders": SourceFrame(broken)}, str(tmp_path), SNAPSHOT)
    log = {r.step_name: r.status for r in spark.read.parquet(f"{tmp_path}/etl_run_log").collect()}
    assert log["staging::stg_oms_orders"] == "FAILED"


def test_violating_rows(mart):
    orders, customer = mart["fact_orders"], TABLES["dim_customer"]
    doubled = orders.unionByName(orders.where("order_key = 1"))
    assert [tuple(r) for r in duplicate_keys(doubled, "order_key").collect()] == [(1, 2)]
    blank = mart["dim_customer"].withColumn("kota", F.when(F.col("user_id") != "U1", F.col("kota")))
    assert [r.user_id for r in null_rows(blank.drop(LOADED_AT), customer).collect()] == ["U1"]
    fk = next(k for k in FACTS[0].foreign_keys if k.column == "product_key")
    fewer = mart["dim_product"].where("product_key <> 1")
    assert [tuple(r) for r in dangling_keys(orders, fewer, fk).collect()] == [(1, 2)]


def test_category_risk_beyond_bigint(spark, mart):
    """The repeated totals grow with the square of the data; they are exact beyond 2^63."""
    many = 40_000
    order = mart["fact_orders"].limit(1).withColumn("gross_revenue_idr", F.lit(10**13).cast("bigint"))
    move = mart["fact_inventory_movements"].join(order.select("product_key"), "product_key", "left_semi").limit(1)
    move = move.withColumn("jenis_mutasi", F.lit("ADJUSTMENT_DEFECT")).withColumn("quantity_change", F.lit(2 * 10**9))
    wide = mart.replaced(
        fact_orders=order.crossJoin(spark.range(many)).drop("id"),
        fact_inventory_movements=move.crossJoin(spark.range(many)).drop("id"),
    )
    report = reports.e2_category_risk(wide)
    assert report.dtypes[1:] == [("total_revenue_idr", "decimal(38,0)"), ("total_unit_rusak", "decimal(38,0)")]
    assert report.first().total_revenue_idr == 10**13 * many * many > 2**63


def test_warehouse_names_begin_with_capitals(spark):
    names = ["WH-BANDA_ACEH-01", "WH-JAKARTA BARAT-02", "WH-d'arc-3", "WH-X9Y-1", "WH"]
    rows = dimensions.warehouses(spark.createDataFrame([(n,) for n in names], "warehouse_id string")).collect()
    got = {r.warehouse_id: r.warehouse_name for r in rows}
    assert got == {n: (n.split("-")[1].title() if "-" in n else n) for n in names}


def test_only_queries_are_run(spark, mart):
    other = mart.replaced(fact_orders=mart["fact_orders"].limit(1))
    count = "SELECT count(*) AS n, '{fact_orders}' AS t FROM fact_orders WHERE quantity > :q -- all"
    first, second = (pages.run_query(spark, m, count, {"q": 0}) for m in (mart, other))
    assert first.first().n > 1 and tuple(second.first()) == (1, "{fact_orders}")
    assert pages.run_query(spark, mart, "WITH a AS (SELECT 1 AS x) SELECT x FROM a;").first().x == 1
    for text in ("DROP TABLE fact_orders", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SET x=1"):
        with pytest.raises(ParseException):
            pages.run_query(spark, mart, text)


def test_a_load_in_buckets_shuffles_no_staged_rows_of_facts_and_gives_the_same_mart(spark, tmp_path, monkeypatch):
    """F2-F5, F13, F14: the rows of a fact are dealt to tasks by the files of its staging table, and numbered from files dealt by range."""
    from niaga.operators import keys
    from niaga.plans.pipeline import _build, joined_rows, new_load, open_run

    hours = F.make_dt_interval(hours=(F.col("id") % 500).cast("int"))
    values = {
        "order_id": F.when(F.col("id") % 4000 != 5, F.concat(F.lit("O-"), F.col("id") % 41_000)),
        "user_id": F.when(F.col("id") % 11 != 0, F.concat(F.lit("U"), F.col("id") % 5)),
        "product_id": F.concat(F.lit("P"), F.col("id") % 4),
        "jumlah_barang": (F.col("id") % 9 + 1).cast("int"),
        "order_timestamp": F.lit(dt.datetime(2026, 5, 25)).cast("timestamp_ntz") + hours,
        "metode_pembayaran": F.lit("OVO"),
        "status_order": F.lit("Delivered"),
    }
    orders = spark.range(60_000).where("id % 4000 != 5").select(*(c.alias(n) for n, c in values.items()), F.xxhash64("id").alias("_arrival"))
    orders.repartition(3).write.parquet(str(tmp_path / "in"))
    sources = {**source_frames(spark), "oms_orders": SourceFrame(spark.read.parquet(str(tmp_path / "in")))}

    def load(least: int) -> tuple:
        monkeypatch.setattr(keys, "LEAST_BYTES", least)
        made = new_load(spark, str(tmp_path / f"mart{least}"))
        _build(made, sources, SNAPSHOT, True)
        return made, open_run(spark, made.root, made.run_id)

    monkeypatch.setattr(keys, "LEAST_ROWS", 15_000)
    monkeypatch.setattr(pipeline, "BUCKET_ROWS", 10)
    made, dealt = load(100_000)
    plain, shuffled = load(1 << 40)
    assert "stg_oms_orders" in made.dealt and not plain.dealt
    for name in ("fact_orders", "orphan_orders"):
        got, want = (m[name].drop(LOADED_AT) for m in (dealt, shuffled))
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    staged = made.dealt["stg_oms_orders"][0].schema
    plans = []
    for run, mart in ((made, dealt), (plain, shuffled)):
        joined = joined_rows(run, "fact_orders", {**mart, "stg_oms_orders": run.read("stg_oms_orders", staged)})[0]
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
    assert "REPARTITION_BY_NUM" in plans[1] and "REPARTITION_BY_NUM" not in plans[0]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) in (None, "0")
