"""Every registered query against its DuckDB counterpart, and the order of ordered reports."""

from __future__ import annotations

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from niaga.operators import constraints, quality
from niaga.plans import catalog
from niaga.plans.faults import CHECKED, with_faults
from oracle import oracle_sql

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLES = oracle_sql()

# Report order: column, or -column for descending.
ORDER = {
    "a1_monthly_kpi": ["year", "month"],
    "a2_category_revenue": ["-total_revenue_idr"],
    "a3_top_products": ["-total_revenue_idr", "product_id"],
    "a4_status_share": ["-jumlah_order"],
    "a5_payment_pref": ["-total_revenue_idr"],
    "a6_city_revenue": ["-total_revenue_idr"],
    "b1_tier_segment": ["-total_revenue_idr"],
    "b2_top_customers": ["-total_belanja_idr", "user_id"],
    "b3_dormant": ["-tenure_days_as_of_load", "user_id"],
    "c1_funnel": ["funnel_order"],
    "c2_page_latency": ["-avg_response_time_ms"],
    "c3_device_split": ["-total_hit"],
    "c4_conversion": ["-conversion_rate_pct"],
    "d1_low_stock": ["estimasi_stok_bersih", "product_id", "warehouse_name"],
    "d3_top_defects": ["-total_unit_rusak", "product_id"],
    "e1_daily_summary": ["full_date"],
    "e2_category_risk": ["-total_revenue_idr"],
    "chart_daily_revenue": ["full_date"],
    "chart_funnel": ["funnel_order"],
    "chart_device": ["-n"],
    "chart_top_products": ["-revenue", "nama_produk"],
    "distinct_values": ["column_name", "value"],
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(ORDER))
def test_report_order(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    ordered = list(rows)
    for column in reversed(ORDER[name]):  # stable sorts, last key first
        ordered.sort(key=lambda r, c=column.lstrip("-"): r[c], reverse=column.startswith("-"))
    assert rows == ordered


def test_movement_types_in_report_order(spark):
    kinds = ["INBOUND", "RETUR_STOCK", "OUTBOUND", "ADJUSTMENT_DEFECT"]
    rows = QUERIES["d2_movement_summary"](spark, SF_DIR).collect()
    place = [(r.warehouse_name, kinds.index(r.jenis_mutasi)) for r in rows]
    assert place == sorted(place)


@pytest.mark.parametrize("name", [f"{name}_faulty" for name in CHECKED])
def test_faults_are_found(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    if name.startswith("constraint"):
        assert sum(r.violations > 0 for r in rows) >= 7
    elif name == "dq_suite_faulty":
        assert {r.status for r in rows} == {"FAIL"}
    else:
        assert rows


def test_bitmaps_tell_whether_primary_keys_hold(spark):
    mart = catalog.mart_of(spark, SF_DIR)
    assert constraints.primary_keys_hold(mart)
    assert not constraints.primary_keys_hold(with_faults(mart))
    for table, key in (("fact_orders", "order_key"), ("dim_page", "page_key")):
        twice = mart[table].unionByName(mart[table].where(f"{key} = 3"))
        assert not constraints.primary_keys_hold(mart.replaced(**{table: twice}))


def test_ids_of_the_audit_table_are_not_shared(spark):
    log = catalog.mart_of(spark, SF_DIR)["etl_run_log"]
    assert log.select("run_id").distinct().count() == log.count()


def test_one_large_shuffle(spark):
    """Low stock and the funnel join the small dimension before the one shuffle of the fact's rows."""
    for name in ("d1_low_stock", "chart_funnel"):
        df = QUERIES[name](spark, SF_DIR)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # each shuffled aggregate of the fact: a funnel counts distinct sessions in a second, small one
        assert plan.count("Exchange hashpartitioning") <= (1 if name == "d1_low_stock" else 2), plan


def test_audit_history_is_newest_first(spark):
    rows = quality.dq9_audit_history(catalog.mart_of(spark, SF_DIR)).collect()
    assert rows[0].started_at is not None
    assert [r.step_name for r in rows][0] == "fact::fact_web_clickstream"
    assert len(rows) == 15 and {r.status for r in rows} == {"SUCCESS"}


def test_totals_agree_between_reports(spark):
    def total(name, column):
        return sum(r[column] or 0 for r in QUERIES[name](spark, SF_DIR).collect())

    kpi = QUERIES["kpi_summary"](spark, SF_DIR).head()
    for name, column in (
        ("a1_monthly_kpi", "total_revenue_idr"),
        ("a2_category_revenue", "total_revenue_idr"),
        ("a5_payment_pref", "total_revenue_idr"),
        ("a6_city_revenue", "total_revenue_idr"),
        ("b1_tier_segment", "total_revenue_idr"),
        ("e1_daily_summary", "total_revenue_idr"),
        ("e2_category_risk_fixed", "total_revenue_idr"),
        ("chart_daily_revenue", "revenue"),
    ):
        assert total(name, column) == kpi.total_revenue, name
    assert total("a4_status_share", "jumlah_order") == kpi.total_orders
    assert total("e1_daily_summary", "total_order") == kpi.total_orders
    assert total("ins_net_stock_by_wh", "net_stock") == kpi.net_stock_change


def test_no_report_plans_a_cross_join(spark):
    for name, query in QUERIES.items():
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_entry(spark):
    assert entry.entry(spark).count() == 1
