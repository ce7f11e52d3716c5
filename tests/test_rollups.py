"""Stored roll-ups: one scan of a fact for all of them, the smallest that covers a report answers, others go to the fact."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import source_frames

from niaga.plans import catalog, kpis, pages, reports
from niaga.plans.pipeline import open_latest, run_load
from niaga.plans.rollups import (
    ROLLUPS,
    RolledUp,
    _sums,
    folder_of,
    grouped,
    open_rolled_up,
    sessions,
    store_rollups,
    whole_months,
)

SF_DIR = "/root/testdata/sf0.001"
FACTS = ("fact_orders", "fact_inventory_movements", "fact_web_clickstream")


@pytest.fixture(scope="module")
def mart(spark):
    return catalog.rolled_up(spark, SF_DIR)


def scanned(df):
    """The facts whose own files a frame reads; "rollups" for stored roll-ups."""
    read = set()
    for path in df.inputFiles():
        stored = "/rollups" in path
        read |= {"rollups"} if stored else {fact for fact in FACTS if f"/{fact}/" in path}
    return read


def test_one_scan_makes_all_rollups_of_a_fact(spark, mart):
    for fact in FACTS:
        plan = _sums(mart[fact], fact)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1, plan


@pytest.mark.parametrize("name", catalog.ROLLED_UP)
def test_reports_read_no_fact(mart, name):
    read = scanned(catalog.REPORTS[name](mart))
    assert read == {"rollups"}, read


def test_the_smallest_rollup_that_covers_answers(spark):
    small, large = spark.range(1), spark.range(2)
    by_day, by_product, by_customer, by_both = (r for r in ROLLUPS if r.fact == "fact_orders")
    m = RolledUp({}, {by_both: (large, 90), by_day: (small, 10)})
    assert m.covering("fact_orders", ["date_key"]) is small
    assert m.covering("fact_orders", ["date_key", "product_key"]) is large
    assert m.covering("fact_orders", ["customer_key"]) is None
    assert m.covering("fact_orders", ["date_key", "customer_key"]) is None
    assert RolledUp({}, {by_both: (large, 9), by_day: (small, 10)}).covering("fact_orders", ["date_key"]) is large


def test_filters_that_no_rollup_holds_go_to_the_fact(mart):
    days = (dt.date(2024, 1, 5), dt.date(2024, 1, 24))
    months = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert whole_months(*months) and not whole_months(*days)
    report = reports.a6_city_revenue
    assert "fact_orders" in scanned(report(pages.apply_filters(mart, {}, days)))
    assert "fact_orders" not in scanned(report(pages.apply_filters(mart, {}, months)))
    assert "fact_orders" not in scanned(report(pages.apply_filters(mart, {"status_order": ["Delivered"], "kota": ["NATION_1"]})))
    assert "fact_orders" in scanned(report(pages.apply_filters(mart, {"kategori": ["ECONOMY"]})))
    plain = catalog.mart_of(mart["fact_orders"].sparkSession, SF_DIR)
    for chosen in (days, months):
        for choices in ({}, {"status_order": ["Delivered"], "kota": ["NATION_1"]}, {"kategori": ["ECONOMY"]}):
            got = report(pages.apply_filters(mart, choices, chosen)).collect()
            assert got == report(pages.apply_filters(plain, choices, chosen)).collect()


def test_a_replaced_fact_is_not_answered_from_its_rollups(mart):
    none = mart.replaced(fact_orders=mart["fact_orders"].limit(0))
    assert kpis.ins_fulfilment_rates(none).head().delivered_pct is None
    assert {r.fact for r in none.rollups} == set(FACTS) - {"fact_orders"}


def test_sketches_of_days_merge_to_the_estimate_of_all(mart):
    plain = catalog.mart_of(mart["fact_orders"].sparkSession, SF_DIR)
    exact = plain["fact_web_clickstream"].select("session_id").distinct().count()
    merged, whole = (sessions(m, []).head().sessions for m in (mart, plain))
    assert abs(merged - exact) <= 0.033 * exact and abs(whole - exact) <= 0.033 * exact
    assert "fact_web_clickstream" not in scanned(sessions(mart, ["page_key"]))


def test_a_published_run_with_rollups(spark, tmp_path):
    """Rows without a customer, an empty fact, and a run without roll-ups."""
    root = str(tmp_path / "root")
    done = run_load(spark, source_frames(spark, wms_inventory_movements=[]), root, dt.date(2026, 7, 1), publish_failed_checks=True)
    assert not isinstance(open_rolled_up(spark, root), RolledUp)
    store_rollups(spark, done.mart, folder_of(root, done.run_id))
    with_them, without = open_rolled_up(spark, root), open_latest(spark, root)
    assert isinstance(with_them, RolledUp) and len(with_them.rollups) == len(ROLLUPS)
    for report in (reports.a1_monthly_kpi, reports.b3_dormant, reports.c2_page_latency, reports.d2_movement_summary, kpis.kpi_summary):
        assert report(with_them).collect() == report(without).collect()
    assert grouped(with_them, "fact_inventory_movements", [], ["n", "signed_quantity"]).collect() == [(0, None)]
