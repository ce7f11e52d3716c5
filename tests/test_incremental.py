"""Loads on top of a published run: equal to a full load, with the keys of the last one, and only changed months written."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import CRM, MDM, OMS, WEB, WMS, at, source_frames
from pyspark.sql import functions as F

from niaga.plans import pipeline
from niaga.plans.incremental import Overtaken, months_written, run_incremental
from niaga.plans.pipeline import claim, latest_run, open_latest, run_load
from niaga.schemas import LOADED_AT, MONTH, TABLES

DAY = dt.date(2026, 7, 1)
KEYS = {"customer_key": "user_id", "product_key": "product_id", "payment_method_key": "payment_method_code"}
KEYS |= {"warehouse_key": "warehouse_id", "page_key": "page_url", "device_key": "device_type_code"}
DIM_OF = {t.primary_key: t for t in TABLES.values() if not t.is_fact and t.natural_key}


def orders(n, changed=()):
    """Orders over four months; those in ``changed`` are bought twice as often."""
    return [
        (f"O{i:03}", f"U{i % 3 + 1}", f"P{i % 3 + 1}", 2 if i in changed else 1, at(f"2026-{3 + i % 4:02}-{1 + i % 27:02} 10:00:00"), "OVO", "Delivered")
        for i in range(n)
    ]


def natural(mart, name):
    """The rows of a table without surrogate keys: members by their natural keys."""
    table, df = TABLES[name], mart[name].drop(LOADED_AT, MONTH)
    for key, dim in DIM_OF.items():
        if key in df.columns and key != table.primary_key:
            df = df.join(mart[dim.name].select(key, F.col(dim.natural_key).alias(f"of_{key}")), key, "left").drop(key)
    own = [c for c in df.columns if c != table.primary_key or name == "dim_date"]
    return sorted(map(repr, df.select(sorted(own)).collect()))


def keys(mart, name):
    table = TABLES[name]
    return {r[0]: r[1] for r in mart[name].select(table.natural_key, table.primary_key).collect()}


def same_as_full(spark, mart, sources, tmp_path, label):
    full = run_load(spark, sources, str(tmp_path / label), DAY, publish_failed_checks=True).mart
    for name in TABLES:
        assert natural(mart, name) == natural(full, name), name
    for name in ("orphan_orders", "orphan_movements"):
        assert sorted(map(repr, mart[name].collect())) == sorted(map(repr, full[name].collect()))


def written(spark, root, run):
    return {r.table: (r.months, r.written) for r in months_written(spark, root, run).collect()}


def test_three_loads(spark, tmp_path):
    root = str(tmp_path / "root")
    load = lambda sources: run_incremental(spark, sources, root, DAY, publish_failed_checks=True)
    crm = [*CRM[:2], *CRM[3:]]
    first = load(source_frames(spark, oms_orders=orders(80), crm_user_profiles=crm, mdm_products=MDM))  # a full load: there is no run yet
    held = {name: keys(first.mart, name) for name in ("dim_customer", "dim_product", "fact_orders", "fact_web_clickstream")}

    # an order of April is changed, one of June is added, a customer who sorts before all others is new
    crm2 = [("A0", "Adi", "a@y.id", "Medan", "Gold", at("2026-06-01 00:00:00")), *crm]
    oms2 = orders(81, changed={5})[:-1] + [("A-new", "A0", "P1", 1, at("2026-06-09 10:00:00"), "OVO", "Shipped")]
    sources = source_frames(spark, oms_orders=oms2, crm_user_profiles=crm2)
    second = load(sources)
    assert written(spark, root, second.run_id) == {
        "fact_orders": (4, 2), "fact_inventory_movements": (1, 0), "fact_web_clickstream": (1, 0),
    }
    for name, before in held.items():
        now = keys(second.mart, name)
        assert {k: now[k] for k in before} == before, name
    assert keys(second.mart, "dim_customer")["A0"] == max(held["dim_customer"].values()) + 1
    assert keys(second.mart, "fact_orders")["A-new"] == 81
    same_as_full(spark, second.mart, sources, tmp_path, "full2")

    # an order and a customer go, then the customer returns under the old key; a removed order's key is not given again
    third = load(source_frames(spark, oms_orders=oms2[:-1], crm_user_profiles=crm))
    assert "A0" not in keys(third.mart, "dim_customer") and "A-new" not in keys(third.mart, "fact_orders")
    sources = source_frames(spark, oms_orders=[*oms2[:-1], ("Z", "A0", "P1", 1, at("2026-06-10 10:00:00"), "OVO", "Shipped")], crm_user_profiles=crm2)
    fourth = load(sources)
    assert keys(fourth.mart, "dim_customer")["A0"] == keys(second.mart, "dim_customer")["A0"]
    assert keys(fourth.mart, "fact_orders")["Z"] == 82
    assert written(spark, root, fourth.run_id)["fact_orders"] == (4, 1)
    same_as_full(spark, open_latest(spark, root), sources, tmp_path, "full4")


def test_the_joined_rows_are_written_once_and_read_by_all_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "_remove", lambda *_: None)  # rows before they were numbered stay
    root = str(tmp_path / "root")
    run_load(spark, source_frames(spark), root, DAY, publish_failed_checks=True)
    done = run_incremental(spark, source_frames(spark, oms_orders=OMS[:-1]), root, DAY, publish_failed_checks=True)
    joined = spark.read.parquet(f"{root}/runs/{done.run_id}/ordered/fact_orders-joined")
    assert sorted(r.order_id for r in joined.collect()) == [f"O{i}" for i in range(1, 7)]
    assert written(spark, root, done.run_id)["fact_orders"] == (1, 1) and keys(done.mart, "fact_orders").keys() == {"O1", "O2", "O6"}


def test_a_price_touches_the_months_of_its_orders_and_a_late_product_makes_facts(spark, tmp_path):
    root = str(tmp_path / "root")
    one = [("O1", "U1", "P1", 1, at("2026-03-01 10:00:00"), "OVO", "Delivered"), ("O2", "U1", "P2", 1, at("2026-04-01 10:00:00"), "OVO", "Delivered"),
           ("O3", "U1", "P9", 1, at("2026-05-01 10:00:00"), "OVO", "Delivered")]
    load = lambda mdm: run_incremental(spark, source_frames(spark, oms_orders=one, mdm_products=mdm), root, DAY, publish_failed_checks=True)
    first = load(MDM)
    assert {r.order_id for r in first.mart["orphan_orders"].collect()} == {"O3"}
    dearer = load([(*p[:4], 101, p[5]) if p[0] == "P1" else p for p in MDM])
    assert written(spark, root, dearer.run_id)["fact_orders"] == (2, 1)
    assert {r.order_id: r.unit_price_idr for r in dearer.mart["fact_orders"].collect()}["O1"] == 101
    late = [*MDM, ("P9", "Late", "Home", 5, 10, True)]
    arrived = load(late)
    assert arrived.mart["orphan_orders"].isEmpty() and keys(arrived.mart, "fact_orders") == {"O1": 1, "O2": 2, "O3": 3}
    assert written(spark, root, arrived.run_id)["fact_orders"] == (3, 2)  # May is new, and March has its old price again
    same_as_full(spark, arrived.mart, source_frames(spark, oms_orders=one, mdm_products=late), tmp_path, "full")


def test_a_load_that_was_overtaken_starts_again_or_gives_up(spark, tmp_path):
    root = str(tmp_path / "root")
    frames = source_frames(spark, crm_user_profiles=CRM, mdm_products=MDM, oms_orders=OMS, web_clickstream_logs=WEB, wms_inventory_movements=WMS)
    base = run_load(spark, frames, root, DAY, publish_failed_checks=True)
    path = f"{root}/claims/after-{base.run_id}"
    assert claim(spark, path) and not claim(spark, path)  # of two loads one is first
    with pytest.raises(Overtaken):
        run_incremental(spark, frames, root, DAY, publish_failed_checks=True)
    assert latest_run(spark, root) == base.run_id
