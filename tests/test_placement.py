"""Facts on a space-filling curve: the same rows, and filters that skip most row groups."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from conftest import source_frames
from pyspark.sql import functions as F

from niaga.plans import catalog, pages
from niaga.plans.pipeline import run_load
from niaga.plans.placement import BITS, CODES, CURVES, chosen_codes, code_name, codes_of, interleaved, placed, placed_folder, store_placed
from niaga.plans.rollups import open_rolled_up
from niaga.schemas import TABLES

SF_DIR = "/root/testdata/sf0.01"
FILES = 128


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """(the mart as loaded, its folder of placed facts, the mart placed in many small files)."""
    mart = catalog.mart_of(spark, SF_DIR)
    folder = str(tmp_path_factory.mktemp("placed"))
    return mart, folder, store_placed(spark, mart, folder, mart["fact_orders"].count() // FILES)


def read(mart, folder, fact, choices):
    """(row groups whose smallest and largest codes admit the choices, all row groups)."""
    codes = {c: chosen_codes(mart, c, values) for c, values in choices.items()}
    admitted = total = 0
    for path in glob.glob(f"{folder}/{fact}/*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            spans = {c: meta.row_group(g).column(names.index(code_name(c))).statistics for c in codes}
            total += 1
            admitted += all(any(spans[c].min <= v <= spans[c].max for v in codes[c]) for c in codes)
    return admitted, total


@pytest.mark.parametrize(
    "fact, choices, most",
    [
        ("fact_orders", {"kategori": ["ECONOMY"], "kota": ["NATION_3"]}, 0.1),
        ("fact_orders", {"kota": ["NATION_3"]}, 0.35),
        ("fact_orders", {"kategori": ["PROMO"]}, 0.45),
        ("fact_inventory_movements", {"kategori": ["ECONOMY"], "warehouse_name": ["Asia"]}, 0.15),
    ],
)
def test_filters_skip_row_groups(spark, stored, fact, choices, most):
    mart, folder, placed = stored
    admitted, total = read(placed, folder, fact, choices)
    assert total >= 100 and 0 < admitted <= most * total, (admitted, total)
    rows = pages.apply_filters(placed, choices)[fact]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PushedFilters") :]
    assert all(code_name(c) in scan.split("ReadSchema")[0] for c in choices), plan
    key = TABLES[fact].primary_key
    expected = pages.apply_filters(mart, choices)[fact]
    assert sorted(r[0] for r in rows.select(key).collect()) == sorted(r[0] for r in expected.select(key).collect())


def test_the_same_rows(stored):
    mart, _, placed = stored
    for fact in CURVES:
        names = [f.name for f in TABLES[fact].stored_schema]
        a, b = mart[fact].select(names), placed[fact].select(names)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_codes_spread_by_shares_of_the_rows(spark):
    dim = spark.createDataFrame([("b",)] * 2 + [("a",)] + [("c",)] + [(None,)], "kota string")
    assert {r.value: r.code for r in codes_of(dim, "kota").collect()} == {"a": 0, "b": 256, "c": 768}


def test_codes_are_attached_without_a_shuffle_of_the_fact(spark, stored):
    """Spark knows how small a dimension is, so long as its values are not joined to their codes before."""
    mart, folder, _ = stored
    codes = spark.read.parquet(f"{folder}/{CODES}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30KB")  # above what is read of a dimension here
    try:
        plans = [placed(mart, codes, fact, 4)._jdf.queryExecution().executedPlan().toString() for fact in CURVES]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 4, plan


def test_a_value_that_no_member_has(stored):
    assert pages.apply_filters(stored[2], {"kota": ["nowhere"]})["fact_orders"].isEmpty()


def test_interleaving(spark):
    rows = [(5, 1023, 0), (0, 0, 1), (512, 0, 0)]
    got = spark.createDataFrame(rows, "a int, b int, c int").select("a", "b", "c", interleaved([F.col("a"), F.col("b"), F.col("c")]).alias("z"))
    for a, b, c, z in got.collect():
        assert z == sum(((code >> bit) & 1) << (3 * bit + i) for bit in range(BITS) for i, code in enumerate((a, b, c)))


def test_a_published_run_that_is_placed(spark, tmp_path):
    """Hits without a customer stay, empty facts too."""
    root = str(tmp_path / "root")
    done = run_load(spark, source_frames(spark, wms_inventory_movements=[]), root, dt.date(2026, 7, 1), publish_failed_checks=True)
    assert code_name("kota") not in open_rolled_up(spark, root)["fact_orders"].columns
    store_placed(spark, done.mart, placed_folder(root, done.run_id))
    mart = open_rolled_up(spark, root)
    assert mart["fact_inventory_movements"].isEmpty()
    hits = {r.log_id: r[code_name("kota")] for r in mart["fact_web_clickstream"].collect()}
    assert len(hits) == done.mart["fact_web_clickstream"].count() and hits["L4"] is None and hits["L1"] is not None
    chosen = pages.apply_filters(mart, {"kota": ["Medan"]})
    assert {r.log_id for r in chosen["fact_web_clickstream"].collect()} == {"L6"}
