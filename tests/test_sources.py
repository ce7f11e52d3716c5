from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from niaga.operators import keep_first
from niaga.schemas import ARRIVAL, SOURCES
from niaga.sources import SourceError, export_csv, read_all, read_csv
from niaga.sources.records import lines
from niaga.sources.testtables import wms

PRODUCTS = "product_id,nama_produk,kategori,harga_modal_idr,harga_jual_idr,is_active"


def write(path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def rows(source) -> list[tuple]:
    return [tuple(r) for r in source.rows.drop(ARRIVAL).collect()]


def test_columns_are_bound_by_name(spark, tmp_path):
    path = write(
        tmp_path / "p.csv",
        "is_active,extra,harga_jual_idr,harga_modal_idr,kategori,product_id,nama_produk",
        'True,zzz,100,60,Home,P1,"Lampu, ""besar"""',
        "False,zzz,200.0,NaN,Home,P2,Kursi",
        ",zzz,200,10,None,P3, Meja",
    )
    source = read_csv(spark, "mdm_products", path)
    # the cost of P2 is required, so the row is set apart; the blank flag of P3 is no value
    assert rows(source) == [
        ("P1", 'Lampu, "besar"', "Home", 60, 100, True),
        ("P3", " Meja", None, 10, 200, None),
    ]
    assert [r.bad_columns for r in source.rejects.collect()] == ["harga_modal_idr"]
    assert source.rows.drop(ARRIVAL).dtypes == [
        (f.name, f.dataType.simpleString()) for f in SOURCES["mdm_products"].schema
    ]


def test_bad_values_are_set_apart_with_their_text(spark, tmp_path):
    path = write(
        tmp_path / "o.csv",
        "order_id,user_id,product_id,jumlah_barang,order_timestamp,metode_pembayaran,status_order",
        "O1,U1,P1,2,2026-06-01 10:00:00,OVO,Delivered",
        "O2,U1,P1,two,2026-06-01 10:00:00,OVO,Delivered",
        "O3,U1,P1,1.5,soon,OVO,Delivered",
        "O4,U1,P1,1,,OVO,Delivered",
        "O5,,P1,3,2026-06-02,OVO,Delivered",
    )
    source = read_csv(spark, "oms_orders", path)
    assert rows(source) == [
        ("O1", "U1", "P1", 2, dt.datetime(2026, 6, 1, 10), "OVO", "Delivered"),
        ("O5", None, "P1", 3, dt.datetime(2026, 6, 2), "OVO", "Delivered"),
    ]
    bad = {r.order_id: (r.bad_columns, r.jumlah_barang) for r in source.rejects.collect()}
    assert bad == {
        "O2": ("jumlah_barang", "two"),
        "O3": ("jumlah_barang, order_timestamp", "1.5"),
        "O4": ("order_timestamp", "1"),
    }


def test_rows_with_surplus_fields_are_set_apart(spark, tmp_path):
    """They may hold a stray separator anywhere, so none of their values is used. Short rows have no value at the end."""
    path = write(
        tmp_path / "o.csv",
        "order_id,user_id,product_id,jumlah_barang,order_timestamp,metode_pembayaran,status_order",
        "O1,U1,P1,2,2026-06-01 10:00:00,OVO,Delivered",
        "O2,U1,P1,2,2026-06-01 10:00:00,OVO,Deliv,ered,EXTRA",
        "O3,U1,P1,2,2026-06-01 10:00:00,OVO,Delivered,",
        'O4,U1,P1,2,2026-06-01 10:00:00,"OVO, or cash",Delivered',
        'O5,U1,P1,2,2026-06-01 10:00:00,"OVO, or cash",Delivered,"x, y"',
        "O6,U1,P1,2,2026-06-01 10:00:00",
    )
    source = read_csv(spark, "oms_orders", path)
    got = {r.order_id: (r.metode_pembayaran, r.status_order) for r in source.rows.collect()}
    bad = {r.order_id: (r.bad_columns, r.record) for r in source.rejects.collect()}
    assert {k: v for k, v in got.items() if k != "O6"} == {"O1": ("OVO", "Delivered"), "O4": ("OVO, or cash", "Delivered")}
    assert {k for k, (reason, _) in bad.items() if "surplus fields" in reason} == {"O2", "O3", "O5"}
    assert bad["O2"][1].endswith("Deliv,ered,EXTRA")
    assert "O6" in got or bad["O6"][0] == "metode_pembayaran, status_order"


def test_missing_source(spark, tmp_path):
    with pytest.raises(SourceError, match="'mdm_products' not found"):
        read_csv(spark, "mdm_products", str(tmp_path / "none.csv"))


def test_missing_column(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,nama_produk,kategori,harga_jual_idr", "P1,a,b,1")
    with pytest.raises(SourceError, match="lacks columns: harga_modal_idr, is_active"):
        read_csv(spark, "mdm_products", path)


@pytest.mark.parametrize("lines", [(), (PRODUCTS,)])
def test_empty_source(spark, tmp_path, lines):
    path = tmp_path / "p.csv"
    path.write_text("".join(line + "\n" for line in lines))
    with pytest.raises(SourceError, match="is empty"):
        read_csv(spark, "mdm_products", str(path))


def test_all_sources_must_be_named(spark, tmp_path):
    with pytest.raises(SourceError, match="missing or not declared"):
        read_all(spark, {"mdm_products": "x"})


def test_first_row_of_a_key_over_files_and_splits(spark, tmp_path):
    """Arrival order is file, then position, also when one file is read by many tasks."""
    folder = tmp_path / "p"
    folder.mkdir()
    for part in range(3):
        lines = [f"K{(i * 7) % 500},n{part}-{i},c,1,2,True" for i in range(3000)]
        write(folder / f"part-{part}.csv", PRODUCTS, *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        source = read_csv(spark, "mdm_products", str(folder))
        assert source.rows.rdd.getNumPartitions() > 6
        kept = {r.product_id: r.nama_produk for r in keep_first(source.rows, "product_id").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert kept == {f"K{(i * 7) % 500}": f"n0-{i}" for i in range(500)}


def test_header_of_every_file_is_checked(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    write(folder / "a.csv", PRODUCTS, "P1,a,b,1,2,True")
    write(folder / "b.csv", "nama_produk,product_id,kategori,harga_modal_idr,harga_jual_idr,is_active", "a,P2,b,1,2,True")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, "mdm_products", str(folder)).rows.collect()


def test_movements_do_not_shuffle_the_order_lines_for_a_small_supplier_table(spark, tmp_path):
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    rows = {
        "lineitem": ([(i, i % 60, i % 5, 1, 2.0, 9.0, 0.0, 0.0, "R", "F", dt.datetime(1995, 1, 3)) for i in range(40000)], line),
        "supplier": ([(0, 1), (1, 2), (2, 1), (3, None), *((k, 1) for k in range(10, 2000))], "s_suppkey bigint, s_nationkey bigint"),  # the fifth is unknown
        "nation": ([(1, "NATION_1", 7), (2, "NATION_2", 8)], "n_nationkey bigint, n_name string, n_regionkey bigint"),
        "region": ([(7, "ASIA"), (8, "MIDDLE EAST")], "r_regionkey bigint, r_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    moves = wms(spark, str(tmp_path))
    size = sum(f.stat().st_size for f in (tmp_path / "supplier.parquet").glob("*.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * size))
    try:
        plan = moves._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan, plan
    found = moves.groupBy("warehouse_id").count().collect()
    assert {r[0]: r[1] for r in found} == {"WH-ASIA-01": 16000, "WH-MIDDLE EAST-02": 8000}


def test_export_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("P1", 'a "b", c', "x", 1, 2, True)], SOURCES["mdm_products"].schema)
    export_csv(df, str(tmp_path / "out"))
    assert rows(read_csv(spark, "mdm_products", str(tmp_path / "out"))) == [tuple(df.head())]


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    path = write(tmp_path / "p.csv", PRODUCTS, 'P1,"two\nlines",b,1,2,True')
    source = read_csv(spark, "mdm_products", path, multi_line=True)
    assert rows(source) == [("P1", "two\nlines", "b", 1, 2, True)]
    assert source.rows.select(F.col(ARRIVAL)["file"]).head()[0] == "p.csv"


@pytest.fixture
def small_splits(spark):
    """Sessions read files of some hundred bytes in many tasks."""
    keys = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


CELLS = ["a", "", "x y", 'say ""hi""', "line\nbreak", "a,b", "\n", "\n\n,", '""', 'two\r\nmore""\n', 'mid "" quote,\n"",', "long " * 60, "deep\n" * 90]


def cell(random, text):
    return f'"{text}"' if random.random() < 0.4 or set(text) & set('\n\r,"') else text


@pytest.mark.parametrize("seed", range(2))
def test_quoted_line_breaks_in_files_read_by_many_tasks(spark, tmp_path, small_splits, seed):
    """Cells with breaks, quotes and separators, longer than a task's block too, equal those of a sequential reader."""
    import csv
    import random

    r = random.Random(seed)
    ends = "\r\n" if seed % 2 else "\n"
    folder = tmp_path / "in"
    folder.mkdir()
    expected = []
    for part in range(3):
        body = [[f"P{part}-{i}", r.choice(CELLS), r.choice(CELLS[:3 if part == 1 else None]), "1", "2", "True"] for i in range(60)]
        text = PRODUCTS + ends + ends.join(",".join(cell(r, c) for c in row) for row in body) + ends
        (folder / f"{part}.csv").write_bytes(text.encode())
        with open(folder / f"{part}.csv", newline="") as f:
            expected += [row for row in csv.reader(f)][1:]
    source = read_csv(spark, "mdm_products", str(folder), null_tokens=("",))
    assert lines(spark, str(folder)).rdd.getNumPartitions() > 20  # of three files
    got = source.rows.orderBy(ARRIVAL).collect()
    assert [(x.product_id, x.nama_produk, x.kategori) for x in got] == [(a, b or None, c or None) for a, b, c, *_ in expected]
    assert source.rejects.isEmpty()


def test_a_quote_inside_an_unquoted_cell_is_text(spark, tmp_path, small_splits):
    body = [f'P{i},pipe {i}" wide,b,1,2,True' for i in range(30)] + ['Q,"a\nb",c,1,2,True', 'R,"x" y"z,c,1,2,True', "S,t,u,1,2,True"]
    source = read_csv(spark, "mdm_products", write(tmp_path / "p.csv", PRODUCTS, *body))
    names = {r.product_id: r.nama_produk for r in source.rows.collect()}
    assert len(names) == 33 and names["P7"] == 'pipe 7" wide' and names["Q"] == "a\nb" and names["S"] == "t"


def test_an_unclosed_cell_and_surplus_cells_are_set_apart(spark, tmp_path, small_splits):
    body = ['P1,"two\nlines",b,1,2,True', 'P2,"x\ny",b,1,2,True,more', "P3,short", 'P4,ok,b,1,2,True', 'P5,"never closed,b', "1,2,True"]
    source = read_csv(spark, "mdm_products", write(tmp_path / "p.csv", PRODUCTS, *body))
    assert sorted(r.product_id for r in source.rows.collect()) == ["P1", "P4"]
    rejects = {(r.product_id or "")[:2]: r for r in source.rejects.collect()}
    assert set(rejects) == {"P2", "P3", "P5"}
    assert rejects["P2"].record == 'P2,"x\ny",b,1,2,True,more' and rejects["P5"].record.endswith("1,2,True")
    assert rejects["P3"].record is None


def test_files_with_breaks_and_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", PRODUCTS, 'P1,"two\nlines",b,1,2,True')
    write(folder / "b.csv", PRODUCTS.replace("kategori", "other"), "P2,x,b,1,2,True")
    with pytest.raises(SourceError, match="header"):
        read_csv(spark, "mdm_products", str(folder))


def test_command_line_loads_and_reports(spark, tmp_path, capsys):
    """CSV files in, a published mart, a report out, and exit status 1 for a failed check."""
    from conftest import CRM, MDM, OMS, WEB, WMS

    from niaga.__main__ import main

    folder = tmp_path / "in"
    folder.mkdir()
    for name, data in {
        "crm_user_profiles": CRM, "mdm_products": MDM, "oms_orders": OMS,
        "web_clickstream_logs": WEB, "wms_inventory_movements": WMS,
    }.items():
        header = ",".join(f.name for f in SOURCES[name].schema)
        body = [",".join("" if v is None else str(v) for v in row) for row in data]
        write(folder / f"{name}.csv", header, *body)
    root = str(tmp_path / "root")
    assert main(["load", "--root", root, "--input", str(folder), "--allow-failed-checks"]) == 1
    assert main(["report", "b2_top_customers", "--root", root, "--csv", str(tmp_path / "out")]) == 0
    out = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert [tuple(r)[:2] + (r.total_belanja_idr,) for r in out.collect()] == [("U2", "Budi", "800"), ("U1", "Ani", "200")]
    assert main(["report", "a4_status_share", "--root", root]) == 0
    assert "Cancelled" in capsys.readouterr().out
    window = ["--first", "2026-06-01", "--last", "2026-06-03"]
    assert main(["report", "e1_daily_summary", "--root", root, *window]) == 0
    capsys.readouterr()
    assert main(["report", "e1_daily_summary", "--root", root]) == 0  # from the first to the last day with an order
    assert main(["report", "sales_detail", "--root", root, "--where", "kota=Nowhere"]) == 0
    printed = capsys.readouterr().out.strip().splitlines()
    assert printed[-1].startswith("order_id") and len(printed) > 2


def test_printed_reports_are_whole(spark, capsys):
    from niaga.__main__ import _print

    _print(spark.range(0, 250, 1, 3).withColumn("none", F.lit(None)))
    assert len(capsys.readouterr().out.splitlines()) == 251
