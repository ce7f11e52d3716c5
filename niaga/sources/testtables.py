"""The five sources, derived from the generated test tables.

Every row of the tables is kept. The mapping plants what they lack by changing
references (unknown users and products) and by adding the suppliers as customers,
who never order; duplicated order lines are already there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from niaga.functions import date_key, div_exact
from niaga.schemas import ARRIVAL
from niaga.sources.files import SourceFrame

LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def _fold(ts: Column) -> Column:
    """Bring 1995-2001 dates into the 30 days the events cover."""
    days = F.datediff(F.to_date(ts), F.lit("1995-01-01").cast("date")) % 30
    return F.date_add(F.lit("2024-01-01").cast("date"), days).cast("timestamp_ntz")


def _user(key: Column) -> Column:
    """A hundredth of the references names a user that CRM does not have."""
    return F.when(key % 100 == 99, _text("USR-X", key)).otherwise(_text("USR-", key))


def _product(key: Column) -> Column:
    """A fiftieth of the references names a product that MDM does not have."""
    return F.when(key % 50 == 49, _text("PROD-X", key)).otherwise(_text("PROD-", key))


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = [
        _table(spark, sf_dir, table).select(
            F.lit(prefix).alias("prefix"),
            F.col(f"{c}_{key}").alias("id"),
            F.col(f"{c}_name").alias("name"),
            F.col(f"{c}_nationkey").alias("nation"),
            F.col(f"{c}_acctbal").alias("balance"),
        )
        for table, prefix, c, key in (("customer", "", "c", "custkey"), ("supplier", "S", "s", "suppkey"))
    ]
    balance = F.col("balance")
    tier = (
        F.when(balance >= 7500, "Platinum")
        .when(balance >= 5000, "Gold")
        .when(balance >= 2500, "Silver")
        .otherwise("Standard")
    )
    signup = F.date_add(
        F.lit("2023-01-01").cast("date"), (F.col("id") % 365).cast("int")
    ).cast("timestamp_ntz")
    return (
        people[0]
        .unionByName(people[1])
        .join(_table(spark, sf_dir, "nation"), F.col("nation") == F.col("n_nationkey"))
        .select(
            _text("USR-", F.col("prefix"), F.col("id")).alias("user_id"),
            F.col("name").alias("nama_lengkap"),
            _text(F.lower("prefix"), "u", F.col("id"), "@example.com").alias("email"),
            F.col("n_name").alias("kota"),
            tier.alias("account_tier"),
            signup.alias("signup_timestamp"),
            F.struct("prefix", "id").alias(ARRIVAL),
        )
    )


def mdm(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    cost = div_exact(price * (50 + F.col("p_size")), F.lit(100))
    return (
        _table(spark, sf_dir, "part").select(
            _text("PROD-", F.col("p_partkey")).alias("product_id"),
            _text(F.col("p_name"), " ", F.col("p_brand")).alias("nama_produk"),
            F.col("p_type").alias("kategori"),
            cost.alias("harga_modal_idr"),
            price.alias("harga_jual_idr"),
            (F.col("p_size") <= 45).alias("is_active"),
            F.struct("p_partkey").alias(ARRIVAL),
        )
    )


def oms(spark: SparkSession, sf_dir: str) -> DataFrame:
    payment = (
        F.when(F.col("o_orderpriority").startswith("1"), "OVO")
        .when(F.col("o_orderpriority").startswith("2"), "GOPAY")
        .when(F.col("o_orderpriority").startswith("3"), "CREDIT_CARD")
        .when(F.col("o_orderpriority").startswith("4"), "VA_BCA")
        .otherwise("COD")
    )
    order, line, flag = F.col("o_orderstatus"), F.col("l_linestatus"), F.col("l_returnflag")
    status = (
        F.when((order == "F") & (flag == "R"), "Returned")
        .when(order == "F", "Delivered")
        .when((order == "O") & (line == "O"), "Processing")
        .when(order == "O", "Shipped")
        .when((order == "P") & (flag == "R"), "Cancelled")
        .otherwise("Pending")
    )
    return (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            _text("ORD-", F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("order_id"),
            _user(F.col("o_custkey")).alias("user_id"),
            _product(F.col("l_partkey")).alias("product_id"),
            F.col("l_quantity").cast("int").alias("jumlah_barang"),
            _fold(F.col("o_orderdate")).alias("order_timestamp"),
            payment.alias("metode_pembayaran"),
            status.alias("status_order"),
            F.struct(*LINE_ORDER).alias(ARRIVAL),
        )
    )


def wms(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned, finished = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    movement = (
        F.when(returned & finished, "RETUR_STOCK")
        .when(returned, "ADJUSTMENT_DEFECT")
        .when(finished, "OUTBOUND")
        .otherwise("INBOUND")
    )
    # sites by nation, a few rows: joined to the suppliers they would be taken for a large table, and order lines shuffled
    site = (
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "n_nationkey",
            _text("WH-", F.col("r_name"), "-", F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(
                "warehouse_id"
            ),
        )
    )
    return (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(site), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _text("MOV-", F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("movement_id"),
            _product(F.col("l_partkey")).alias("product_id"),
            "warehouse_id",
            movement.alias("jenis_mutasi"),
            F.col("l_quantity").cast("int").alias("kuantitas_perubahan"),
            _fold(F.col("l_shipdate")).alias("recorded_timestamp"),
            _text("OP-", F.col("l_suppkey") % 10).alias("operator_id"),
            F.struct(*LINE_ORDER).alias(ARRIVAL),
        )
    )


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    page = (
        F.when(kind == "signup", "/home")
        .when(kind == "click", "/search")
        .when(kind == "view", "/product/view")
        .when(kind == "purchase", "/payment/success")
        .otherwise("/error")
    )
    slot = F.get_json_object("props", "$.k").cast("int") % 5
    device = (
        F.when(slot == 0, "Desktop-Windows")
        .when(slot == 1, "Desktop-MacOS")
        .when(slot == 2, "Mobile-Android")
        .when(slot == 3, "Mobile-iOS")
        .otherwise("Kiosk")
    )
    return _table(spark, sf_dir, "events").select(
        _text("LOG-", F.col("event_id")).alias("log_id"),
        _text("S-", F.col("user_id"), "-", date_key(F.col("ts"))).alias("session_id"),
        _user(F.col("user_id")).alias("user_id"),
        F.col("ts").alias("hit_timestamp"),
        page.alias("page_url"),
        _text("10.0.0.", F.col("user_id") % 250).alias("ip_address"),
        device.alias("device_type"),
        F.floor(F.col("value")).cast("int").alias("response_time_ms"),
        F.struct("event_id", "ts", "user_id", "event_type", "value", "props").alias(ARRIVAL),
    )


def sample_sources(spark: SparkSession, sf_dir: str) -> dict[str, SourceFrame]:
    builders = {
        "crm_user_profiles": crm,
        "mdm_products": mdm,
        "oms_orders": oms,
        "web_clickstream_logs": web,
        "wms_inventory_movements": wms,
    }
    return {name: SourceFrame(build(spark, sf_dir)) for name, build in builders.items()}
