"""Declared shape of every source, staging, dimension and fact table.

Table and column names are fixed values: users' queries refer to them.
Spark enforces neither keys nor foreign keys, so they are kept here as data
and checked by :mod:`niaga.operators.constraints`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

ARRIVAL = "_arrival"  # ordering column: the position of a row in its source
LOADED_AT = "_loaded_at"
MONTH = "date_month"  # YYYYMM, partition column of the stored facts


_TYPES = {
    "bigint": LongType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "string": StringType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
}


def columns(text: str) -> StructType:
    """``"name type, name type"`` as a schema, without needing a running session."""
    pairs = (pair.split() for pair in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Source:
    name: str
    staging: str
    schema: StructType
    key: str
    event_time: str | None
    required: tuple[str, ...]  # a null here makes the row unusable


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    schema: StructType
    primary_key: str
    natural_key: str | None
    nullable: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name != LOADED_AT]

    @property
    def not_null(self) -> list[str]:
        return [c for c in self.names if c not in self.nullable]

    @property
    def is_fact(self) -> bool:
        return bool(self.foreign_keys)

    @property
    def stored_schema(self) -> StructType:
        """Schema on disk: facts carry the partition column as well."""
        if not self.is_fact:
            return self.schema
        return StructType(self.schema.fields + [StructField(MONTH, IntegerType())])


SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source(
            "crm_user_profiles",
            "stg_crm_user_profiles",
            columns(
                "user_id string, nama_lengkap string, email string, kota string,"
                " account_tier string, signup_timestamp timestamp_ntz"
            ),
            key="user_id",
            event_time="signup_timestamp",
            required=("signup_timestamp",),
        ),
        Source(
            "mdm_products",
            "stg_mdm_products",
            columns(
                "product_id string, nama_produk string, kategori string,"
                " harga_modal_idr bigint, harga_jual_idr bigint, is_active boolean"
            ),
            key="product_id",
            event_time=None,
            required=("harga_modal_idr", "harga_jual_idr"),
        ),
        Source(
            "oms_orders",
            "stg_oms_orders",
            columns(
                "order_id string, user_id string, product_id string, jumlah_barang int,"
                " order_timestamp timestamp_ntz, metode_pembayaran string, status_order string"
            ),
            key="order_id",
            event_time="order_timestamp",
            required=("order_timestamp", "jumlah_barang"),
        ),
        Source(
            "web_clickstream_logs",
            "stg_web_clickstream_logs",
            columns(
                "log_id string, session_id string, user_id string, hit_timestamp timestamp_ntz,"
                " page_url string, ip_address string, device_type string, response_time_ms int"
            ),
            key="log_id",
            event_time="hit_timestamp",
            required=("hit_timestamp", "response_time_ms"),
        ),
        Source(
            "wms_inventory_movements",
            "stg_wms_inventory_movements",
            columns(
                "movement_id string, product_id string, warehouse_id string, jenis_mutasi string,"
                " kuantitas_perubahan int, recorded_timestamp timestamp_ntz, operator_id string"
            ),
            key="movement_id",
            event_time="recorded_timestamp",
            required=("recorded_timestamp", "kuantitas_perubahan"),
        ),
    )
}

_DATE_FK = ForeignKey("date_key", "dim_date", "date_key")
_CUSTOMER_FK = ForeignKey("customer_key", "dim_customer", "customer_key")
_PRODUCT_FK = ForeignKey("product_key", "dim_product", "product_key")

DIMENSIONS: tuple[Table, ...] = (
    Table(
        "dim_date",
        columns(
            "date_key int, full_date date, day int, day_name string, month int, month_name string,"
            " quarter int, year int, week_of_year int, is_weekend int"
        ),
        primary_key="date_key",
        natural_key=None,
    ),
    Table(
        "dim_customer",
        columns(
            "customer_key bigint, user_id string, nama_lengkap string, email string, kota string,"
            " account_tier string, signup_date date, signup_datetime timestamp_ntz,"
            " tenure_days_as_of_load int, _loaded_at timestamp"
        ),
        primary_key="customer_key",
        natural_key="user_id",
        nullable=("tenure_days_as_of_load",),
    ),
    Table(
        "dim_product",
        columns(
            "product_key bigint, product_id string, nama_produk string, kategori string,"
            " harga_modal_idr bigint, harga_jual_idr bigint, margin_idr bigint,"
            " margin_pct double, is_active int, _loaded_at timestamp"
        ),
        primary_key="product_key",
        natural_key="product_id",
    ),
    Table(
        "dim_warehouse",
        columns("warehouse_key bigint, warehouse_id string, warehouse_name string, warehouse_code string"),
        primary_key="warehouse_key",
        natural_key="warehouse_id",
    ),
    Table(
        "dim_payment_method",
        columns(
            "payment_method_key bigint, payment_method_code string,"
            " payment_method_name string, payment_category string"
        ),
        primary_key="payment_method_key",
        natural_key="payment_method_code",
    ),
    Table(
        "dim_device",
        columns("device_key bigint, device_type_code string, platform string, operating_system string"),
        primary_key="device_key",
        natural_key="device_type_code",
    ),
    Table(
        "dim_page",
        columns("page_key bigint, page_url string, funnel_stage string, funnel_order int"),
        primary_key="page_key",
        natural_key="page_url",
    ),
)

FACTS: tuple[Table, ...] = (
    Table(
        "fact_orders",
        columns(
            "order_key bigint, order_id string, date_key int, order_datetime timestamp_ntz,"
            " customer_key bigint, product_key bigint, payment_method_key bigint,"
            " status_order string, quantity int, unit_price_idr bigint, unit_cost_idr bigint,"
            " gross_revenue_idr bigint, gross_cost_idr bigint, gross_profit_idr bigint,"
            " is_delivered int, is_cancelled int, is_returned int"
        ),
        primary_key="order_key",
        natural_key="order_id",
        foreign_keys=(
            _DATE_FK,
            _CUSTOMER_FK,
            _PRODUCT_FK,
            ForeignKey("payment_method_key", "dim_payment_method", "payment_method_key"),
        ),
    ),
    Table(
        "fact_inventory_movements",
        columns(
            "movement_key bigint, movement_id string, date_key int,"
            " movement_datetime timestamp_ntz, product_key bigint, warehouse_key bigint,"
            " jenis_mutasi string, operator_id string, quantity_change int, signed_quantity int"
        ),
        primary_key="movement_key",
        natural_key="movement_id",
        foreign_keys=(
            _DATE_FK,
            _PRODUCT_FK,
            ForeignKey("warehouse_key", "dim_warehouse", "warehouse_key"),
        ),
    ),
    Table(
        "fact_web_clickstream",
        columns(
            "click_key bigint, log_id string, date_key int, hit_datetime timestamp_ntz,"
            " session_id string, customer_key bigint, page_key bigint, device_key bigint,"
            " ip_address string, response_time_ms int"
        ),
        primary_key="click_key",
        natural_key="log_id",
        nullable=("customer_key",),
        foreign_keys=(
            _DATE_FK,
            _CUSTOMER_FK,
            ForeignKey("page_key", "dim_page", "page_key"),
            ForeignKey("device_key", "dim_device", "device_key"),
        ),
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in DIMENSIONS + FACTS}

# Rows left out of a fact because their user or product is not in the mart.
ORPHANS: dict[str, StructType] = {
    "orphan_orders": columns(
        "order_id string, user_id string, product_id string, order_datetime timestamp_ntz,"
        " unknown_user boolean, unknown_product boolean"
    ),
    "orphan_movements": columns(
        "movement_id string, product_id string, warehouse_id string,"
        " movement_datetime timestamp_ntz, unknown_product boolean"
    ),
}

AUDIT = columns(
    "run_id bigint, step_name string, status string, row_count bigint,"
    " started_at timestamp, finished_at timestamp, notes string"
)

CHECK_RESULT = columns("check_name string, status string, detail string")
AUDIT_KEY = ("etl_run_log", "run_id")
