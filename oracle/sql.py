"""DuckDB SQL for every query, written independently of the Spark plans.

``BASE`` derives the mart from the test tables; each entry is ``BASE`` plus one
statement in the plain joined form (no pre-aggregation, no rewrites), so that
the rewritten Spark plans are checked against the original semantics.
"""

from __future__ import annotations

from niaga.plans.catalog import ROLLED_UP
from niaga.plans.faults import CHECKED, TWICE, VALUES, changed

# --- sources from the test tables -----------------------------------------------------------

SOURCES = """
crm AS (
    SELECT 'USR-' || prefix || id AS user_id, name AS nama_lengkap,
           lower(prefix) || 'u' || id || '@example.com' AS email, n_name AS kota,
           CASE WHEN balance >= 7500 THEN 'Platinum' WHEN balance >= 5000 THEN 'Gold'
                WHEN balance >= 2500 THEN 'Silver' ELSE 'Standard' END AS account_tier,
           TIMESTAMP '2023-01-01' + to_days((id % 365)::INTEGER) AS signup_timestamp
    FROM (SELECT '' AS prefix, c_custkey AS id, c_name AS name, c_nationkey AS nation,
                 c_acctbal AS balance FROM customer
          UNION ALL SELECT 'S', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier)
    JOIN nation ON nation = n_nationkey
),
mdm AS (
    SELECT 'PROD-' || p_partkey AS product_id, p_name || ' ' || p_brand AS nama_produk,
           p_type AS kategori,
           (round(p_retailprice * 100)::BIGINT * (50 + p_size)) // 100 AS harga_modal_idr,
           round(p_retailprice * 100)::BIGINT AS harga_jual_idr,
           p_size <= 45 AS is_active
    FROM part
),
oms_raw AS (
    SELECT 'ORD-' || l_orderkey || '-' || l_linenumber AS order_id,
           'USR-' || CASE WHEN o_custkey % 100 = 99 THEN 'X' ELSE '' END || o_custkey AS user_id,
           'PROD-' || CASE WHEN l_partkey % 50 = 49 THEN 'X' ELSE '' END || l_partkey AS product_id,
           l_quantity::INTEGER AS jumlah_barang,
           (DATE '2024-01-01' + (date_diff('day', DATE '1995-01-01', o_orderdate::DATE) % 30)::INTEGER
           )::TIMESTAMP AS order_timestamp,
           CASE left(o_orderpriority, 1) WHEN '1' THEN 'OVO' WHEN '2' THEN 'GOPAY'
                WHEN '3' THEN 'CREDIT_CARD' WHEN '4' THEN 'VA_BCA' ELSE 'COD' END AS metode_pembayaran,
           CASE WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN 'Returned'
                WHEN o_orderstatus = 'F' THEN 'Delivered'
                WHEN o_orderstatus = 'O' AND l_linestatus = 'O' THEN 'Processing'
                WHEN o_orderstatus = 'O' THEN 'Shipped'
                WHEN o_orderstatus = 'P' AND l_returnflag = 'R' THEN 'Cancelled'
                ELSE 'Pending' END AS status_order,
           row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                        l_returnflag, l_linestatus, l_shipdate) AS pos
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
wms_raw AS (
    SELECT 'MOV-' || l_orderkey || '-' || l_linenumber AS movement_id,
           'PROD-' || CASE WHEN l_partkey % 50 = 49 THEN 'X' ELSE '' END || l_partkey AS product_id,
           'WH-' || r_name || '-' || lpad(n_nationkey::VARCHAR, 2, '0') AS warehouse_id,
           CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'RETUR_STOCK'
                WHEN l_returnflag = 'R' THEN 'ADJUSTMENT_DEFECT'
                WHEN l_linestatus = 'F' THEN 'OUTBOUND' ELSE 'INBOUND' END AS jenis_mutasi,
           l_quantity::INTEGER AS kuantitas_perubahan,
           (DATE '2024-01-01' + (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) % 30)::INTEGER
           )::TIMESTAMP AS recorded_timestamp,
           'OP-' || (l_suppkey % 10) AS operator_id,
           row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                        l_returnflag, l_linestatus, l_shipdate) AS pos
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
web AS (
    SELECT 'LOG-' || event_id AS log_id,
           'S-' || user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
           'USR-' || CASE WHEN user_id % 100 = 99 THEN 'X' ELSE '' END || user_id AS user_id,
           ts AS hit_timestamp,
           CASE event_type WHEN 'signup' THEN '/home' WHEN 'click' THEN '/search'
                WHEN 'view' THEN '/product/view' WHEN 'purchase' THEN '/payment/success'
                ELSE '/error' END AS page_url,
           '10.0.0.' || (user_id % 250) AS ip_address,
           CASE regexp_extract(props, '([0-9]+)', 1)::INTEGER % 5
                WHEN 0 THEN 'Desktop-Windows' WHEN 1 THEN 'Desktop-MacOS'
                WHEN 2 THEN 'Mobile-Android' WHEN 3 THEN 'Mobile-iOS' ELSE 'Kiosk' END AS device_type,
           floor(value)::INTEGER AS response_time_ms
    FROM events
)"""

# --- dimensions and facts ---------------------------------------------------------------------

MART = """
span AS (
    SELECT min(t) AS min_ts, max(t) AS max_ts FROM (
        SELECT signup_timestamp AS t FROM crm UNION ALL SELECT order_timestamp FROM oms_raw
        UNION ALL SELECT hit_timestamp FROM web UNION ALL SELECT recorded_timestamp FROM wms_raw)
),
dim_date AS (
    SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, d::DATE AS full_date,
           day(d)::INTEGER AS day,
           ['Senin', 'Selasa', 'Rabu', 'Kamis', 'Jumat', 'Sabtu', 'Minggu'][isodow(d)] AS day_name,
           month(d)::INTEGER AS month,
           ['Januari', 'Februari', 'Maret', 'April', 'Mei', 'Juni', 'Juli', 'Agustus',
            'September', 'Oktober', 'November', 'Desember'][month(d)] AS month_name,
           quarter(d)::INTEGER AS quarter, year(d)::INTEGER AS year,
           weekofyear(d)::INTEGER AS week_of_year, (isodow(d) >= 6)::INTEGER AS is_weekend
    FROM (SELECT unnest(generate_series(min_ts::DATE - 3, max_ts::DATE + 3, INTERVAL 1 DAY)) AS d
          FROM span)
),
dim_customer AS (
    SELECT row_number() OVER (ORDER BY user_id) AS customer_key, user_id, nama_lengkap, email, kota,
           account_tier, signup_timestamp::DATE AS signup_date, signup_timestamp AS signup_datetime,
           floor((epoch(TIMESTAMP '2024-02-01') - epoch(signup_timestamp)) / 86400)::INTEGER
               AS tenure_days_as_of_load
    FROM crm
),
dim_product AS (
    SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, nama_produk, kategori,
           harga_modal_idr, harga_jual_idr, harga_jual_idr - harga_modal_idr AS margin_idr,
           round_even((harga_jual_idr - harga_modal_idr)::DOUBLE / harga_jual_idr::DOUBLE * 100 * 100, 0)
               / 100 AS margin_pct,
           is_active::INTEGER AS is_active
    FROM mdm
),
dim_warehouse AS (
    SELECT row_number() OVER (ORDER BY warehouse_id) AS warehouse_key, warehouse_id,
           list_aggregate(list_transform(string_split(lower(split_part(warehouse_id, '-', 2)), ' '),
                                         lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')
               AS warehouse_name,
           split_part(warehouse_id, '-', 3) AS warehouse_code
    FROM (SELECT DISTINCT warehouse_id FROM wms_raw)
),
dim_payment_method AS (
    SELECT row_number() OVER (ORDER BY code) AS payment_method_key, code AS payment_method_code,
           CASE code WHEN 'OVO' THEN 'OVO' WHEN 'GOPAY' THEN 'GoPay' WHEN 'DANA' THEN 'DANA'
                WHEN 'CREDIT_CARD' THEN 'Kartu Kredit' WHEN 'VA_BCA' THEN 'Virtual Account - BCA'
                WHEN 'VA_MANDIRI' THEN 'Virtual Account - Mandiri' ELSE code END AS payment_method_name,
           CASE WHEN code IN ('OVO', 'GOPAY', 'DANA') THEN 'E-Wallet'
                WHEN code = 'CREDIT_CARD' THEN 'Kartu Kredit'
                WHEN code LIKE 'VA\\_%' ESCAPE '\\' THEN 'Virtual Account'
                ELSE 'Lainnya' END AS payment_category
    FROM (SELECT DISTINCT metode_pembayaran AS code FROM oms_raw)
),
dim_device AS (
    SELECT row_number() OVER (ORDER BY code) AS device_key, code AS device_type_code,
           split_part(code, '-', 1) AS platform,
           CASE WHEN position('-' IN code) > 0 THEN code[position('-' IN code) + 1:] ELSE '' END
               AS operating_system
    FROM (SELECT DISTINCT device_type AS code FROM web)
),
dim_page AS (
    SELECT row_number() OVER (ORDER BY funnel_order, page_url) AS page_key, * FROM (
        SELECT page_url,
               coalesce(stage, '0. Unknown') AS funnel_stage, coalesce(ord, 0)::INTEGER AS funnel_order
        FROM (SELECT DISTINCT page_url FROM web)
        LEFT JOIN (VALUES ('/home', '1. Landing', 1), ('/search', '2. Discovery', 2),
                          ('/product/view', '3. Consideration', 3), ('/cart/add', '4. Intent', 4),
                          ('/checkout', '5. Conversion', 5), ('/payment/success', '6. Purchase', 6)
                  ) stages(page_url, stage, ord) USING (page_url))
),
fact_orders AS (
    SELECT row_number() OVER (ORDER BY order_timestamp::DATE, order_id) AS order_key, order_id,
           strftime(order_timestamp, '%Y%m%d')::INTEGER AS date_key,
           order_timestamp AS order_datetime, customer_key, product_key, payment_method_key,
           status_order, jumlah_barang AS quantity, harga_jual_idr AS unit_price_idr,
           harga_modal_idr AS unit_cost_idr, jumlah_barang * harga_jual_idr AS gross_revenue_idr,
           jumlah_barang * harga_modal_idr AS gross_cost_idr,
           jumlah_barang * (harga_jual_idr - harga_modal_idr) AS gross_profit_idr,
           (status_order = 'Delivered')::INTEGER AS is_delivered,
           (status_order = 'Cancelled')::INTEGER AS is_cancelled,
           (status_order = 'Returned')::INTEGER AS is_returned
    FROM oms_raw JOIN dim_customer USING (user_id) JOIN dim_product USING (product_id)
    LEFT JOIN dim_payment_method ON metode_pembayaran = payment_method_code
    WHERE pos = 1
),
fact_inventory_movements AS (
    SELECT row_number() OVER (ORDER BY recorded_timestamp::DATE, movement_id) AS movement_key,
           movement_id, strftime(recorded_timestamp, '%Y%m%d')::INTEGER AS date_key,
           recorded_timestamp AS movement_datetime, product_key, warehouse_key, jenis_mutasi,
           operator_id, kuantitas_perubahan AS quantity_change,
           CASE WHEN jenis_mutasi IN ('INBOUND', 'RETUR_STOCK') THEN kuantitas_perubahan
                WHEN jenis_mutasi IN ('OUTBOUND', 'ADJUSTMENT_DEFECT') THEN -kuantitas_perubahan
                ELSE 0 END AS signed_quantity
    FROM wms_raw JOIN dim_product USING (product_id) LEFT JOIN dim_warehouse USING (warehouse_id)
    WHERE pos = 1
),
fact_web_clickstream AS (
    SELECT row_number() OVER (ORDER BY hit_timestamp::DATE, log_id) AS click_key, log_id,
           strftime(hit_timestamp, '%Y%m%d')::INTEGER AS date_key,
           date_trunc('second', hit_timestamp) AS hit_datetime, session_id, customer_key, page_key,
           device_key, ip_address, response_time_ms
    FROM web LEFT JOIN dim_customer USING (user_id) LEFT JOIN dim_page USING (page_url)
    LEFT JOIN dim_device ON device_type = device_type_code
),
orphan_orders AS (
    SELECT order_id, user_id, product_id, order_timestamp AS order_datetime,
           customer_key IS NULL AS unknown_user, product_key IS NULL AS unknown_product
    FROM oms_raw LEFT JOIN dim_customer USING (user_id) LEFT JOIN dim_product USING (product_id)
    WHERE pos = 1 AND (customer_key IS NULL OR product_key IS NULL)
),
orphan_movements AS (
    SELECT movement_id, product_id, warehouse_id, recorded_timestamp AS movement_datetime,
           TRUE AS unknown_product
    FROM wms_raw WHERE pos = 1 AND product_id NOT IN (SELECT product_id FROM mdm)
)"""

# the load logs fifteen steps, each under an id of its own
LOG = "etl_run_log AS (SELECT unnest(range(15)) AS run_id)"

BASE = f"WITH {SOURCES.strip()},\n{MART.strip()},\n{LOG}\n"

STAGING = {
    "stg_crm_user_profiles": "crm",
    "stg_mdm_products": "mdm",
    "stg_oms_orders": "oms_raw",
    "stg_web_clickstream_logs": "web",
    "stg_wms_inventory_movements": "wms_raw",
}
PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_warehouse": "warehouse_key",
    "dim_payment_method": "payment_method_key",
    "dim_device": "device_key",
    "dim_page": "page_key",
    "fact_orders": "order_key",
    "fact_inventory_movements": "movement_key",
    "fact_web_clickstream": "click_key",
}
NATURAL_KEYS = {
    "dim_customer": "user_id",
    "dim_product": "product_id",
    "dim_warehouse": "warehouse_id",
    "dim_payment_method": "payment_method_code",
    "dim_device": "device_type_code",
    "dim_page": "page_url",
    "fact_orders": "order_id",
    "fact_inventory_movements": "movement_id",
    "fact_web_clickstream": "log_id",
}
COLUMNS = {
    "dim_date": "date_key full_date day day_name month month_name quarter year week_of_year is_weekend",
    "dim_customer": "customer_key user_id nama_lengkap email kota account_tier signup_date signup_datetime",
    "dim_product": "product_key product_id nama_produk kategori harga_modal_idr harga_jual_idr"
    " margin_idr margin_pct is_active",
    "dim_warehouse": "warehouse_key warehouse_id warehouse_name warehouse_code",
    "dim_payment_method": "payment_method_key payment_method_code payment_method_name payment_category",
    "dim_device": "device_key device_type_code platform operating_system",
    "dim_page": "page_key page_url funnel_stage funnel_order",
    "fact_orders": "order_key order_id date_key order_datetime customer_key product_key"
    " payment_method_key status_order quantity unit_price_idr unit_cost_idr gross_revenue_idr"
    " gross_cost_idr gross_profit_idr is_delivered is_cancelled is_returned",
    "fact_inventory_movements": "movement_key movement_id date_key movement_datetime product_key"
    " warehouse_key jenis_mutasi operator_id quantity_change signed_quantity",
    "fact_web_clickstream": "click_key log_id date_key hit_datetime session_id page_key device_key"
    " ip_address response_time_ms",
}
FOREIGN_KEYS = (
    ("fact_orders", "date_key", "dim_date"),
    ("fact_orders", "customer_key", "dim_customer"),
    ("fact_orders", "product_key", "dim_product"),
    ("fact_orders", "payment_method_key", "dim_payment_method"),
    ("fact_inventory_movements", "date_key", "dim_date"),
    ("fact_inventory_movements", "product_key", "dim_product"),
    ("fact_inventory_movements", "warehouse_key", "dim_warehouse"),
    ("fact_web_clickstream", "date_key", "dim_date"),
    ("fact_web_clickstream", "customer_key", "dim_customer"),
    ("fact_web_clickstream", "page_key", "dim_page"),
    ("fact_web_clickstream", "device_key", "dim_device"),
)


def big(expression: str) -> str:
    """DuckDB sums are HUGEINT; Spark's are BIGINT."""
    return f"CAST({expression} AS BIGINT)"


def ratio(num: str, den: str, scale: int, factor: int = 1) -> str:
    """``factor * num / den`` rounded half away from zero, computed in whole numbers."""
    unit = 10**scale
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE sign({num}) * sign({den}) *"
        f" ((abs({num})::HUGEINT * {2 * factor * unit} + abs({den})) // (abs({den})::HUGEINT * 2))"
        f" END)::DOUBLE / {unit}::DOUBLE"
    )


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _values(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


# --- reports, in terms of the mart tables named by `f` (facts) and `c` (customers) -------------


def a2(orders: str) -> str:
    bp = "sum(round(margin_pct * 100)::BIGINT)"
    return f"""
        SELECT kategori, count(*) AS total_order, {big("sum(quantity)")} AS total_unit_terjual,
               {big("sum(gross_revenue_idr)")} AS total_revenue_idr,
               {big("sum(gross_profit_idr)")} AS total_profit_idr,
               {ratio(bp, "count(*)", 0)} / 100 AS avg_margin_pct
        FROM {orders} JOIN dim_product USING (product_key) GROUP BY kategori"""


def a3(orders: str) -> str:
    return f"""
        SELECT product_id, nama_produk, kategori, {big("sum(quantity)")} AS total_unit_terjual,
               {big("sum(gross_revenue_idr)")} AS total_revenue_idr,
               {big("sum(gross_profit_idr)")} AS total_profit_idr
        FROM {orders} JOIN dim_product USING (product_key) WHERE is_delivered = 1
        GROUP BY ALL ORDER BY total_revenue_idr DESC, product_id LIMIT 10"""


def a4(orders: str) -> str:
    share = ratio("count(*)", f"(SELECT count(*) FROM {orders})", 2, 100)
    return f"""
        SELECT status_order, count(*) AS jumlah_order, {share} AS persentase
        FROM {orders} GROUP BY status_order"""


def a5(orders: str) -> str:
    return f"""
        SELECT payment_method_name, payment_category, count(*) AS total_order,
               {big("sum(gross_revenue_idr)")} AS total_revenue_idr,
               {ratio("sum(gross_revenue_idr)", "count(*)", 0)} AS avg_order_value_idr
        FROM {orders} JOIN dim_payment_method USING (payment_method_key) GROUP BY ALL"""


def a6(orders: str) -> str:
    buyers = "count(DISTINCT customer_key)"
    return f"""
        SELECT kota, {buyers} AS jumlah_pelanggan, count(order_key) AS total_order,
               {big("sum(gross_revenue_idr)")} AS total_revenue_idr,
               {ratio("sum(gross_revenue_idr)", buyers, 0)} AS revenue_per_customer_idr
        FROM {orders} JOIN dim_customer USING (customer_key) GROUP BY kota"""


def b1(customers: str) -> str:
    return f"""
        SELECT account_tier, count(DISTINCT c.customer_key) AS jumlah_pelanggan,
               count(order_key) AS total_order,
               {big("sum(gross_revenue_idr)")} AS total_revenue_idr,
               {ratio("sum(gross_revenue_idr)", "count(order_key)", 0)} AS avg_order_value_idr
        FROM {customers} c LEFT JOIN fact_orders o ON c.customer_key = o.customer_key
        GROUP BY account_tier"""


def b2(customers: str) -> str:
    return f"""
        SELECT user_id, nama_lengkap, kota, account_tier, count(order_key) AS total_order,
               {big("sum(gross_revenue_idr)")} AS total_belanja_idr
        FROM fact_orders JOIN {customers} USING (customer_key) WHERE is_delivered = 1
        GROUP BY ALL ORDER BY total_belanja_idr DESC, user_id LIMIT 10"""


def b3(customers: str) -> str:
    return f"""
        SELECT user_id, nama_lengkap, kota, account_tier, signup_date, tenure_days_as_of_load
        FROM {customers} WHERE customer_key NOT IN (SELECT customer_key FROM fact_orders)
        ORDER BY tenure_days_as_of_load DESC NULLS LAST, user_id LIMIT 20"""


def c1(clicks: str) -> str:
    return f"""
        SELECT funnel_order, funnel_stage, page_url, count(*) AS total_hit,
               count(DISTINCT session_id) AS unique_session
        FROM {clicks} JOIN dim_page USING (page_key) GROUP BY ALL"""


def c2(clicks: str) -> str:
    return f"""
        SELECT page_url, count(*) AS total_hit,
               {ratio("sum(response_time_ms)", "count(*)", 1)} AS avg_response_time_ms,
               max(response_time_ms) AS max_response_time_ms
        FROM {clicks} JOIN dim_page USING (page_key) GROUP BY page_url"""


def c3(clicks: str) -> str:
    return f"""
        SELECT platform, operating_system, count(*) AS total_hit,
               count(DISTINCT session_id) AS unique_session
        FROM {clicks} JOIN dim_device USING (device_key) GROUP BY ALL"""


def c4(clicks: str) -> str:
    seen = "count(DISTINCT w.customer_key)"
    bought = "count(DISTINCT w.customer_key) FILTER (o.order_key IS NOT NULL)"
    return f"""
        SELECT kota, {seen} AS jumlah_visitor, {bought} AS jumlah_yang_order,
               {ratio(bought, seen, 2, 100)} AS conversion_rate_pct
        FROM {clicks} w JOIN dim_customer c ON w.customer_key = c.customer_key
        LEFT JOIN fact_orders o ON o.customer_key = w.customer_key GROUP BY kota"""


def d1(moves: str) -> str:
    return f"""
        SELECT product_id, nama_produk, warehouse_name,
               {big("sum(signed_quantity)")} AS estimasi_stok_bersih
        FROM {moves} JOIN dim_product USING (product_key) JOIN dim_warehouse USING (warehouse_key)
        GROUP BY ALL ORDER BY estimasi_stok_bersih, product_id, warehouse_name LIMIT 20"""


DEFECT = "FILTER (jenis_mutasi = 'ADJUSTMENT_DEFECT')"


def d3(moves: str) -> str:
    return f"""
        SELECT product_id, nama_produk, kategori,
               {big(f"coalesce(sum(quantity_change) {DEFECT}, 0)")} AS total_unit_rusak,
               count(*) {DEFECT} AS jumlah_kejadian
        FROM {moves} JOIN dim_product USING (product_key)
        GROUP BY ALL HAVING total_unit_rusak > 0
        ORDER BY total_unit_rusak DESC, product_id LIMIT 10"""


E2_FIXED = f"""
    SELECT kategori, {big("sum(r)")} AS {{revenue}}, {big("coalesce(sum(d), 0)")} AS {{defects}}
    FROM dim_product
    LEFT JOIN (SELECT product_key, sum(gross_revenue_idr) AS r FROM fact_orders GROUP BY ALL)
        USING (product_key)
    LEFT JOIN (SELECT product_key, sum(quantity_change) AS d FROM fact_inventory_movements
               WHERE jenis_mutasi = 'ADJUSTMENT_DEFECT' GROUP BY ALL) USING (product_key)
    GROUP BY kategori"""

# --- filters of the page queries ----------------------------------------------------------------

CATEGORIES = ["ECONOMY", "PROMO", "STANDARD"]
CITIES = [f"NATION_{i}" for i in range(0, 25, 2)]
CITY = f"""AND {_values("c.kota", CITIES)}"""
SALES = f"""(
    SELECT o.* FROM fact_orders o JOIN dim_product p USING (product_key)
    JOIN dim_customer c USING (customer_key) JOIN dim_payment_method y USING (payment_method_key)
    JOIN dim_date d USING (date_key)
    WHERE {_values("p.kategori", CATEGORIES)} {CITY}
      AND {_values("y.payment_method_name", ["OVO", "GoPay", "COD"])}
      AND {_values("o.status_order", ["Delivered", "Shipped", "Pending", "Returned"])}
      AND d.full_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-24')"""
MEMBERS = f"""(
    SELECT * FROM dim_customer
    WHERE {_values("account_tier", ["Gold", "Platinum"])} AND {_values("kota", CITIES)})"""
MOBILE = """(
    SELECT w.* FROM fact_web_clickstream w JOIN dim_device USING (device_key)
    WHERE platform = 'Mobile')"""
STOCK = f"""(
    SELECT i.* FROM fact_inventory_movements i JOIN dim_product p USING (product_key)
    JOIN dim_warehouse w USING (warehouse_key)
    WHERE {_values("w.warehouse_name", ["Asia", "Middle East"])} AND {_values("p.kategori", CATEGORIES)})"""


# --- labels ----------------------------------------------------------------------------------------


def _swap(text: str) -> str:
    return f"translate({text}, ',.', '.,')"


def rupiah(value: str) -> str:
    v = f"({value})::DOUBLE"
    return (
        f"'Rp' || CASE WHEN abs({v}) >= 1e9 THEN {_swap(f"format('{{:,.2f}}', {v} / 1e9)")} || ' M'"
        f" WHEN abs({v}) >= 1e6 THEN {_swap(f"format('{{:,.1f}}', {v} / 1e6)")} || ' jt'"
        f" ELSE replace(format('{{:,.0f}}', {v}), ',', '.') END"
    )


def number(value: str) -> str:
    return f"replace(format('{{:,.0f}}', ({value})::DOUBLE), ',', '.')"


def percent(value: str) -> str:
    return f"replace(format('{{:.1f}}', ({value})::DOUBLE), '.', ',') || '%'"


# --- headline numbers ---------------------------------------------------------------------------

def kpi(
    orders="fact_orders", customers="dim_customer", products="dim_product",
    web="fact_web_clickstream", moves="fact_inventory_movements",
) -> str:
    return f"""
    SELECT o.* EXCLUDE (n), n AS total_orders, c.*, p.*, w.*, i.*
    FROM (SELECT {big("sum(gross_revenue_idr)")} AS total_revenue,
                 {big("sum(gross_profit_idr)")} AS total_profit, count(*) AS n,
                 sum(gross_revenue_idr)::DOUBLE / count(*) AS avg_order_value,
                 {ratio("sum(is_delivered)", "count(*)", 1, 100)} AS delivered_rate,
                 {ratio("sum(is_cancelled)", "count(*)", 1, 100)} AS cancelled_rate
          FROM {orders}) o,
         (SELECT count(*) AS total_customers FROM {customers}) c,
         (SELECT count(*) AS total_products FROM {products}) p,
         (SELECT count(DISTINCT session_id) AS total_web_sessions FROM {web}) w,
         (SELECT {big("sum(signed_quantity)")} AS net_stock_change FROM {moves}) i"""


KPI = kpi()


def _counted(pairs) -> list[str]:
    return [f"SELECT '{name}', (SELECT count(*) FROM {table})" for name, table in pairs]


def _dq_suite() -> str:
    # Names of the checks and labels of their numbers.
    counts = (
        ("row_count_customer_staging_vs_dim", "crm", "dim_customer"),
        ("row_count_product_staging_vs_dim", "mdm", "dim_product"),
        ("row_count_orders_staging_vs_fact", "oms_raw", "fact_orders"),
        ("row_count_inventory_staging_vs_fact", "wms_raw", "fact_inventory_movements"),
        ("row_count_clickstream_staging_vs_fact", "web", "fact_web_clickstream"),
    )
    zero = (
        ("fk_integrity_fact_orders_customer", "orphan_rows", "fact_orders WHERE customer_key IS NULL"),
        ("fk_integrity_fact_orders_product", "orphan_rows", "fact_orders WHERE product_key IS NULL"),
        ("fk_integrity_fact_orders_payment", "orphan_rows", "fact_orders WHERE payment_method_key IS NULL"),
        ("fk_integrity_fact_inventory_product", "orphan_rows",
         "fact_inventory_movements WHERE product_key IS NULL"),
        ("fk_integrity_fact_inventory_warehouse", "orphan_rows",
         "fact_inventory_movements WHERE warehouse_key IS NULL"),
        ("fk_integrity_fact_clickstream_page", "orphan_rows", "fact_web_clickstream WHERE page_key IS NULL"),
        ("fk_integrity_fact_clickstream_device", "orphan_rows",
         "fact_web_clickstream WHERE device_key IS NULL"),
        ("uniqueness_fact_orders_order_id", "duplicate_order_id",
         "(SELECT order_id FROM fact_orders GROUP BY order_id HAVING count(*) > 1)"),
        ("uniqueness_dim_customer_user_id", "duplicate_user_id",
         "(SELECT user_id FROM dim_customer GROUP BY user_id HAVING count(*) > 1)"),
        ("business_rule_no_negative_revenue", "negative_rows", "fact_orders WHERE gross_revenue_idr < 0"),
        ("business_rule_positive_quantity", "invalid_rows", "fact_orders WHERE quantity <= 0"),
        ("business_rule_non_negative_margin", "negative_margin_products", "dim_product WHERE margin_idr < 0"),
    )
    parts = [
        f"SELECT '{name}' AS check_name, CASE WHEN s = m THEN 'PASS' ELSE 'FAIL' END AS status,"
        f" 'staging=' || s || ', {loaded}=' || m AS detail"
        f" FROM (SELECT (SELECT count(*) FROM {staged}) AS s, (SELECT count(*) FROM {loaded}) AS m)"
        for name, staged, loaded in counts
    ]
    parts += [
        f"SELECT '{name}', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, '{label}=' || n"
        f" FROM (SELECT count(*) AS n FROM {rows})"
        for name, label, rows in zero
    ]
    return union(parts)


# versions of a dimension's members: what each snapshot held, without those that equal the one before
VERSIONS = """
    SELECT {key}, {value}, valid_from, lead(valid_from) OVER (PARTITION BY {key} ORDER BY valid_from) AS valid_to
    FROM (
        SELECT *, lag({value}) OVER (PARTITION BY {key} ORDER BY valid_from) AS before FROM (
            SELECT {key}, {value}, TIMESTAMP '1900-01-01' AS valid_from FROM {table}
            UNION ALL SELECT {key}, {one}, TIMESTAMP '2024-01-10' FROM {table}
            UNION ALL SELECT {key}, {two}, TIMESTAMP '2024-01-20' FROM {table})
    ) WHERE before IS NULL OR before <> {value}"""
_NUMBER = "regexp_extract({key}, '[0-9]+')::BIGINT"
PRICES = {
    name: f"harga_jual_idr + CASE WHEN {_NUMBER.format(key='product_id')} % 3 = {step} THEN {1000 * step} ELSE 0 END"
    for name, step in (("one", 1), ("two", 2))
}
TIERS = {
    name: f"CASE WHEN {_NUMBER.format(key='user_id')} % 4 = {step} THEN 'Tier {step}' ELSE account_tier END"
    for name, step in (("one", 1), ("two", 2))
}


def _bodies() -> dict[str, str]:
    q = {
        "stg_crm": "SELECT * FROM crm",
        "stg_mdm": "SELECT * FROM mdm",
        "stg_oms": "SELECT * EXCLUDE (pos) FROM oms_raw",
        "stg_wms": "SELECT * EXCLUDE (pos) FROM wms_raw",
        "stg_web": "SELECT * FROM web",
        "csv_line_breaks": "SELECT * REPLACE (nama_lengkap || chr(10) || '\"' || kota || '\",' || chr(13) || chr(10) || account_tier"
        " AS nama_lengkap) FROM crm",
        "incremental_orders": """
            SELECT order_id, strftime(moved, '%Y%m%d')::INTEGER AS date_key, moved AS order_datetime, user_id, product_id,
                   status_order, quantity, gross_profit_idr
            FROM (SELECT *, order_datetime + to_months((day(order_datetime) % 5)::INTEGER) AS moved FROM fact_orders)
            JOIN (SELECT customer_key, user_id FROM dim_customer) USING (customer_key)
            JOIN (SELECT product_key, product_id FROM dim_product) USING (product_key)""",
        "incremental_keys": """
            SELECT 'fact_orders' AS "table", count(*) AS n, 0::BIGINT AS changed, count(DISTINCT date_key % 5) AS months,
                   count(DISTINCT date_key % 5) FILTER (date_key % 100 IN (7, 8)) AS written FROM fact_orders
            UNION ALL SELECT 'fact_inventory_movements', count(*), 0, count(DISTINCT date_key // 100), 0
            FROM fact_inventory_movements
            UNION ALL SELECT 'fact_web_clickstream', count(*), 0, count(DISTINCT date_key // 100), 0
            FROM fact_web_clickstream""",
        "history_versions": f"SELECT * FROM ({VERSIONS.format(key='product_id', value='harga_jual_idr', table='dim_product', **PRICES)})",
        "orders_as_of": f"""
            SELECT o.order_id, o.order_datetime, o.quantity, o.user_id, o.product_id, p.harga_jual_idr, t.account_tier,
                   o.quantity * p.harga_jual_idr AS revenue_idr
            FROM (SELECT order_id, order_datetime, quantity, user_id, product_id FROM fact_orders
                  JOIN (SELECT customer_key, user_id FROM dim_customer) USING (customer_key)
                  JOIN (SELECT product_key, product_id FROM dim_product) USING (product_key)) o
            ASOF JOIN ({VERSIONS.format(key='product_id', value='harga_jual_idr', table='dim_product', **PRICES)}) p
            ON o.product_id = p.product_id AND o.order_datetime >= p.valid_from
            ASOF JOIN ({VERSIONS.format(key='user_id', value='account_tier', table='dim_customer', **TIERS)}) t
            ON o.user_id = t.user_id AND o.order_datetime >= t.valid_from""",
        "date_span": "SELECT * FROM span",
        "date_key_expr": "SELECT strftime(hit_timestamp, '%Y%m%d')::INTEGER AS date_key, count(*) AS n"
        " FROM web GROUP BY ALL",
        "orphan_orders": "SELECT * FROM orphan_orders",
        "orphan_movements": "SELECT * FROM orphan_movements",
    }
    q |= {name: f"SELECT * FROM {name}" for name in PRIMARY_KEYS}

    steps = [(f"staging::{stg}", table) for stg, table in STAGING.items()]
    steps += [(f"{t.split('_')[0].replace('dim', 'dimension')}::{t}", t) for t in PRIMARY_KEYS]
    q["audit_row_counts"] = union(
        f"SELECT '{step}' AS step_name, 'SUCCESS' AS status, count(*) AS row_count FROM {table}"
        for step, table in steps
    )

    def unique(kind: str, keys: dict[str, str]) -> str:
        return union(
            f"SELECT '{table}' AS table_name, '{kind}({key})' AS constraint_name,"
            f" (SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key}"
            f" HAVING count(*) > 1 OR {key} IS NULL)) AS violations"
            for table, key in keys.items()
        )

    q["constraint_pk"] = unique("pk", PRIMARY_KEYS | {"etl_run_log": "run_id"})
    ranked = [(len(steps) - n, step, table) for n, (step, table) in enumerate(steps)]
    q["dq9_audit_history"] = union(
        f"SELECT {position}::INTEGER AS position, '{step}' AS step_name, 'SUCCESS' AS status,"
        f" count(*) AS row_count FROM {table}"
        for position, step, table in ranked
    )
    q["constraint_unique"] = unique("unique", NATURAL_KEYS)
    q["constraint_not_null"] = union(
        f"SELECT '{table}' AS table_name, 'not_null({c})' AS constraint_name,"
        f" (SELECT count(*) FROM {table} WHERE {c} IS NULL) AS violations"
        for table, names in COLUMNS.items()
        for c in names.split()
    )
    q["constraint_fk"] = union(
        f"SELECT '{fact}' AS table_name, 'fk({key}->{dim})' AS constraint_name, (SELECT count(*)"
        f" FROM {fact} f LEFT JOIN {dim} d ON f.{key} = d.{key}"
        f" WHERE f.{key} IS NOT NULL AND d.{key} IS NULL) AS violations"
        for fact, key, dim in FOREIGN_KEYS
    )

    q["param_query"] = f"""
        SELECT kota, count(*) AS orders, {big("sum(gross_revenue_idr)")} AS revenue
        FROM fact_orders JOIN dim_customer USING (customer_key)
        WHERE account_tier = 'Gold' AND date_key BETWEEN 20240105 AND 20240124 GROUP BY kota"""
    q["distinct_values"] = union(
        f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM {t} WHERE {c} IS NOT NULL"
        for t, c in (
            ("dim_customer", "kota"),
            ("dim_customer", "account_tier"),
            ("dim_product", "kategori"),
            ("dim_warehouse", "warehouse_name"),
            ("dim_device", "platform"),
        )
    )
    q["order_date_span"] = """
        SELECT min(full_date) AS min_d, max(full_date) AS max_d FROM dim_date
        WHERE date_key IN (SELECT date_key FROM fact_orders)"""
    q["run_metrics"] = union(
        f"SELECT '{name}' AS metric, {big(measure)} AS value FROM {table}"
        for name, table, measure in (
            ("total_revenue", "fact_orders", "sum(gross_revenue_idr)"),
            ("net_stock_change", "fact_inventory_movements", "sum(signed_quantity)"),
            ("distinct_sessions", "fact_web_clickstream", "count(DISTINCT session_id)"),
            ("orphan_orders", "orphan_orders", "count(*)"),
            ("orphan_movements", "orphan_movements", "count(*)"),
        )
    )

    q["a1_monthly_kpi"] = f"""
        SELECT year, month, month_name, count(*) AS total_order,
               {big("sum(quantity)")} AS total_unit_terjual,
               {big("sum(gross_revenue_idr)")} AS total_revenue_idr,
               {big("sum(gross_profit_idr)")} AS total_profit_idr,
               {ratio("sum(gross_revenue_idr)", "count(*)", 0)} AS avg_order_value_idr
        FROM fact_orders JOIN dim_date USING (date_key) GROUP BY ALL"""
    q["a2_category_revenue"] = a2("fact_orders")
    q["a3_top_products"] = a3("fact_orders")
    q["a4_status_share"] = a4("fact_orders")
    q["a5_payment_pref"] = a5("fact_orders")
    q["a6_city_revenue"] = a6("fact_orders")
    q["b1_tier_segment"] = b1("dim_customer")
    q["b2_top_customers"] = b2("dim_customer")
    q["b3_dormant"] = b3("dim_customer")
    q["c1_funnel"] = c1("fact_web_clickstream")
    q["c2_page_latency"] = c2("fact_web_clickstream")
    q["c3_device_split"] = c3("fact_web_clickstream")
    q["c4_conversion"] = c4("fact_web_clickstream")
    q["d1_low_stock"] = d1("fact_inventory_movements")
    q["d2_movement_summary"] = f"""
        SELECT warehouse_name, jenis_mutasi, count(*) AS jumlah_transaksi,
               {big("sum(quantity_change)")} AS total_unit_bergerak,
               {big("sum(signed_quantity)")} AS net_effect_terhadap_stok
        FROM fact_inventory_movements JOIN dim_warehouse USING (warehouse_key) GROUP BY ALL"""
    q["d3_top_defects"] = d3("fact_inventory_movements")
    q["e1_daily_summary"] = f"""
        SELECT full_date, coalesce(a, 0) AS total_order, {big("coalesce(b, 0)")} AS total_revenue_idr,
               coalesce(c, 0) AS total_web_hit, coalesce(s, 0) AS unique_session,
               coalesce(g, 0) AS total_pergerakan_gudang
        FROM dim_date
        LEFT JOIN (SELECT date_key, count(*) AS a, sum(gross_revenue_idr) AS b
                   FROM fact_orders GROUP BY ALL) USING (date_key)
        LEFT JOIN (SELECT date_key, count(*) AS c, count(DISTINCT session_id) AS s
                   FROM fact_web_clickstream GROUP BY ALL) USING (date_key)
        LEFT JOIN (SELECT date_key, count(*) AS g FROM fact_inventory_movements GROUP BY ALL)
            USING (date_key)
        WHERE full_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"""
    q["e2_category_risk"] = f"""
        SELECT kategori, {big("sum(gross_revenue_idr)")} AS total_revenue_idr,
               {big(f"coalesce(sum(quantity_change) {DEFECT}, 0)")} AS total_unit_rusak
        FROM dim_product LEFT JOIN fact_orders USING (product_key)
        LEFT JOIN fact_inventory_movements USING (product_key) GROUP BY kategori"""
    q["e2_category_risk_fixed"] = E2_FIXED.format(
        revenue="total_revenue_idr", defects="total_unit_rusak"
    )

    q["kpi_summary"] = KPI
    q["home_kpis"] = f"""
        SELECT total_revenue, total_profit, total_orders, avg_order_value AS aov, total_customers,
               total_web_sessions AS total_sessions, delivered_rate, net_stock_change AS net_stock
        FROM ({KPI})"""
    q["kpi_margin"] = f"""
        SELECT {ratio("sum(gross_profit_idr)", "sum(gross_revenue_idr)", 1, 100)} AS margin_pct
        FROM fact_orders"""
    q["fmt_kpi_labels"] = f"""
        SELECT {rupiah("total_revenue")} AS revenue_label, {rupiah("total_profit")} AS profit_label,
               {percent("total_profit::DOUBLE / total_revenue * 100")} AS margin_label,
               {number("total_orders")} AS orders_label, {rupiah("avg_order_value")} AS aov_label,
               {percent("delivered_rate")} AS delivered_label,
               {number("total_customers")} AS customers_label,
               {number("total_web_sessions")} AS sessions_label,
               CASE WHEN net_stock_change >= 0 THEN '+' ELSE '' END || {number("net_stock_change")}
                   AS net_stock_label
        FROM ({KPI})"""
    home = _counted(
        (
            ("CRM (dim_customer)", "dim_customer"),
            ("MDM (dim_product)", "dim_product"),
            ("OMS (fact_orders)", "fact_orders"),
            ("WMS (fact_inventory_movements)", "fact_inventory_movements"),
            ("Web Analytics (fact_web_clickstream)", "fact_web_clickstream"),
        )
    )
    q["home_source_counts"] = f"SELECT * FROM ({union(home)}) t(sumber, baris)"

    q["chart_daily_revenue"] = f"""
        SELECT full_date, {big("sum(gross_revenue_idr)")} AS revenue
        FROM fact_orders JOIN dim_date USING (date_key) GROUP BY full_date"""
    q["chart_category_revenue"] = f"""
        SELECT kategori, {big("sum(gross_revenue_idr)")} AS revenue
        FROM fact_orders JOIN dim_product USING (product_key) GROUP BY kategori"""
    q["chart_status"] = f"""
        SELECT status_order, count(*) AS n,
               {ratio("count(*)", "(SELECT count(*) FROM fact_orders)", 1, 100)} AS share_pct
        FROM fact_orders GROUP BY status_order"""
    q["chart_payment"] = f"""
        SELECT payment_method_name, count(*) AS n, {big("sum(gross_revenue_idr)")} AS revenue
        FROM fact_orders JOIN dim_payment_method USING (payment_method_key) GROUP BY ALL"""
    q["chart_funnel"] = """
        SELECT funnel_order, funnel_stage, count(DISTINCT session_id) AS sessions
        FROM fact_web_clickstream JOIN dim_page USING (page_key) GROUP BY ALL"""
    q["chart_device"] = f"""
        SELECT device_type_code, count(*) AS n,
               {ratio("count(*)", "(SELECT count(*) FROM fact_web_clickstream)", 1, 100)} AS share_pct
        FROM fact_web_clickstream JOIN dim_device USING (device_key) GROUP BY ALL"""
    q["chart_top_products"] = f"""
        SELECT nama_produk, {big("sum(gross_revenue_idr)")} AS revenue
        FROM fact_orders JOIN dim_product USING (product_key) WHERE is_delivered = 1
        GROUP BY ALL ORDER BY revenue DESC, nama_produk LIMIT 10"""
    moved = ", ".join(
        f"{big(f"coalesce(sum(quantity_change) FILTER (jenis_mutasi = '{t}'), 0)")} AS \"{t}\""
        for t in ("INBOUND", "RETUR_STOCK", "OUTBOUND", "ADJUSTMENT_DEFECT")
    )
    q["chart_warehouse_pivot"] = f"""
        SELECT warehouse_name, {moved}
        FROM fact_inventory_movements JOIN dim_warehouse USING (warehouse_key) GROUP BY ALL"""

    q["ins_dormant_share"] = f"""
        SELECT count(*) FILTER (n IS NULL) AS dormant_customers, count(*) AS total_customers,
               {ratio("count(*) FILTER (n IS NULL)", "count(*)", 1, 100)} AS dormant_pct
        FROM dim_customer
        LEFT JOIN (SELECT customer_key, count(*) AS n FROM fact_orders GROUP BY ALL)
            USING (customer_key)"""
    q["ins_net_stock_by_wh"] = f"""
        SELECT warehouse_name, {big("sum(signed_quantity)")} AS net_stock,
               (sum(signed_quantity) < 0)::INTEGER AS needs_restock
        FROM fact_inventory_movements JOIN dim_warehouse USING (warehouse_key) GROUP BY ALL"""
    q["ins_platform_share"] = f"""
        SELECT platform, count(*) AS hits,
               {ratio("count(*)", "(SELECT count(*) FROM fact_web_clickstream)", 1, 100)} AS share_pct
        FROM fact_web_clickstream JOIN dim_device USING (device_key) GROUP BY ALL"""
    q["ins_slowest_page"] = f"""
        SELECT page_url, {ratio("sum(response_time_ms)", "count(*)", 1)} AS avg_response_time_ms
        FROM fact_web_clickstream JOIN dim_page USING (page_key)
        GROUP BY page_url ORDER BY avg_response_time_ms DESC, page_url LIMIT 1"""
    rates = c4("fact_web_clickstream")
    q["ins_city_extremes"] = f"""
        SELECT b.kota AS best_city, b.conversion_rate_pct AS best_rate_pct,
               w.kota AS worst_city, w.conversion_rate_pct AS worst_rate_pct
        FROM (SELECT * FROM ({rates}) ORDER BY conversion_rate_pct DESC, kota LIMIT 1) b,
             (SELECT * FROM ({rates}) ORDER BY conversion_rate_pct, kota LIMIT 1) w"""
    q["ins_fulfilment_rates"] = f"""
        SELECT {ratio("sum(is_delivered)", "count(*)", 1, 100)} AS delivered_pct,
               {ratio("sum(is_cancelled)", "count(*)", 1, 100)} AS cancelled_pct,
               {ratio("sum(is_returned)", "count(*)", 1, 100)} AS returned_pct
        FROM fact_orders"""

    q["dq_suite"] = _dq_suite()
    pairs = (
        ("crm_vs_dim_customer", "crm", "dim_customer"),
        ("mdm_vs_dim_product", "mdm", "dim_product"),
        ("oms_vs_fact_orders", "oms_raw", "fact_orders"),
        ("wms_vs_fact_inventory", "wms_raw", "fact_inventory_movements"),
        ("web_vs_fact_clickstream", "web", "fact_web_clickstream"),
    )
    q["dq1_row_counts"] = union(
        f"SELECT '{name}' AS check_name, (SELECT count(*) FROM {s}) AS staging_count,"
        f" (SELECT count(*) FROM {t}) AS mart_count"
        for name, s, t in pairs
    )
    for name, fact in (
        ("dq2_orders_null_fk", "fact_orders"),
        ("dq3_moves_null_fk", "fact_inventory_movements"),
        ("dq4_clicks_null_fk", "fact_web_clickstream"),
    ):
        # every dimension key but the date, and the customer of a hit, must be present
        keys = [k for f, k, _ in FOREIGN_KEYS if f == fact and k != "date_key" and k in COLUMNS[f].split()]
        missing = " OR ".join(f"{k} IS NULL" for k in keys)
        q[name] = f"SELECT {', '.join([NATURAL_KEYS[fact], *keys])} FROM {fact} WHERE {missing}"
    q["dq5_duplicates"] = union(
        f"SELECT '{t}.{k}' AS kolom, {k} AS nilai, count(*) AS jumlah FROM {t}"
        f" GROUP BY {k} HAVING count(*) > 1"
        for t, k in (
            ("dim_customer", "user_id"),
            ("dim_product", "product_id"),
            ("fact_orders", "order_id"),
        )
    )
    q["dq6_order_rules"] = """
        SELECT order_id, quantity, gross_revenue_idr FROM fact_orders
        WHERE quantity <= 0 OR gross_revenue_idr < 0"""
    q["dq7_margin_range"] = """
        SELECT product_id, margin_idr, margin_pct FROM dim_product
        WHERE margin_pct < 0 OR margin_pct > 100"""
    q["dq8_date_fk"] = """
        SELECT order_id, date_key FROM fact_orders
        WHERE date_key NOT IN (SELECT date_key FROM dim_date)"""

    q["page_sales_filtered"] = f"""
        SELECT order_id, full_date, nama_lengkap, kota, nama_produk, kategori, payment_method_name,
               status_order, quantity, gross_revenue_idr, gross_profit_idr
        FROM {SALES} JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
        JOIN dim_customer USING (customer_key) JOIN dim_payment_method USING (payment_method_key)"""
    q["page_sales_daily"] = f"""
        SELECT full_date, {big("sum(gross_revenue_idr)")} AS revenue,
               {big("sum(gross_profit_idr)")} AS profit
        FROM {SALES} JOIN dim_date USING (date_key) GROUP BY full_date"""
    q["page_sales_category"] = a2(SALES)
    q["page_sales_city"] = a6(SALES)
    q["page_sales_status"] = a4(SALES)
    q["page_sales_payment"] = a5(SALES)
    q["page_sales_top"] = a3(SALES)
    q["page_customer_tier"] = b1(MEMBERS)
    q["page_customer_top"] = b2(MEMBERS)
    q["page_customer_dormant"] = b3(MEMBERS)
    q["page_signup_trend"] = f"""
        SELECT date_trunc('month', signup_date)::DATE AS signup_month, count(*) AS new_customers
        FROM {MEMBERS} GROUP BY ALL"""
    q["page_web_platform"] = c1(MOBILE)
    q["page_web_device"] = c3(MOBILE)
    q["page_web_latency"] = c2(MOBILE)
    q["page_web_conversion"] = c4(MOBILE)
    q["page_inventory_filtered"] = d1(STOCK)
    q["page_inventory_volume"] = f"""
        SELECT warehouse_name, count(*) AS movements, {big("sum(quantity_change)")} AS units
        FROM {STOCK} JOIN dim_warehouse USING (warehouse_key) GROUP BY ALL"""
    q["page_inventory_defects"] = d3(STOCK)
    chosen = f"(SELECT * FROM dim_product WHERE {_values('kategori', CATEGORIES)})"
    nearby = f"(SELECT * FROM dim_customer WHERE {_values('kota', CITIES)})"
    days = "date_key BETWEEN 20240105 AND 20240124"
    among = lambda fact, key, dim: f"(SELECT * FROM {fact} WHERE {key} IN (SELECT {key} FROM {dim})"
    q["page_sales_kpi"] = kpi(
        SALES,
        nearby,
        chosen,
        f"{among('fact_web_clickstream', 'customer_key', nearby)} AND {days})",
        f"{among('fact_inventory_movements', 'product_key', chosen)} AND {days})",
    )
    q["page_web_kpi"] = kpi(web=MOBILE)
    q["page_inventory_kpi"] = kpi(
        f"{among('fact_orders', 'product_key', chosen)})", products=chosen, moves=STOCK
    )
    q["page_web_detail"] = f"""
        SELECT log_id, full_date, session_id, page_url, funnel_stage, platform, operating_system, response_time_ms
        FROM {MOBILE} JOIN dim_date USING (date_key) JOIN dim_page USING (page_key)
        JOIN dim_device USING (device_key)"""
    q["page_inventory_detail"] = f"""
        SELECT movement_id, full_date, product_id, nama_produk, kategori, warehouse_name, warehouse_code,
               jenis_mutasi, quantity_change, signed_quantity
        FROM {STOCK} JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
        JOIN dim_warehouse USING (warehouse_key)"""
    q["page_customer_detail"] = f"""
        SELECT user_id, nama_lengkap, kota, account_tier, signup_date, tenure_days_as_of_load
        FROM {MEMBERS}"""
    q["page_exec_scatter"] = E2_FIXED.format(revenue="revenue", defects="defect_units")
    same = ROLLED_UP + ["e1_daily_summary", "page_sales_city", "page_web_latency", "page_inventory_volume", "page_inventory_defects"]
    q |= {f"rollup_{name}": q[name] for name in same}
    on_curve = "page_sales_daily page_sales_category page_sales_filtered page_web_latency page_inventory_volume page_inventory_defects"
    q |= {f"placed_{name}": q[name] for name in [*on_curve.split(), "fact_orders"]}
    q["rollup_page_category"] = a2(SALES.replace(CITY, ""))
    for name, key, rows in (
        ("daily", "date_key", "fact_web_clickstream"),
        ("page", "page_key", f"(SELECT * FROM fact_web_clickstream WHERE {days})"),
        ("device", "device_key", MOBILE),
    ):
        q[f"sketch_{name}_sessions"] = f"""
            SELECT {key}, count(DISTINCT session_id) AS exact, TRUE AS near FROM {rows} GROUP BY {key}"""
    return q


def _faulty(body: str) -> str:
    """A statement over the mart with the planted faults."""
    tables = sorted({*VALUES, *TWICE})
    good = ", ".join(f"good_{t} AS (SELECT * FROM {t})" for t in [*tables, "etl_run_log"])

    def bad(t: str) -> str:
        values = ", ".join(f"{changed(c, cases)} AS {c}" for c, cases in VALUES.get(t, {}).items())
        rows = f"SELECT * {f'REPLACE ({values})' if values else ''} FROM good_{t}"
        return f"{t} AS ({rows}{f' UNION ALL SELECT * FROM good_{t} WHERE {TWICE[t]}' if t in TWICE else ''})"

    log = "etl_run_log AS (SELECT * FROM good_etl_run_log UNION ALL SELECT * FROM good_etl_run_log WHERE run_id = 0)"
    return f"{BASE}, {good}\nSELECT * FROM (WITH {', '.join([*map(bad, tables), log])}\n{body.strip()})"


def oracle_sql() -> dict[str, str]:
    bodies = _bodies()
    plain = {name: BASE + body.strip() for name, body in bodies.items()}
    return plain | {f"{name}_faulty": _faulty(bodies[name]) for name in CHECKED}
