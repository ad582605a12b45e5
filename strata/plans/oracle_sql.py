"""DuckDB SQL for every registered query, over the raw test tables.

Written independently of the Spark code: plain SQL with window functions where the
Spark side uses the skew-safe plans. The feed formulas repeat ``strata.plans.feeds``.
Integer text is cast only when it is an integer literal (Spark's cast rejects
``'40.0'``; DuckDB's would accept it).
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"


def _fmt(expr: str) -> str:
    return f"strftime({expr}, {TS})"


def _int(expr: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({expr}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({expr}) AS INTEGER) END")


def _ts(expr: str) -> str:
    return f"try_strptime({expr}, {TS})"


ORDERS_FEED = f"""
orders_feed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderstatus END AS order_status,
    {_fmt('o_orderdate')} AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN 'n/a'
         ELSE {_fmt('o_orderdate + to_hours(CAST(o_orderkey % 72 AS INTEGER))')} END AS order_approved_at,
    CASE WHEN o_orderstatus = 'O' THEN NULL
         ELSE {_fmt('o_orderdate + to_hours(CAST(o_orderkey % 120 AS INTEGER))')} END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'O' THEN NULL
         ELSE {_fmt('o_orderdate + to_hours(CAST(o_orderkey % 1000 AS INTEGER))')} END AS order_delivered_customer_date,
    {_fmt('o_orderdate + to_hours(480)')} AS order_estimated_delivery_date
  FROM orders)"""

ITEMS_FEED = f"""
order_items_feed AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_linenumber AS VARCHAR) AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id,
    CAST(l_suppkey AS VARCHAR) AS seller_id,
    {_fmt('l_shipdate')} AS shipping_limit_date,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 101 = 0 THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
         WHEN (l_orderkey * 3 + l_linenumber) % 103 = 0 THEN 'abc'
         WHEN (l_orderkey + l_linenumber) % 127 = 0 THEN NULL
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
    CASE WHEN (l_orderkey + l_linenumber) % 37 = 0 THEN NULL
         ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS freight_value
  FROM lineitem)"""

CUST_BASE = """
cust_base AS (
  SELECT * FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def _cust_cols(unique_id: str | None = None, city: str | None = None) -> str:
    uid = unique_id or "CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE c_name END"
    cty = city or ("CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 3 = 0 "
                   "THEN '  ' || lower(n_name) || ' ' ELSE n_name END")
    return (
        f"CAST(c_custkey AS VARCHAR) AS customer_id, {uid} AS customer_unique_id, "
        "lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix, "
        f"{cty} AS customer_city, "
        "CASE WHEN c_custkey % 43 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN lower(r_name) "
        "ELSE r_name END AS customer_state"
    )


CUSTOMERS_FEED = f"""
customers_feed AS (SELECT {_cust_cols()} FROM cust_base)"""


def _batch(i: int, cols: str, where: str | None = None) -> str:
    ts = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"][i]
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {cols}, TIMESTAMP '{ts}' AS _ingest_timestamp, "
            f"'batch-{i + 1}' AS _source_file FROM cust_base{w}")


CUSTOMER_LOG = f"""
customer_log AS (
  {_batch(0, _cust_cols())}
  UNION ALL {_batch(1, _cust_cols(city="n_name || ' NORTE'"), "c_custkey % 5 = 0")}
  UNION ALL {_batch(1, _cust_cols(), "c_custkey % 5 = 1")}
  UNION ALL {_batch(1, _cust_cols(unique_id="c_name || '-2'"), "c_custkey % 5 = 2")}
  UNION ALL {_batch(1, _cust_cols(city="n_name || ' SUL'"), "c_custkey % 11 = 4")}
  UNION ALL {_batch(1, _cust_cols(city="n_name || ' OESTE'"), "c_custkey % 11 = 4")}
  UNION ALL {_batch(2, _cust_cols(), "c_custkey % 10 = 0 AND c_custkey % 41 <> 0")}
  UNION ALL {_batch(2, _cust_cols(city="n_name"), "c_custkey % 41 = 0")}
)"""


def _preprocess(src: str, name: str, extra: str = "") -> str:
    return f"""
{name} AS (
  SELECT *, concat_ws(', ', customer_city, customer_state) AS customer_location FROM (
    SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
      trim(upper(customer_city)) AS customer_city,
      trim(upper(customer_state)) AS customer_state{extra}
    FROM {src})
  WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL)"""


PRODUCTS_FEED = """
products_feed AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_partkey % 37 = 0 THEN NULL
         WHEN p_partkey % 5 = 0 THEN ' ' || p_type || ' '
         WHEN p_partkey % 5 = 1 THEN lower(p_type)
         ELSE p_type END AS product_category_name,
    CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
    CASE WHEN p_partkey % 13 = 0 THEN CAST(p_size AS VARCHAR) || '.0'
         ELSE CAST(p_size * 10 AS VARCHAR) END AS product_description_lenght,
    CAST(p_size % 5 AS VARCHAR) AS product_photos_qty,
    CASE WHEN p_partkey % 17 = 0 THEN 'heavy'
         ELSE CAST(CAST(p_retailprice - 950 AS DECIMAL(18,2)) AS VARCHAR) END AS product_weight_g,
    CAST(p_size AS VARCHAR) AS product_length_cm,
    CAST(p_size % 7 + 1 AS VARCHAR) AS product_height_cm,
    CAST(p_size % 11 + 2 AS VARCHAR) AS product_width_cm
  FROM part)"""

CATEGORY = """
category_feed AS (
  SELECT DISTINCT p_type || ' ' AS product_category_name,
         'EN_' || p_type AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
silver_product_category_all AS (
  SELECT trim(lower(product_category_name)) AS product_category_name,
         trim(lower(product_category_name_english)) AS product_category_name_english
  FROM category_feed),
silver_product_category AS (
  SELECT * FROM silver_product_category_all WHERE product_category_name IS NOT NULL)"""

SILVER_ORDERS = f"""
orders_typed AS (
  SELECT order_id, customer_id, order_status,
    {_ts('order_purchase_timestamp')} AS order_purchase_timestamp,
    {_ts('order_approved_at')} AS order_approved_at,
    {_ts('order_delivered_carrier_date')} AS order_delivered_carrier_date,
    {_ts('order_delivered_customer_date')} AS order_delivered_customer_date,
    {_ts('order_estimated_delivery_date')} AS order_estimated_delivery_date
  FROM orders_feed),
silver_orders_all AS (
  SELECT *,
    CASE WHEN order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
         THEN CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                             CAST(order_delivered_customer_date AS DATE)) AS INTEGER) END
      AS delivery_delay_days,
    CASE WHEN order_approved_at IS NOT NULL AND order_purchase_timestamp IS NOT NULL
         THEN CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                             CAST(order_approved_at AS DATE)) AS INTEGER) END
      AS order_processing_days,
    CASE WHEN order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
         THEN order_delivered_customer_date > order_estimated_delivery_date END
      AS is_late_delivery
  FROM orders_typed),
silver_orders AS (
  SELECT * FROM silver_orders_all
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IS NOT NULL)"""

SILVER_ITEMS = f"""
silver_items_all AS (
  SELECT *, round(price + freight_value, 2) AS total_item_value FROM (
    SELECT order_id, {_int('order_item_id')} AS order_item_id, product_id, seller_id,
      {_ts('shipping_limit_date')} AS shipping_limit_date,
      TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(freight_value AS DOUBLE) AS freight_value
    FROM order_items_feed)),
silver_order_items AS (
  SELECT * FROM silver_items_all
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND price IS NOT NULL AND price >= 0)"""

SILVER_PRODUCTS = f"""
products_typed AS (
  SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3 FROM (
    SELECT product_id, trim(lower(product_category_name)) AS product_category_name,
      {_int('product_name_lenght')} AS product_name_length,
      {_int('product_description_lenght')} AS product_description_length,
      {_int('product_photos_qty')} AS product_photos_qty,
      TRY_CAST(product_weight_g AS DOUBLE) AS product_weight_g,
      TRY_CAST(product_length_cm AS DOUBLE) AS product_length_cm,
      TRY_CAST(product_height_cm AS DOUBLE) AS product_height_cm,
      TRY_CAST(product_width_cm AS DOUBLE) AS product_width_cm
    FROM products_feed)),
silver_products_all AS (
  SELECT p.product_category_name, p.product_id, p.product_name_length,
    p.product_description_length, p.product_photos_qty, p.product_weight_g,
    p.product_length_cm, p.product_height_cm, p.product_width_cm, p.product_volume_cm3,
    c.product_category_name_english
  FROM products_typed p LEFT JOIN silver_product_category c
    ON p.product_category_name = c.product_category_name),
silver_products AS (SELECT * FROM silver_products_all WHERE product_id IS NOT NULL)"""

TRACKED = ["customer_zip_code_prefix", "customer_city", "customer_state", "customer_location"]

CUSTOMER_HISTORY = (
    _preprocess("customer_log", "customer_changes", ", _ingest_timestamp")
    + """,
c_dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY customer_id, _ingest_timestamp
      ORDER BY customer_unique_id DESC NULLS LAST, customer_zip_code_prefix DESC NULLS LAST,
               customer_city DESC NULLS LAST, customer_state DESC NULLS LAST,
               customer_location DESC NULLS LAST) AS rn
    FROM customer_changes) WHERE rn = 1),
c_flag AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1
    WHEN """ + " OR ".join(f"(lag({c}) OVER w IS DISTINCT FROM {c})" for c in TRACKED) + """
    THEN 1 ELSE 0 END AS chg
  FROM c_dedup WINDOW w AS (PARTITION BY customer_id ORDER BY _ingest_timestamp)),
c_ver AS (
  SELECT *, sum(chg) OVER (PARTITION BY customer_id ORDER BY _ingest_timestamp
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver
  FROM c_flag),
c_versions AS (
  SELECT customer_id, ver, min(_ingest_timestamp) AS start_at,
    arg_max_null(customer_unique_id, _ingest_timestamp) AS customer_unique_id,
    """ + ",\n    ".join(f"arg_min_null({c}, _ingest_timestamp) AS {c}" for c in TRACKED) + """
  FROM c_ver GROUP BY customer_id, ver),
customer_history AS (
  SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
    customer_state, customer_location, start_at AS __START_AT,
    lead(start_at) OVER (PARTITION BY customer_id ORDER BY start_at) AS __END_AT
  FROM c_versions),
dim_customers AS (
  SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
    customer_state, customer_location
  FROM customer_history WHERE __END_AT IS NULL)"""
)

DIM_PRODUCTS = """
dim_products AS (
  SELECT product_id, product_category_name, product_category_name_english, product_weight_g,
    product_length_cm, product_height_cm, product_width_cm, product_volume_cm3
  FROM silver_products)"""

FACT = """
fct_order_items AS (
  SELECT i.order_id, i.order_item_id, i.product_id, o.customer_id, i.seller_id,
    o.order_status, o.order_purchase_timestamp, o.order_approved_at,
    o.order_delivered_customer_date, o.order_estimated_delivery_date,
    i.shipping_limit_date, o.delivery_delay_days, o.order_processing_days,
    o.is_late_delivery, i.price, i.freight_value, i.total_item_value,
    c.customer_city, c.customer_state, c.customer_location,
    p.product_category_name, p.product_category_name_english, p.product_volume_cm3
  FROM silver_order_items i
  JOIN silver_orders o ON i.order_id = o.order_id
  JOIN dim_customers c ON o.customer_id = c.customer_id
  JOIN dim_products p ON i.product_id = p.product_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORDERS_CTES = (ORDERS_FEED, SILVER_ORDERS)
ITEMS_CTES = (ITEMS_FEED, SILVER_ITEMS)
PRODUCT_CTES = (PRODUCTS_FEED, CATEGORY, SILVER_PRODUCTS)
HISTORY_CTES = (CUST_BASE, CUSTOMER_LOG, CUSTOMER_HISTORY)

ORDER_COLS = """order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
  order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
  delivery_delay_days, order_processing_days, is_late_delivery"""

ITEM_COLS = """order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
  freight_value, total_item_value"""

PRODUCT_COLS = """product_category_name, product_id, product_name_length,
  product_description_length, product_photos_qty, product_weight_g, product_length_cm,
  product_height_cm, product_width_cm, product_volume_cm3, product_category_name_english"""

CUSTOMER_COLS = """customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
  customer_state, customer_location"""


def _bronze(feed_ctes: tuple[str, ...], feed: str) -> str:
    return _with(*feed_ctes) + f"SELECT * FROM {feed}"


def _rule_rows(dataset: str, table: str, rules: list[tuple[str, str]]) -> str:
    parts = []
    for name, pred in rules:
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{name}' AS rule, "
            f"CAST(count_if(coalesce({pred}, false)) AS BIGINT) AS passed, "
            f"CAST(count(*) - count_if(coalesce({pred}, false)) AS BIGINT) AS failed FROM {table}"
        )
    return " UNION ALL ".join(parts)


def _events_scd2() -> str:
    return """
WITH d AS (
  SELECT user_id, ts, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
    FROM events) WHERE rn = 1),
f AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1
                 WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS chg
  FROM d WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
v AS (
  SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver FROM f),
g AS (
  SELECT user_id, ver, min(ts) AS start_at, arg_min_null(event_type, ts) AS event_type,
         arg_max_null(value, ts) AS value
  FROM v GROUP BY user_id, ver)
SELECT user_id, event_type, value, start_at AS __START_AT,
  lead(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS __END_AT
FROM g"""


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_orders"] = _bronze((ORDERS_FEED,), "orders_feed")
    q["bronze_order_items"] = _bronze((ITEMS_FEED,), "order_items_feed")
    q["bronze_customers"] = _bronze((CUST_BASE, CUSTOMERS_FEED), "customers_feed")
    q["bronze_products"] = _bronze((PRODUCTS_FEED,), "products_feed")
    q["bronze_product_category"] = _bronze((CATEGORY,), "category_feed")

    q["silver_orders"] = _with(*ORDERS_CTES) + f"SELECT {ORDER_COLS} FROM silver_orders"
    q["late_by_day"] = _with(*ORDERS_CTES) + (
        "SELECT order_id, delivery_delay_days, "
        "coalesce(delivery_delay_days > 0, false) AS is_late_delivery FROM silver_orders")
    q["silver_order_items"] = _with(*ITEMS_CTES) + f"SELECT {ITEM_COLS} FROM silver_order_items"
    q["silver_customers_preprocessed"] = _with(
        CUST_BASE, CUSTOMERS_FEED, _preprocess("customers_feed", "cp")
    ) + f"SELECT {CUSTOMER_COLS} FROM cp"
    q["silver_product_category"] = _with(CATEGORY) + "SELECT * FROM silver_product_category"
    q["silver_products"] = _with(*PRODUCT_CTES) + f"SELECT {PRODUCT_COLS} FROM silver_products"
    q["silver_products_stream"] = q["silver_products"]
    q["silver_products_valid_weight"] = _with(*PRODUCT_CTES) + (
        f"SELECT {PRODUCT_COLS} FROM silver_products WHERE coalesce(product_weight_g > 0, false)")

    q["customers_scd2"] = _with(*HISTORY_CTES) + "SELECT * FROM customer_history"
    q["customers_scd2_incremental"] = q["customers_scd2"]
    q["events_scd2"] = _events_scd2()
    q["dim_customers"] = _with(*HISTORY_CTES) + "SELECT * FROM dim_customers"
    q["dim_products"] = _with(*PRODUCT_CTES, DIM_PRODUCTS) + "SELECT * FROM dim_products"
    q["fct_order_items"] = _with(
        *ORDERS_CTES, *ITEMS_CTES, *PRODUCT_CTES, DIM_PRODUCTS, *HISTORY_CTES, FACT
    ) + "SELECT * FROM fct_order_items"
    q["fct_order_items_stream"] = q["fct_order_items"]
    q["fct_orders"] = _with(*ORDERS_CTES, *HISTORY_CTES) + """
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
  o.order_approved_at, o.order_delivered_customer_date, o.order_estimated_delivery_date,
  o.delivery_delay_days, o.order_processing_days, o.is_late_delivery,
  c.customer_unique_id, c.customer_city, c.customer_state, c.customer_location
FROM silver_orders o JOIN dim_customers c ON o.customer_id = c.customer_id"""

    from strata.config import OPTIONAL_RULES, SILVER_RULES

    q["dq_metrics"] = _with(
        *ORDERS_CTES, *ITEMS_CTES, CUST_BASE, CUSTOMERS_FEED,
        """
cust_all AS (
  SELECT *, concat_ws(', ', customer_city, customer_state) AS customer_location FROM (
    SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
      trim(upper(customer_city)) AS customer_city, trim(upper(customer_state)) AS customer_state
    FROM customers_feed))""",
        *PRODUCT_CTES,
    ) + " UNION ALL ".join([
        _rule_rows("silver_orders", "silver_orders_all", SILVER_RULES["orders"]),
        _rule_rows("silver_order_items", "silver_items_all", SILVER_RULES["order_items"]),
        _rule_rows("silver_customers_preprocessed", "cust_all", SILVER_RULES["customers"]),
        _rule_rows("silver_product_category", "silver_product_category_all",
                   SILVER_RULES["product_category"]),
        _rule_rows("silver_products", "silver_products_all",
                   SILVER_RULES["products"] + OPTIONAL_RULES["products"]),
    ])

    q["pk_check"] = _with(*ORDERS_CTES, *ITEMS_CTES, *PRODUCT_CTES, DIM_PRODUCTS,
                          *HISTORY_CTES) + """
SELECT 'silver_orders' AS dataset, order_id AS key_value, count(*) AS n_rows
  FROM silver_orders GROUP BY order_id HAVING count(*) > 1 OR order_id IS NULL
UNION ALL
SELECT 'silver_order_items',
  concat_ws('|', coalesce(order_id, '\\N'), coalesce(CAST(order_item_id AS VARCHAR), '\\N')), count(*)
  FROM silver_order_items GROUP BY order_id, order_item_id
  HAVING count(*) > 1 OR order_id IS NULL OR order_item_id IS NULL
UNION ALL
SELECT 'silver_product_category', product_category_name, count(*)
  FROM silver_product_category GROUP BY product_category_name
  HAVING count(*) > 1 OR product_category_name IS NULL
UNION ALL
SELECT 'dim_customers', customer_id, count(*) FROM dim_customers GROUP BY customer_id
  HAVING count(*) > 1 OR customer_id IS NULL
UNION ALL
SELECT 'dim_products', product_id, count(*) FROM dim_products GROUP BY product_id
  HAVING count(*) > 1 OR product_id IS NULL"""

    q["fk_check"] = _with(*ORDERS_CTES, *ITEMS_CTES, *PRODUCT_CTES, *HISTORY_CTES) + """
SELECT 'order_items.order_id' AS relation, order_id AS key_value, count(*) AS n_rows
  FROM silver_order_items WHERE order_id IS NOT NULL
  AND order_id NOT IN (SELECT order_id FROM silver_orders WHERE order_id IS NOT NULL)
  GROUP BY order_id
UNION ALL
SELECT 'order_items.product_id', product_id, count(*)
  FROM silver_order_items WHERE product_id IS NOT NULL
  AND product_id NOT IN (SELECT product_id FROM silver_products WHERE product_id IS NOT NULL)
  GROUP BY product_id
UNION ALL
SELECT 'products.product_category_name', product_category_name, count(*)
  FROM silver_products WHERE product_category_name IS NOT NULL
  AND product_category_name NOT IN (SELECT product_category_name FROM silver_product_category)
  GROUP BY product_category_name
UNION ALL
SELECT 'orders.customer_id', customer_id, count(*)
  FROM silver_orders WHERE customer_id IS NOT NULL
  AND customer_id NOT IN (SELECT customer_id FROM dim_customers WHERE customer_id IS NOT NULL)
  GROUP BY customer_id"""

    q["snapshot_changes"] = _with(*HISTORY_CTES) + f"""
, before AS (
  SELECT {CUSTOMER_COLS} FROM customer_history
  WHERE __START_AT <= TIMESTAMP '2024-01-01 00:00:00'
    AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '2024-01-01 00:00:00')),
after AS (SELECT {CUSTOMER_COLS} FROM dim_customers),
tagged AS (SELECT *, -1 AS side FROM before UNION ALL SELECT *, 1 AS side FROM after),
net AS (
  SELECT {CUSTOMER_COLS}, sum(side) AS net FROM tagged
  GROUP BY {CUSTOMER_COLS} HAVING sum(side) <> 0),
flags AS (
  SELECT customer_id AS fk, bool_or(net < 0) AS had_old, bool_or(net > 0) AS has_new
  FROM net GROUP BY customer_id)
SELECT CASE WHEN net > 0 THEN CASE WHEN had_old THEN 'update_postimage' ELSE 'insert' END
            ELSE CASE WHEN has_new THEN 'update_preimage' ELSE 'delete' END END AS _change_type,
  {CUSTOMER_COLS}, CAST(abs(net) AS BIGINT) AS n_copies
FROM net JOIN flags ON customer_id IS NOT DISTINCT FROM fk"""

    q["change_feed"] = q["snapshot_changes"]
    q["pk_check_incremental"] = q["pk_check"]
    q["fk_check_incremental"] = (
        f"SELECT * FROM ({q['fk_check']}) WHERE relation IN ('order_items.product_id', 'products.product_category_name')")
    q["bronze_lineage"] = _with(CUST_BASE, CUSTOMERS_FEED) + (
        "SELECT 'customers.csv' AS source_folder, count(*) AS n_rows, "
        "CAST(0 AS BIGINT) AS n_corrupt FROM customers_feed")
    q["dq_metrics_stream"] = _with(*PRODUCT_CTES) + _rule_rows(
        "silver_products", "silver_products_all", SILVER_RULES["products"] + OPTIONAL_RULES["products"])
    fact_ctes = (*ORDERS_CTES, *ITEMS_CTES, *PRODUCT_CTES, DIM_PRODUCTS)
    q["fct_order_items_bounded"] = _with(*fact_ctes, *HISTORY_CTES, FACT) + """
SELECT * FROM fct_order_items
WHERE shipping_limit_date BETWEEN order_purchase_timestamp - INTERVAL 60 DAYS
                              AND order_purchase_timestamp + INTERVAL 60 DAYS"""
    q["fct_order_items_unmatched"] = _with(*ORDERS_CTES, *ITEMS_CTES) + """
SELECT count(*) AS n_items,
  CAST(count_if(order_id NOT IN (SELECT order_id FROM silver_orders)) AS BIGINT) AS n_without_order,
  CAST(count_if(order_id IN (SELECT order_id FROM silver_orders) AND NOT EXISTS (
    SELECT 1 FROM silver_orders o WHERE o.order_id = i.order_id
      AND i.shipping_limit_date BETWEEN o.order_purchase_timestamp - INTERVAL 60 DAYS
                                    AND o.order_purchase_timestamp + INTERVAL 60 DAYS)) AS BIGINT) AS n_beyond_gap
FROM silver_order_items i"""
    q["items_by_product_salted"] = _with(*ITEMS_CTES, *PRODUCT_CTES) + """
SELECT i.order_id, i.order_item_id, i.product_id, p.product_category_name
FROM silver_order_items i LEFT JOIN silver_products p ON i.product_id = p.product_id"""
    q["items_by_hot_product_stream"] = _with(*ITEMS_CTES, *PRODUCT_CTES) + """
SELECT i.order_id, i.order_item_id, i.product_id, p.product_category_name
FROM (SELECT order_id, order_item_id,
        CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '1' ELSE product_id END AS product_id
      FROM silver_order_items) i
JOIN silver_products p ON i.product_id = p.product_id"""
    delivered = _preprocess("customers_feed", "dim_customers")
    q["runner_incremental"] = _with(*fact_ctes, CUST_BASE, CUSTOMERS_FEED, delivered, FACT) + (
        "SELECT * FROM fct_order_items")
    props = [
        ("silver", "silver_orders", "orders", "order_id", "silver_orders"),
        ("silver", "silver_products", "products", "product_id", "silver_products"),
        ("silver", "silver_customers", "customers", "customer_id", "(SELECT 1 WHERE false)"),
        ("gold", "dim_products", "products", "product_id", "dim_products"),
        ("gold", "fct_order_items", "order_items", "order_id", "fct_order_items"),
    ]
    rows = []
    for layer, name, domain, cluster, source in props:
        values = {"quality": layer, "layer": layer, "domain": domain, "clustering.columns": cluster,
                  "change.feed": "false" if layer == "gold" else "true"}
        rows += [
            f"SELECT '{name}' AS table_name, '{layer}/{name}' AS place, 'Table {name}' AS table_comment, "
            f"'{k}' AS property, '{v}' AS property_value, count(*) AS n_rows FROM {source}"
            for k, v in values.items()]
    q["table_properties"] = _with(*fact_ctes, *HISTORY_CTES, FACT) + " UNION ALL ".join(rows)
    q["clustered_ranges"] = _with(*ORDERS_CTES) + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_overlaps FROM {source}"
        for name, source in (("bronze_orders", "orders_feed"), ("silver_orders", "silver_orders"),
                             ("silver_orders_merged", "silver_orders")))
    counted = {
        "silver_orders": ("silver_orders", ORDER_COLS), "silver_order_items": ("silver_order_items", ITEM_COLS),
        "silver_customers_preprocessed": ("cp", CUSTOMER_COLS),
        "silver_product_category": ("silver_product_category", "product_category_name, product_category_name_english"),
        "silver_products": ("silver_products", PRODUCT_COLS),
        "silver_customers": ("customer_history", CUSTOMER_COLS + ", __START_AT, __END_AT"),
        "dim_customers": ("dim_customers", CUSTOMER_COLS),
    }
    columns = {name: (source, len(cols.split(","))) for name, (source, cols) in counted.items()}
    columns |= {"dim_products": ("dim_products", 8), "fct_order_items": ("fct_order_items", 23)}
    q["schema_check"] = _with(
        *fact_ctes, *HISTORY_CTES, CUSTOMERS_FEED, _preprocess("customers_feed", "cp"), FACT
    ) + " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS n_rows, CAST({n} AS INTEGER) AS n_columns, "
        f"CAST(0 AS INTEGER) AS n_mismatches FROM {source}" for name, (source, n) in columns.items())
    q["silver_products_late_names"] = q["silver_products"]
    schemas = {
        "silver_orders": ("silver_orders", [
            ("order_id", "string"), ("customer_id", "string"), ("order_status", "string"),
            ("order_purchase_timestamp", "timestamp_ntz"), ("order_approved_at", "timestamp_ntz"),
            ("order_delivered_carrier_date", "timestamp_ntz"), ("order_delivered_customer_date", "timestamp_ntz"),
            ("order_estimated_delivery_date", "timestamp_ntz"), ("delivery_delay_days", "int"),
            ("order_processing_days", "int"), ("is_late_delivery", "boolean")]),
        "silver_customers_preprocessed": ("cp", [(c.strip(), "string") for c in CUSTOMER_COLS.split(",")]),
        "dim_customers": ("dim_customers", [(c.strip(), "string") for c in CUSTOMER_COLS.split(",")]),
    }
    q["dataset_schemas"] = _with(
        *ORDERS_CTES, *HISTORY_CTES, CUSTOMERS_FEED, _preprocess("customers_feed", "cp")
    ) + " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS n_rows, '{column}' AS column_name, '{kind}' AS type, "
        f"{str(column == 'customer_zip_code_prefix').lower()} AS pii FROM {source}"
        for name, (source, columns) in schemas.items() for column, kind in columns)
    q["location_strict"] = _with(CUST_BASE, CUSTOMERS_FEED, _preprocess("customers_feed", "cp")) + (
        "SELECT customer_id, customer_city || ', ' || customer_state AS customer_location FROM cp")
    q["processing_stamps"] = _with(*ORDERS_CTES, *PRODUCT_CTES) + " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS n_stamped FROM {source}"
        for name, source in (("silver_orders", "silver_orders"), ("silver_products", "silver_products"),
                             ("dim_products", "silver_products")))
    return q
