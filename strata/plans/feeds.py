"""Adapter: shape the generic test tables into the five raw feeds.

Kept apart from the engine. The test tables hold no NULLs and no text noise, so the
formulas below add them deterministically (by key modulus) to exercise every rule.
The DuckDB oracle in ``strata.plans.oracle_sql`` repeats these formulas in SQL.
All outputs are all-string, like a CSV feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import TIMESTAMP_FORMAT
from strata.operators.joins import sized_broadcast

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]

# Ingest times of the three customer change batches (sequence of the SCD2 log).
CUSTOMER_BATCHES = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table as scanned (the session's split size decides on the tasks)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fmt(c: Column) -> Column:
    return F.date_format(c, TIMESTAMP_FORMAT)


def _plus_hours(ts: str, hours_sql: str) -> Column:
    return F.col(ts) + F.expr(f"make_dt_interval(0, CAST({hours_sql} AS INT), 0, 0)")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _money(c: str | Column) -> Column:
    """Two-decimal text of a number (values here carry at most two decimals)."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)").cast("string")


def orders_feed(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    open_order = F.col("o_orderstatus") == "O"
    return orders.select(
        _s(k).alias("order_id"),
        F.when(k % 97 == 0, None).otherwise(_s("o_custkey")).alias("customer_id"),
        F.when(k % 89 == 0, None).otherwise(F.col("o_orderstatus")).alias("order_status"),
        _fmt(F.col("o_orderdate")).alias("order_purchase_timestamp"),
        F.when(k % 11 == 0, None)
        .when(k % 53 == 0, F.lit("n/a"))
        .otherwise(_fmt(_plus_hours("o_orderdate", "o_orderkey % 72")))
        .alias("order_approved_at"),
        F.when(open_order, None)
        .otherwise(_fmt(_plus_hours("o_orderdate", "o_orderkey % 120")))
        .alias("order_delivered_carrier_date"),
        F.when(open_order, None)
        .otherwise(_fmt(_plus_hours("o_orderdate", "o_orderkey % 1000")))
        .alias("order_delivered_customer_date"),
        _fmt(_plus_hours("o_orderdate", "480")).alias("order_estimated_delivery_date"),
    )


def order_items_feed(lineitem: DataFrame) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    price = _money("l_extendedprice")
    return lineitem.select(
        _s(k).alias("order_id"),
        _s(n).alias("order_item_id"),
        _s("l_partkey").alias("product_id"),
        _s("l_suppkey").alias("seller_id"),
        _fmt(F.col("l_shipdate")).alias("shipping_limit_date"),
        F.when((k * 7 + n) % 101 == 0, F.concat(F.lit("-"), price))
        .when((k * 3 + n) % 103 == 0, F.lit("abc"))
        .when((k + n) % 127 == 0, None)
        .otherwise(price)
        .alias("price"),
        F.when((k + n) % 37 == 0, None)
        .otherwise(_money("l_quantity"))
        .alias("freight_value"),
    )


def _customer_base(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return customer.join(sized_broadcast(nation, stored=True), F.col("c_nationkey") == F.col("n_nationkey")).join(
        sized_broadcast(region, stored=True), F.col("n_regionkey") == F.col("r_regionkey"))


def _customer_cols(
    unique_id: Column | None = None, city: Column | None = None
) -> list[Column]:
    k = F.col("c_custkey")
    noisy_city = (
        F.when(k % 41 == 0, None)
        .when(k % 3 == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
        .otherwise(F.col("n_name"))
    )
    return [
        _s(k).alias("customer_id"),
        (unique_id if unique_id is not None
         else F.when(k % 59 == 0, None).otherwise(F.col("c_name"))).alias("customer_unique_id"),
        F.lpad(_s(k % 100000), 5, "0").alias("customer_zip_code_prefix"),
        (city if city is not None else noisy_city).alias("customer_city"),
        F.when(k % 43 == 0, None)
        .when(k % 4 == 1, F.lower("r_name"))
        .otherwise(F.col("r_name"))
        .alias("customer_state"),
    ]


def customers_feed(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return _customer_base(customer, nation, region).select(*_customer_cols())


def customer_change_log(
    customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Raw customer rows in three ingest batches, with lineage columns.

    Batch 1: every customer. Batch 2: a city change (key % 5 = 0), an identical repeat
    (% 5 = 1), a change of the untracked unique id only (% 5 = 2), and for key % 11 = 4
    two rows with the same ingest time (a tie). Batch 3: the city changes back
    (key % 10 = 0: A -> B -> A) and missing cities get a value (key % 41 = 0).
    One scan: each customer row expands into the change rows it takes part in.
    """
    k = F.col("c_custkey")
    names = ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
             "customer_city", "customer_state", "_ingest_timestamp", "_source_file"]

    def variant(i: int, cols: list[Column]) -> Column:
        stamp = [F.to_timestamp(F.lit(CUSTOMER_BATCHES[i])), F.lit(f"batch-{i + 1}")]
        return F.struct(*[c.alias(n) for c, n in zip(cols + stamp, names)])

    city = F.col("n_name")
    variants = [
        (F.lit(True), variant(0, _customer_cols())),
        (k % 5 == 0, variant(1, _customer_cols(city=F.concat(city, F.lit(" NORTE"))))),
        (k % 5 == 1, variant(1, _customer_cols())),
        (k % 5 == 2, variant(1, _customer_cols(
            unique_id=F.concat(F.col("c_name"), F.lit("-2"))))),
        (k % 11 == 4, variant(1, _customer_cols(city=F.concat(city, F.lit(" SUL"))))),
        (k % 11 == 4, variant(1, _customer_cols(city=F.concat(city, F.lit(" OESTE"))))),
        ((k % 10 == 0) & (k % 41 != 0), variant(2, _customer_cols())),
        (k % 41 == 0, variant(2, _customer_cols(city=city))),
    ]
    rows = F.filter(
        F.array(*[F.when(cond, v) for cond, v in variants]), lambda x: x.isNotNull()
    )
    return _customer_base(customer, nation, region).select(F.inline(rows))


def products_feed(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        _s(k).alias("product_id"),
        F.when(k % 37 == 0, None)
        .when(k % 5 == 0, F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")))
        .when(k % 5 == 1, F.lower("p_type"))
        .otherwise(F.col("p_type"))
        .alias("product_category_name"),
        _s(F.length("p_name")).alias("product_name_lenght"),
        F.when(k % 13 == 0, F.concat(_s("p_size"), F.lit(".0")))
        .otherwise(_s(F.col("p_size") * 10))
        .alias("product_description_lenght"),
        _s(F.col("p_size") % 5).alias("product_photos_qty"),
        F.when(k % 17 == 0, F.lit("heavy"))
        .otherwise(_money(F.col("p_retailprice") - 950))
        .alias("product_weight_g"),
        _s("p_size").alias("product_length_cm"),
        _s(F.col("p_size") % 7 + 1).alias("product_height_cm"),
        _s(F.col("p_size") % 11 + 2).alias("product_width_cm"),
    )


def category_feed(part: DataFrame) -> DataFrame:
    """Distinct category names except PROMO (left unmatched on purpose)."""
    names = part.select("p_type").filter(F.col("p_type") != "PROMO").distinct()
    return names.select(
        F.concat(F.col("p_type"), F.lit(" ")).alias("product_category_name"),
        F.concat(F.lit("EN_"), F.col("p_type")).alias("product_category_name_english"),
    )


def events_log(events: DataFrame) -> DataFrame:
    """Generic SCD2 change log: key user_id, sequence ts, tie event_id."""
    return events.select("event_id", "user_id", "ts", "event_type", "value")


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {name: read_table(spark, sf_dir, name) for name in TABLES}
    return {
        "orders": orders_feed(t["orders"]),
        "order_items": order_items_feed(t["lineitem"]),
        "customers": customers_feed(t["customer"], t["nation"], t["region"]),
        "products": products_feed(t["part"]),
        "product_category": category_feed(t["part"]),
    }
