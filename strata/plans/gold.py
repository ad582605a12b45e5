"""Customer history and the star schema: two dimensions around an order-item fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import CUSTOMER_SCD2, tag_pii
from strata.operators import scd2

CUSTOMER_DIM_COLUMNS = [
    "customer_id", "customer_unique_id", "customer_zip_code_prefix",
    "customer_city", "customer_state", "customer_location",
]
PRODUCT_DIM_COLUMNS = [
    "product_id", "product_category_name", "product_category_name_english",
    "product_weight_g", "product_length_cm", "product_height_cm",
    "product_width_cm", "product_volume_cm3",
]
ORDER_FACT_COLUMNS = [
    "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "delivery_delay_days", "order_processing_days", "is_late_delivery",
]
ITEM_FACT_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
    "price", "freight_value", "total_item_value",
]
FACT_COLUMNS = [
    "order_id", "order_item_id", "product_id", "customer_id", "seller_id",
    "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "shipping_limit_date", "delivery_delay_days", "order_processing_days",
    "is_late_delivery", "price", "freight_value", "total_item_value",
    "customer_city", "customer_state", "customer_location",
    "product_category_name", "product_category_name_english", "product_volume_cm3",
]

#: Columns by which one input of the fact refers to another.
FACT_LINKS = {("items", "orders"): "order_id", ("items", "products"): "product_id", ("orders", "customers"): "customer_id"}


def customer_history(preprocessed: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """SCD2 history of customers keyed by ``customer_id``, sequenced by ingest time;
    a change of ``customer_unique_id`` alone opens no version."""
    return tag_pii(scd2.scd2_history(
        preprocessed,
        keys=CUSTOMER_SCD2["keys"],
        sequence_by=CUSTOMER_SCD2["sequence_by"],
        except_columns=CUSTOMER_SCD2["except_columns"],
        track_history_except=CUSTOMER_SCD2["track_history_except"],
        num_partitions=num_partitions,
    ))


def dim_customers(history: DataFrame) -> DataFrame:
    """Current version of every customer."""
    return tag_pii(scd2.current_rows(history).select(
        *CUSTOMER_DIM_COLUMNS,
        F.current_timestamp().alias("_dimension_refresh_timestamp"),
    ))


def dim_products(silver_products: DataFrame) -> DataFrame:
    return silver_products.select(
        *PRODUCT_DIM_COLUMNS,
        F.current_timestamp().alias("_dimension_refresh_timestamp"),
    )


def fct_order_items(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Order-item grain fact: items ⋈ orders ⋈ customers ⋈ products (inner, bag).

    Each input is cut to the columns the fact needs before joining, which also
    settles every name clash (the inputs share audit columns). Orders meet customers
    first: that join shuffles the order table, not the much wider item-grain rows, and
    inner joins give the same bag of rows in any order.
    """
    o = orders.select("order_id", *ORDER_FACT_COLUMNS)
    c = customers.select("customer_id", "customer_city", "customer_state", "customer_location")
    p = products.select(
        "product_id", "product_category_name", "product_category_name_english",
        "product_volume_cm3",
    )
    i = items.select(*ITEM_FACT_COLUMNS)
    orders_enriched = o.join(c, on="customer_id", how="inner")
    fact = i.join(orders_enriched, on="order_id", how="inner").join(p, on="product_id", how="inner")
    return fact.select(
        *FACT_COLUMNS,
        F.current_timestamp().alias("_fact_processing_timestamp"),
    )


def fct_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Documented variant: one row per order with the customer's attributes."""
    c = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state",
        "customer_location",
    )
    o = orders.select("order_id", *ORDER_FACT_COLUMNS)
    return o.join(c, on="customer_id", how="inner").select(
        "order_id", *ORDER_FACT_COLUMNS, "customer_unique_id", "customer_city",
        "customer_state", "customer_location",
        F.current_timestamp().alias("_fact_processing_timestamp"),
    )


def bounded_join(
    items: DataFrame, orders: DataFrame, max_gap: str, lateness: str | None = None, also: tuple[str, ...] = (),
    how: str = "inner",
) -> DataFrame:
    """Items joined with the orders whose ``order_purchase_timestamp`` lies within ``max_gap`` of the item's
    ``shipping_limit_date``; ``also`` names further item columns to keep. ``how`` "left" keeps items that meet no
    order too, and tells them by ``_met``.

    On streams give a ``lateness``: both sides then carry a watermark, Spark drops join state that the bound
    rules out, and rows behind the watermark are not joined (see ``strata.streaming.bounded``, which keeps
    them). Rows without an event time join nothing."""
    i = items.select(*ITEM_FACT_COLUMNS, *also)
    o = orders.select(F.col("order_id").alias("__order_id"), *ORDER_FACT_COLUMNS)
    if lateness is not None:
        i = i.withWatermark("shipping_limit_date", lateness)
        o = o.withWatermark("order_purchase_timestamp", lateness)
    gap = F.expr(f"INTERVAL {max_gap}")
    return i.join(
        o,
        (i["order_id"] == o["__order_id"])
        & (i["shipping_limit_date"] >= o["order_purchase_timestamp"] - gap)
        & (i["shipping_limit_date"] <= o["order_purchase_timestamp"] + gap),
        how,
    ).withColumns({"_met": F.col("__order_id").isNotNull()} if how == "left" else {}).drop("__order_id")


def with_dimensions(matched: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fact rows from items that have met their orders."""
    c = customers.select("customer_id", "customer_city", "customer_state", "customer_location")
    p = products.select(
        "product_id", "product_category_name", "product_category_name_english",
        "product_volume_cm3",
    )
    fact = matched.join(c, on="customer_id", how="inner").join(p, on="product_id", how="inner")
    return fact.select(
        *FACT_COLUMNS,
        F.current_timestamp().alias("_fact_processing_timestamp"),
    )


def fct_order_items_bounded(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    max_gap: str,
    lateness: str = "1 day",
) -> DataFrame:
    """Streaming fact with bounded join state (opt-in variant of ``fct_order_items``): ``bounded_join`` of two
    streams under watermarks; ``customers`` and ``products`` are static dimension snapshots (stream-static
    joins, no state)."""
    return with_dimensions(bounded_join(items, orders, max_gap, lateness), customers, products)


def unmatched_items(items: DataFrame, orders: DataFrame, max_gap: str) -> DataFrame:
    """One row: ``n_items``, ``n_without_order`` and ``n_beyond_gap`` (an order exists, but none
    within ``max_gap`` of the item). Items are counted per order and date first, so a hot order
    is few rows in the join."""
    gap = F.expr(f"INTERVAL {max_gap}")
    i = items.groupBy("order_id", "shipping_limit_date").agg(F.count(F.lit(1)).alias("n"))
    o = orders.groupBy("order_id").agg(
        F.collect_set("order_purchase_timestamp").alias("bought")).withColumn("known", F.lit(True))
    near = F.exists("bought", lambda t: F.col("shipping_limit_date").between(t - gap, t + gap))
    joined = i.join(o, "order_id", "left")
    known = F.coalesce(F.col("known"), F.lit(False))
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_items"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_without_order"),
        F.coalesce(F.sum(F.when(known & ~F.coalesce(near, F.lit(False)), F.col("n"))), F.lit(0)).alias("n_beyond_gap"),
    )
