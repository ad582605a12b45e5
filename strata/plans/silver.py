"""Clean layer: typed columns, derived metrics and drop-on-failure rules.

Each function maps a raw DataFrame (batch or streaming) to its clean form. Rules are
applied to the function's output, as the original expectations are; Catalyst pushes
the filter below the projection where it can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import rules_for, tag_pii
from strata.functions import scalars as S
from strata.operators.quality import expect_or_drop

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]


def _audit(df: DataFrame) -> list:
    """Carry the raw layer's lineage columns (when present) and stamp processing time."""
    cols = [F.col(c) for c in ("_ingest_timestamp", "_source_file") if c in df.columns]
    return cols + [F.current_timestamp().alias("_processing_timestamp")]


def _rules(df: DataFrame, rules, apply_rules: bool) -> DataFrame:
    """Drop failing rows, or (``apply_rules=False``) return the rows unfiltered so the
    caller can count or observe rule outcomes first."""
    return expect_or_drop(df, rules) if apply_rules else df


def silver_orders(
    bronze: DataFrame,
    strict: bool = False,
    late_by: str = "timestamp",
    apply_rules: bool = True,
) -> DataFrame:
    """Typed orders with ``delivery_delay_days``, ``order_processing_days``,
    ``is_late_delivery``.

    ``late_by="timestamp"`` (default) compares delivery and estimate as timestamps and
    is NULL when either is missing; ``late_by="day"`` is the documented variant:
    positive day delay, never NULL.
    """
    typed = bronze.select(
        S.typed("order_id", "string", strict).alias("order_id"),
        S.typed("customer_id", "string", strict).alias("customer_id"),
        S.typed("order_status", "string", strict).alias("order_status"),
        *[S.parse_ts(c, strict=strict).alias(c) for c in ORDER_TIMESTAMPS],
        *_audit(bronze),
    )
    delivered, estimated = "order_delivered_customer_date", "order_estimated_delivery_date"
    out = typed.withColumns({
        "delivery_delay_days": S.day_span(delivered, estimated),
        "order_processing_days": S.day_span("order_approved_at", "order_purchase_timestamp"),
    })
    if late_by == "day":
        late = S.late_by_day("delivery_delay_days")
    elif late_by == "timestamp":
        late = S.later_than(delivered, estimated)
    else:
        raise ValueError(f"late_by must be 'timestamp' or 'day', got {late_by!r}")
    out = out.withColumn("is_late_delivery", late)
    return _rules(out, rules_for("orders"), apply_rules)


def silver_order_items(
    bronze: DataFrame, strict: bool = False, apply_rules: bool = True
) -> DataFrame:
    """Typed order items with ``total_item_value = round(price + freight, 2)``."""
    typed = bronze.select(
        S.typed("order_id", "string", strict).alias("order_id"),
        S.typed("order_item_id", "integer", strict).alias("order_item_id"),
        S.typed("product_id", "string", strict).alias("product_id"),
        S.typed("seller_id", "string", strict).alias("seller_id"),
        S.parse_ts("shipping_limit_date", strict=strict).alias("shipping_limit_date"),
        S.typed("price", "double", strict).alias("price"),
        S.typed("freight_value", "double", strict).alias("freight_value"),
        *_audit(bronze),
    )
    out = typed.withColumn("total_item_value", S.money_sum("price", "freight_value"))
    return _rules(out, rules_for("order_items"), apply_rules)


def silver_customers_preprocessed(
    bronze: DataFrame,
    strict: bool = False,
    location: str = "skip_nulls",
    apply_rules: bool = True,
) -> DataFrame:
    """Cleaned customer change rows that feed the SCD2 history (a view, not stored).

    ``location="skip_nulls"`` joins city and state skipping NULL parts (default);
    ``"strict"`` is the documented form that is NULL when a part is NULL.
    """
    typed = bronze.select(
        S.typed("customer_id", "string", strict).alias("customer_id"),
        S.typed("customer_unique_id", "string", strict).alias("customer_unique_id"),
        S.typed("customer_zip_code_prefix", "string", strict).alias("customer_zip_code_prefix"),
        S.upper_trim("customer_city").alias("customer_city"),
        S.upper_trim("customer_state").alias("customer_state"),
        *_audit(bronze),
    )
    joiner = S.joined_location if location == "skip_nulls" else S.joined_location_strict
    out = tag_pii(typed.withColumn("customer_location", joiner("customer_city", "customer_state")))
    return _rules(out, rules_for("customers"), apply_rules)


def silver_product_category(bronze: DataFrame, apply_rules: bool = True) -> DataFrame:
    """Category-name translation lookup, lower-cased and trimmed."""
    out = bronze.select(
        S.lower_trim("product_category_name").alias("product_category_name"),
        S.lower_trim("product_category_name_english").alias("product_category_name_english"),
        *_audit(bronze),
    )
    return _rules(out, rules_for("product_category"), apply_rules)


def typed_products(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Typed products with ``product_volume_cm3``; misspelt raw columns renamed."""
    typed = bronze.select(
        S.typed("product_id", "string", strict).alias("product_id"),
        S.lower_trim("product_category_name").alias("product_category_name"),
        S.typed("product_name_lenght", "integer", strict).alias("product_name_length"),
        S.typed("product_description_lenght", "integer", strict).alias("product_description_length"),
        S.typed("product_photos_qty", "integer", strict).alias("product_photos_qty"),
        S.typed("product_weight_g", "double", strict).alias("product_weight_g"),
        S.typed("product_length_cm", "double", strict).alias("product_length_cm"),
        S.typed("product_height_cm", "double", strict).alias("product_height_cm"),
        S.typed("product_width_cm", "double", strict).alias("product_width_cm"),
        *_audit(bronze),
    )
    return typed.withColumn(
        "product_volume_cm3",
        S.product("product_length_cm", "product_height_cm", "product_width_cm"),
    )


def silver_products(
    bronze: DataFrame,
    category: DataFrame,
    strict: bool = False,
    weight_rule: bool = False,
    apply_rules: bool = True,
) -> DataFrame:
    """Products left-joined to the English category name.

    ``category`` is the clean lookup (batch snapshot; on a stream this is a
    stream-static join). The join key comes first in the output; unknown or NULL
    categories give a NULL English name. Duplicate lookup names multiply products,
    as a plain left join does (``key_violations`` reports them).
    """
    products = typed_products(bronze, strict)
    lookup = category.select("product_category_name", "product_category_name_english")
    out = products.join(lookup, on="product_category_name", how="left")
    return _rules(out, rules_for("products", optional=weight_rule), apply_rules)
