"""Entity definitions: one record per feed, shared by every layer.

An entity carries its raw (all-string) schema, its key, the clustering column of its
stored tables, its table properties and the data-quality rules of its clean layer.
The layer functions in ``strata.plans`` take these records instead of hard-coding
names, so a new feed of the same shape is a new record, not new code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, columns, rules and properties that must equal the
# original project's for results to match. Kept together, in source order.
# ---------------------------------------------------------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

RAW_COLUMNS = {
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ],
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "product_category": ["product_category_name", "product_category_name_english"],
}

KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "product_category": ["product_category_name"],
}

# (rule name, SQL predicate); a row is kept only when every predicate is TRUE.
SILVER_RULES = {
    "orders": [
        ("valid_order_id", "order_id IS NOT NULL"),
        ("valid_customer_id", "customer_id IS NOT NULL"),
        ("valid_order_status", "order_status IS NOT NULL"),
    ],
    "order_items": [
        ("valid_order_id", "order_id IS NOT NULL"),
        ("valid_product_id", "product_id IS NOT NULL"),
        ("valid_price", "price IS NOT NULL AND price >= 0"),
    ],
    "customers": [
        ("valid_customer_id", "customer_id IS NOT NULL"),
        ("valid_customer_unique_id", "customer_unique_id IS NOT NULL"),
    ],
    "products": [
        ("valid_product_id", "product_id IS NOT NULL"),
    ],
    "product_category": [
        ("valid_category_name", "product_category_name IS NOT NULL"),
    ],
}

# Documented-only rule, off by default.
OPTIONAL_RULES = {
    "products": [("valid_weight", "product_weight_g > 0")],
}

# Domain (entity) that each gold table belongs to.
GOLD_DOMAINS = {
    "dim_customers": "customers",
    "dim_products": "products",
    "fct_order_items": "order_items",
}

# SCD type 2 parameters of the customer history.
CUSTOMER_SCD2 = {
    "keys": ["customer_id"],
    "sequence_by": "_ingest_timestamp",
    "except_columns": ["_ingest_timestamp", "_source_file", "_processing_timestamp"],
    "track_history_except": ["customer_unique_id"],
}

# Columns that hold personal data.
PII_COLUMNS = {"customers": ["customer_zip_code_prefix"]}

# Declared columns of the clean and star datasets, without the audit columns.
_ORDER_METRICS = "delivery_delay_days int, order_processing_days int, is_late_delivery boolean"
_CUSTOMER = ("customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
             "customer_city string, customer_state string, customer_location string")
SCHEMAS = {
    "silver_orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz, " + _ORDER_METRICS),
    "silver_order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price double, freight_value double, total_item_value double"),
    "silver_customers_preprocessed": _CUSTOMER,
    "silver_product_category": "product_category_name string, product_category_name_english string",
    "silver_products": (
        "product_category_name string, product_id string, product_name_length int, "
        "product_description_length int, product_photos_qty int, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double, "
        "product_volume_cm3 double, product_category_name_english string"),
    "silver_customers": _CUSTOMER + ", __START_AT timestamp_ntz, __END_AT timestamp_ntz",
    "dim_customers": _CUSTOMER,
    "dim_products": (
        "product_id string, product_category_name string, product_category_name_english string, "
        "product_weight_g double, product_length_cm double, product_height_cm double, "
        "product_width_cm double, product_volume_cm3 double"),
    "fct_order_items": (
        "order_id string, order_item_id int, product_id string, customer_id string, seller_id string, "
        "order_status string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz, "
        "shipping_limit_date timestamp_ntz, " + _ORDER_METRICS + ", price double, freight_value double, "
        "total_item_value double, customer_city string, customer_state string, customer_location string, "
        "product_category_name string, product_category_name_english string, product_volume_cm3 double"),
}

AUDIT_COLUMNS = [
    "_ingest_timestamp", "_source_file", "_processing_timestamp",
    "_dimension_refresh_timestamp", "_fact_processing_timestamp",
]
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A named row-level expectation; rows failing it are dropped."""

    name: str
    predicate: str


@dataclass(frozen=True)
class Entity:
    """``source_dir`` is the folder of the feed's files below the landing root (folders are
    named like files); callers with other names pass theirs to the runner."""

    name: str
    raw_columns: tuple[str, ...]
    keys: tuple[str, ...]
    source_dir: str
    rules: tuple[Rule, ...]
    pii_columns: tuple[str, ...] = field(default_factory=tuple)

    @property
    def cluster_by(self) -> str:
        return self.keys[0]

    def raw_schema(self) -> T.StructType:
        """All-string schema of the feed (no inference, no evolution)."""
        fields = []
        for name in self.raw_columns:
            meta = {"pii": True} if name in self.pii_columns else {}
            fields.append(T.StructField(name, T.StringType(), True, meta))
        return T.StructType(fields)

    def table_properties(self, layer: str) -> dict[str, str]:
        return table_properties(layer, self.name, self.cluster_by)


def table_properties(layer: str, domain: str, cluster_by: str) -> dict[str, str]:
    return {
        "quality": layer,
        "layer": layer,
        "domain": domain,
        "clustering.columns": cluster_by,
        "change.feed": "false" if layer == "gold" else "true",
    }


def declared_schema(dataset: str) -> T.StructType:
    """Declared columns of a clean or star dataset, without its audit columns, timestamps without zone (as the
    queries give them)."""
    return T._parse_datatype_string(SCHEMAS[dataset])


def entity(name: str) -> Entity:
    return Entity(
        name=name,
        raw_columns=tuple(RAW_COLUMNS[name]),
        keys=tuple(KEYS[name]),
        source_dir=f"{name}.csv",
        rules=tuple(Rule(n, p) for n, p in SILVER_RULES[name]),
        pii_columns=tuple(PII_COLUMNS.get(name, ())),
    )


def tag_pii(df):
    """Mark the personal columns of ``df`` in its schema (``pii`` in the field's metadata)."""
    for name in {c for columns in PII_COLUMNS.values() for c in columns} & set(df.columns):
        df = df.withMetadata(name, {"pii": True})
    return df


ENTITIES = {name: entity(name) for name in RAW_COLUMNS}


def rules_for(name: str, optional: bool = False) -> list[Rule]:
    rules = list(ENTITIES[name].rules)
    if optional:
        rules += [Rule(n, p) for n, p in OPTIONAL_RULES.get(name, [])]
    return rules
