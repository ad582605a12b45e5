import contextlib
import io

from pyspark.sql import functions as F

from strata.operators.changes import CHANGE_TYPE, COPIES, snapshot_changes
from strata.operators.joins import broadcast_fits, salted_join, sized_broadcast
from strata.plans import gold


def test_snapshot_changes_bag_semantics(spark):
    schema = "k string, v string"
    before = spark.createDataFrame(
        [("same", "a"), ("upd", "old"), ("gone", "x"), ("dup", "d"), ("dup", "d"), ("dup", "d"), (None, "n")],
        schema)
    after = spark.createDataFrame(
        [("same", "a"), ("upd", "new"), ("born", "y"), ("dup", "d"), (None, "m")], schema)
    out = sorted(((r[CHANGE_TYPE], r.k, r.v, r[COPIES]) for r in
                  snapshot_changes(before, after, ["k"]).collect()), key=str)
    assert out == sorted([
        ("update_preimage", "upd", "old", 1), ("update_postimage", "upd", "new", 1),
        ("delete", "gone", "x", 1), ("insert", "born", "y", 1), ("delete", "dup", "d", 2),
        ("update_preimage", None, "n", 1), ("update_postimage", None, "m", 1),
    ], key=str)


def test_sized_broadcast_checks_rows(spark):
    small = spark.range(10)
    big = spark.range(10_000)
    assert broadcast_fits(small, max_rows=100)
    assert not broadcast_fits(big, max_rows=100)
    hinted = spark.range(1000).join(sized_broadcast(small, max_rows=100), "id")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        hinted.explain()
    assert "BroadcastHashJoin" in buf.getvalue()


def test_salted_join_equals_plain_join(spark):
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 5 == 0, None)
        .otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("v"))
    other = spark.createDataFrame([(7, "hot"), (7, "hot2"), (1, "one"), (2, "two"), (None, "null")], "k long, w string")
    for how in ("inner", "left"):
        plain = sorted((tuple(r) for r in big.join(other, "k", how).collect()), key=str)
        salted = sorted((tuple(r) for r in salted_join(
            big, other, ["k"], how=how, min_rows=100).collect()), key=str)
        assert plain == salted


def _star_inputs(spark):
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s", None, 1.0, 1.0, 2.0),
         ("o1", 1, "p1", "s", None, 1.0, 1.0, 2.0),   # duplicate item key: kept twice
         ("o2", 1, "p1", "s", None, 1.0, 1.0, 2.0),   # order o2 missing
         ("o3", 1, "p9", "s", None, 1.0, 1.0, 2.0),   # product missing
         ("o4", 1, "p2", "s", None, 1.0, 1.0, 2.0)],  # customer missing
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp, price double, freight_value double, total_item_value double")
    orders = spark.createDataFrame(
        [("o1", "c1", "d"), ("o3", "c1", "d"), ("o4", "c9", "d")],
        "order_id string, customer_id string, order_status string")
    for c in gold.ORDER_FACT_COLUMNS:
        if c not in orders.columns:
            orders = orders.withColumn(c, F.lit(None).cast("string"))
    customers = spark.createDataFrame(
        [("c1", "CITY", "ST", "CITY, ST"), ("c1", "CITY2", "ST", "CITY2, ST")],  # duplicate dim key
        "customer_id string, customer_city string, customer_state string, customer_location string")
    products = spark.createDataFrame(
        [("p1", "toys", "toys_en", 8.0), ("p2", "books", None, 1.0)],
        "product_id string, product_category_name string, product_category_name_english string, "
        "product_volume_cm3 double")
    return items, orders, customers, products


def test_star_join_bag_semantics(spark):
    fact = gold.fct_order_items(*_star_inputs(spark))
    rows = fact.collect()
    assert fact.columns[:len(gold.FACT_COLUMNS)] == gold.FACT_COLUMNS
    # two o1 items x two c1 dimension rows; o2/o3/o4 drop out (missing order/product/customer)
    assert len(rows) == 4
    assert {r.order_id for r in rows} == {"o1"}


def test_sized_broadcast_measures_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 100_000).alias("text"), "id")
    assert not broadcast_fits(wide, max_bytes=5_000_000)
    assert broadcast_fits(wide, max_bytes=20_000_000)
    nested = wide.select(F.array("text").alias("a"))
    assert not broadcast_fits(nested, max_bytes=5_000_000)
    assert broadcast_fits(wide.filter("id < 0"), max_bytes=1)
