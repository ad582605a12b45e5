"""Registered queries: each builds one dataset from the test tables in ``sf_dir``.

Every query reads the whole input tables (through the feed adapter) and returns a
DataFrame. At the edge, lineage/processing-time columns are dropped (they hold the
wall clock) and timestamps become ``timestamp_ntz`` so they compare as plain values.
Queries named ``*_stream`` / ``bronze_*`` / ``*_incremental`` run the streaming form
(``availableNow``) into scratch tables under ``spark.checkpoint.dir`` and return what
was stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import (
    AUDIT_COLUMNS, CUSTOMER_SCD2, ENTITIES, GOLD_DOMAINS, declared_schema, rules_for, table_properties,
)
from strata.operators import changes, quality, scd2
from strata.operators.joins import join_by_salts, salt_table, salted_join, sized_broadcast
from strata.plans import feeds, gold, silver
from strata.plans.bronze import ingest
from strata.session import LEAN_CONF, scratch_dir, settings
from strata.sources.csv_feed import write_csv_feed
from strata.sources.buckets import BucketTable
from strata.sources.tables import (
    TableStore, append_stream, merge_batches, read_snapshot, read_stream, run_once, stream_in_batches,
)
from strata.streaming.bounded import BoundedFact
from strata.streaming.key_checks import ForeignKey, KeySummary
from strata.streaming.runner import RunReport, products_stream, run_layers, silver_stream
from strata.streaming.scd2_incremental import IncrementalHistory
from strata.streaming.star import Stored
from strata.streaming.stored_join import StoredJoin

#: Time bound of the bounded streaming fact, and the lateness its watermarks allow.
MAX_GAP, LATENESS = "60 days", "30 days"


def edge(df: DataFrame) -> DataFrame:
    """Drop wall-clock audit columns; timestamps as ``timestamp_ntz``."""
    cols = []
    for f in df.schema.fields:
        if f.name in AUDIT_COLUMNS:
            continue
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return feeds.read_table(spark, sf_dir, name)


# -- clean layer -------------------------------------------------------------------

def _orders(spark, sf_dir, **kw) -> DataFrame:
    return silver.silver_orders(feeds.orders_feed(_t(spark, sf_dir, "orders")), **kw)


def _items(spark, sf_dir, **kw) -> DataFrame:
    return silver.silver_order_items(feeds.order_items_feed(_t(spark, sf_dir, "lineitem")), **kw)


def _customer_feed(spark, sf_dir) -> DataFrame:
    return feeds.customers_feed(*(_t(spark, sf_dir, n) for n in ("customer", "nation", "region")))


def _customer_log(spark, sf_dir) -> DataFrame:
    raw = feeds.customer_change_log(*(_t(spark, sf_dir, n) for n in ("customer", "nation", "region")))
    return silver.silver_customers_preprocessed(raw)


def _category(spark, sf_dir, **kw) -> DataFrame:
    return silver.silver_product_category(feeds.category_feed(_t(spark, sf_dir, "part")), **kw)


def _products(spark, sf_dir, **kw) -> DataFrame:
    return silver.silver_products(
        feeds.products_feed(_t(spark, sf_dir, "part")), sized_broadcast(_category(spark, sf_dir)), **kw)


def q_silver_orders(spark, sf_dir):
    return edge(_orders(spark, sf_dir))


def q_late_by_day(spark, sf_dir):
    out = _orders(spark, sf_dir, late_by="day")
    return edge(out.select("order_id", "delivery_delay_days", "is_late_delivery"))


def q_silver_order_items(spark, sf_dir):
    return edge(_items(spark, sf_dir))


def q_silver_customers_preprocessed(spark, sf_dir):
    return edge(silver.silver_customers_preprocessed(_customer_feed(spark, sf_dir)))


def q_silver_product_category(spark, sf_dir):
    return edge(_category(spark, sf_dir))


def q_silver_products(spark, sf_dir):
    return edge(_products(spark, sf_dir))


def q_silver_products_valid_weight(spark, sf_dir):
    return edge(_products(spark, sf_dir, weight_rule=True))


# -- history and star schema ------------------------------------------------------------

def _history(spark, sf_dir) -> DataFrame:
    return gold.customer_history(_customer_log(spark, sf_dir))


def q_customers_scd2(spark, sf_dir):
    return edge(_history(spark, sf_dir))


def q_events_scd2(spark, sf_dir):
    log = feeds.events_log(_t(spark, sf_dir, "events"))
    return edge(scd2.scd2_history(
        log, keys=["user_id"], sequence_by="ts", except_columns=["event_id", "ts"],
        track_history_except=["value"], tie_breaker=["event_id"],
    ))


def q_dim_customers(spark, sf_dir):
    return edge(gold.dim_customers(_history(spark, sf_dir)))


def q_dim_products(spark, sf_dir):
    return edge(gold.dim_products(_products(spark, sf_dir)))


def _fact(spark, sf_dir) -> DataFrame:
    return gold.fct_order_items(
        _items(spark, sf_dir),
        _orders(spark, sf_dir),
        gold.dim_customers(_history(spark, sf_dir)),
        sized_broadcast(gold.dim_products(_products(spark, sf_dir))),
    )


def q_fct_order_items(spark, sf_dir):
    return edge(_fact(spark, sf_dir))


def q_fct_orders(spark, sf_dir):
    return edge(gold.fct_orders(_orders(spark, sf_dir), gold.dim_customers(_history(spark, sf_dir))))


# -- quality checks -------------------------------------------------------------------

def q_dq_metrics(spark, sf_dir):
    parts = [
        quality.rule_counts(_orders(spark, sf_dir, apply_rules=False),
                            rules_for("orders"), "silver_orders"),
        quality.rule_counts(_items(spark, sf_dir, apply_rules=False),
                            rules_for("order_items"), "silver_order_items"),
        quality.rule_counts(
            silver.silver_customers_preprocessed(_customer_feed(spark, sf_dir), apply_rules=False),
            rules_for("customers"), "silver_customers_preprocessed"),
        quality.rule_counts(_category(spark, sf_dir, apply_rules=False),
                            rules_for("product_category"), "silver_product_category"),
        quality.rule_counts(_products(spark, sf_dir, apply_rules=False),
                            rules_for("products", optional=True), "silver_products"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _key_text(keys: list[str]):
    """Key values joined by ``|``; NULL is ``\\N``, and ``\\`` and ``|`` in a value are escaped."""
    parts = [
        F.coalesce(F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")),
                             F.lit("|"), F.lit("\\|")), F.lit("\\N"))
        for k in keys]
    return F.concat_ws("|", *parts).alias("key_value")


def q_pk_check(spark, sf_dir):
    n = {name: _t(spark, sf_dir, name).count() for name in ("orders", "lineitem", "part", "customer")}
    checks = [
        ("silver_orders", _orders(spark, sf_dir), ["order_id"], n["orders"]),
        ("silver_order_items", _items(spark, sf_dir), ["order_id", "order_item_id"], n["lineitem"]),
        ("silver_product_category", _category(spark, sf_dir), ["product_category_name"], 0),
        ("dim_customers", gold.dim_customers(_history(spark, sf_dir)), ["customer_id"], n["customer"]),
        ("dim_products", gold.dim_products(_products(spark, sf_dir)), ["product_id"], n["part"]),
    ]
    out = None
    for name, df, keys, rows in checks:
        v = quality.key_violations(df, keys, rows).select(
            F.lit(name).alias("dataset"), _key_text(keys), "n_rows")
        out = v if out is None else out.unionByName(v)
    return out


def q_fk_check(spark, sf_dir):
    items, orders, products = _items(spark, sf_dir), _orders(spark, sf_dir), _products(spark, sf_dir)
    checks = [
        ("order_items.order_id", items, orders, ["order_id"]),
        ("order_items.product_id", items, products, ["product_id"]),
        ("products.product_category_name", products, _category(spark, sf_dir),
         ["product_category_name"]),
        ("orders.customer_id", orders, gold.dim_customers(_history(spark, sf_dir)),
         ["customer_id"]),
    ]
    out = None
    for name, child, parent, keys in checks:
        o = quality.orphans(child, parent, keys).select(
            F.lit(name).alias("relation"), _key_text(keys), "n_rows")
        out = o if out is None else out.unionByName(o)
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder, for several readers."""
    path = f"{scratch_dir(df.sparkSession, name)}/data"
    df.write.parquet(path)
    return read_snapshot(df.sparkSession, path)


def q_snapshot_changes(spark, sf_dir):
    history = _stored(_history(spark, sf_dir), "history")
    first = F.to_timestamp(F.lit(feeds.CUSTOMER_BATCHES[0]))
    before = scd2.as_of(history, first).select(*gold.CUSTOMER_DIM_COLUMNS)
    after = scd2.current_rows(history).select(*gold.CUSTOMER_DIM_COLUMNS)
    return edge(changes.snapshot_changes(before, after, ["customer_id"]))


def q_change_feed(spark, sf_dir):
    """The same changes as a feed that the customer dimension keeps: it is stored as of the first delivery, then
    the buckets of the customers that changed later are rewritten, and only these are compared."""
    root = scratch_dir(spark, "change-feed")
    history = _stored(_history(spark, sf_dir), "history")
    first = F.to_timestamp(F.lit(feeds.CUSTOMER_BATCHES[0]))
    before = scd2.as_of(history, first).select(*gold.CUSTOMER_DIM_COLUMNS)
    after = scd2.current_rows(history).select(*gold.CUSTOMER_DIM_COLUMNS)
    BucketTable(spark, f"{root}/dim", ["customer_id"]).replace(before, [], "first")
    dim = BucketTable(spark, f"{root}/dim", ["customer_id"], feed=f"{root}/feed")
    later = history.filter(F.col(scd2.START) > first)
    hit = dim.hit(later)
    dim.replace(after.filter(dim.bucket().isin(hit)), hit, "later")
    return edge(dim.changes().drop("change"))


def _two_deliveries(df: DataFrame, keys: list[str]) -> list[DataFrame]:
    first = F.pmod(F.xxhash64(*df.columns), F.lit(3)) > 0
    stored = _stored(df.select(*keys, first.alias("__first")), "deliveries")
    return [stored.filter(part).select(*keys) for part in (F.col("__first"), ~F.col("__first"))]


def q_pk_check_incremental(spark, sf_dir):
    """The primary-key check kept by key summaries, over two deliveries of every dataset."""
    root = scratch_dir(spark, "pk-summaries")
    checks = [
        ("silver_orders", _orders(spark, sf_dir), ["order_id"]),
        ("silver_order_items", _items(spark, sf_dir), ["order_id", "order_item_id"]),
        ("silver_product_category", _category(spark, sf_dir), ["product_category_name"]),
        ("dim_customers", gold.dim_customers(_history(spark, sf_dir)), ["customer_id"]),
        ("dim_products", gold.dim_products(_products(spark, sf_dir)), ["product_id"]),
    ]
    out = None
    for name, df, keys in checks:
        summary = KeySummary(spark, f"{root}/{name}", keys)
        for n, rows in enumerate(_two_deliveries(df, keys)):
            summary.add(rows, f"d{n}")
        v = summary.violations().select(F.lit(name).alias("dataset"), _key_text(keys), "n_rows")
        out = v if out is None else out.unionByName(v)
    return out


def q_fk_check_incremental(spark, sf_dir):
    """Two of the foreign-key checks kept by key summaries, children and parents in two deliveries each."""
    root = scratch_dir(spark, "fk-summaries")
    products = _stored(_products(spark, sf_dir), "products")
    checks = [
        ("order_items.product_id", _items(spark, sf_dir), products, "product_id"),
        ("products.product_category_name", products, _category(spark, sf_dir), "product_category_name"),
    ]
    out = None
    for name, child, parent, key in checks:
        sides = [KeySummary(spark, f"{root}/{name}/{side}", [key]) for side in ("child", "parent")]
        relation = ForeignKey(spark, f"{root}/{name}/orphans", *sides)
        for n, rows in enumerate(zip(_two_deliveries(child, [key]), _two_deliveries(parent, [key]))):
            hit = {b for summary, new in zip(sides, rows) for b in summary.add(new, f"d{n}")}
            relation.refresh(sorted(hit), f"d{n}")
        o = relation.orphans().select(F.lit(name).alias("relation"), _key_text([key]), "n_rows")
        out = o if out is None else out.unionByName(o)
    return out


# -- streaming forms --------------------------------------------------------------------

def _stage_feed(spark: SparkSession, sf_dir: str, entity: str, root: str) -> tuple[DataFrame, object]:
    """The entity's feed, written once, and a condition that splits it into two deliveries."""
    ent = ENTITIES[entity]
    feed = _stored(feeds.raw_feeds(spark, sf_dir)[entity], f"feed-{entity}")
    return feed, F.pmod(F.xxhash64(*[F.col(c) for c in ent.raw_columns]), F.lit(2)) == 0


def _ingested(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Stage the feed as CSV in two deliveries, ingest after each and once more."""
    ent = ENTITIES[entity]
    root = scratch_dir(spark, f"bronze-{entity}")
    source = f"{root}/landing"
    store = TableStore(f"{root}/tables")
    feed, first = _stage_feed(spark, sf_dir, entity, root)
    write_csv_feed(feed.filter(first), f"{source}/{ent.source_dir}")
    ingest(spark, ent, source, store)
    write_csv_feed(feed.filter(~first), f"{source}/{ent.source_dir}")
    ingest(spark, ent, source, store)
    ingest(spark, ent, source, store)  # nothing new: adds no rows
    return read_snapshot(spark, store.path("bronze", f"bronze_{entity}"))


def _bronze_query(entity: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _ingested(spark, sf_dir, entity).select(*ENTITIES[entity].raw_columns)

    run.__name__ = f"q_bronze_{entity}"
    return run


def q_bronze_lineage(spark, sf_dir):
    """Lineage of the raw rows: folder of the source file, rows with an ingest time, lines that
    did not fit the schema."""
    raw = _ingested(spark, sf_dir, "customers")
    folder = F.element_at(F.split("_source_file", "/"), -2)
    return raw.groupBy(folder.alias("source_folder")).agg(
        F.count("_ingest_timestamp").alias("n_rows"), F.count("_corrupt_record").alias("n_corrupt"))


def _stream_files(df: DataFrame, path: str, batches: int) -> DataFrame:
    """Store ``df`` once, in enough files for ``batches`` micro-batches, and read it as a stream."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(max(batches, tasks)).write.parquet(path)
    return stream_in_batches(df.sparkSession, path, batches)


def q_silver_products_stream(spark, sf_dir):
    root = scratch_dir(spark, "products-stream")
    out = f"{root}/silver_products"
    category = sized_broadcast(_category(spark, sf_dir))
    stream = _stream_files(feeds.products_feed(_t(spark, sf_dir, "part")), f"{root}/raw_products", 4)
    run_once(append_stream(silver.silver_products(stream, category), out, f"{root}/_chk"))
    return edge(read_snapshot(spark, out))


def q_dq_metrics_stream(spark, sf_dir):
    """Rule counts of a clean stream, as stored with each of its micro-batches and summed at the end."""
    root = scratch_dir(spark, "dq-stream")
    store, report = TableStore(root, database="strata_dq"), RunReport()
    stream = _stream_files(feeds.products_feed(_t(spark, sf_dir, "part")), f"{root}/raw", 8)
    category = sized_broadcast(_category(spark, sf_dir))
    silver_stream(spark, store, "silver_products",
                  silver.silver_products(stream, category, apply_rules=False), "products", report,
                  optional_rules=True)
    rows = report.rows_read["silver_products"]
    return spark.createDataFrame(
        [("silver_products", rule, rows - failed, failed)
         for rule, failed in report.rule_failures["silver_products"].items()],
        "dataset string, rule string, passed long, failed long")


def q_silver_products_late_names(spark, sf_dir):
    """Products delivered before their categories: the first run stores them without an English name, the
    second brings the categories and fills the names in."""
    root = scratch_dir(spark, "late-names")
    store = TableStore(root, database="strata_names")
    raw, lookup = f"{root}/raw_products", store.path("silver", "silver_product_category")
    feed = _stored(feeds.products_feed(_t(spark, sf_dir, "part")), "products-feed")
    category = _stored(_category(spark, sf_dir), "category")
    first = F.pmod(F.xxhash64("product_id"), F.lit(4)) > 0
    known = F.pmod(F.xxhash64("product_category_name"), F.lit(3)) == 0
    for run, (products, names) in enumerate(((first, known), (~first, ~known))):
        feed.filter(products).write.parquet(f"{raw}/b{run:012d}")
        category.filter(names).write.parquet(f"{lookup}/b{run:012d}")
        table = products_stream(spark, store, read_stream(spark, raw), Stored(spark, lookup, category.schema), RunReport())
    return edge(table.read())


def _fact_inputs(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "items": _items(spark, sf_dir),
        "orders": _orders(spark, sf_dir),
        "customers": gold.dim_customers(_history(spark, sf_dir)),
        "products": gold.dim_products(_products(spark, sf_dir)),
    }


def q_fct_order_items_stream(spark, sf_dir):
    """Fact from four streams (stream-stream inner joins), each fed in several batches."""
    root = scratch_dir(spark, "fact-stream")
    with settings(spark, LEAN_CONF):
        streams = {name: _stream_files(df, f"{root}/{name}", 3)
                   for name, df in _fact_inputs(spark, sf_dir).items()}

        def join(items, orders, customers, products):
            return gold.fct_order_items(items, orders, customers, sized_broadcast(products, stored=True))

        fact = StoredJoin(spark, f"{root}/fact", join, gold.FACT_LINKS)
        fact.run({name: streams[name] for name in ("products", "customers", "orders", "items")})
    return edge(fact.read())


def _by_time(df: DataFrame, time: str, deliveries: int, late_by: int) -> DataFrame:
    """``df`` with ``__run``, the delivery a row comes in: rows come in the order of ``time``, in equal spans of
    it, but one row in fifty comes ``late_by`` deliveries after its time."""
    span = df.agg(F.min(time).alias("low"), F.max(time).alias("high")).first()
    seconds = lambda c: F.unix_timestamp(c)
    place = (seconds(time) - seconds(F.lit(span["low"]))) / (seconds(F.lit(span["high"])) - seconds(F.lit(span["low"])) + 1)
    run = F.coalesce(F.floor(place * deliveries), F.lit(0)).cast("int")
    late = F.when(F.pmod(F.xxhash64("order_id", time), F.lit(50)) == 0, late_by).otherwise(0)
    return df.withColumn("__run", F.least(run + late, F.lit(deliveries - 1)))


def q_fct_order_items_bounded(spark, sf_dir):
    """Fact from two streams with bounded state, in four deliveries by event time: items and orders within
    MAX_GAP of each other, watermarks LATENESS behind. Rows that come later than that are kept on the side and
    joined from there, so that the fact is whole."""
    root = scratch_dir(spark, "fact-bounded")
    runs = 4
    paths = {name: f"{root}/{name}" for name in ("items", "orders")}
    with settings(spark, LEAN_CONF):
        inputs = {
            "items": _stored(_by_time(_items(spark, sf_dir), "shipping_limit_date", runs, 2), "items"),
            "orders": _stored(_by_time(_orders(spark, sf_dir), "order_purchase_timestamp", runs, 2), "orders")}
        fact = BoundedFact(spark, f"{root}/state", max_gap=MAX_GAP, lateness=LATENESS)
        for run in range(runs):
            for name, df in inputs.items():
                df.filter(F.col("__run") == run).drop("__run").write.parquet(f"{paths[name]}/b{run:012d}")
            fact.run(paths["items"], paths["orders"])
    customers = sized_broadcast(gold.dim_customers(_history(spark, sf_dir)))
    products = sized_broadcast(gold.dim_products(_products(spark, sf_dir)))
    return edge(gold.with_dimensions(fact.joined(), customers, products))


def q_items_by_hot_product_stream(spark, sf_dir):
    """Items joined with products, both as streams, a third of the items under one product: the hot product's
    join state is spread by salts that an earlier snapshot gives."""
    root = scratch_dir(spark, "hot-stream")
    hot = F.col("order_id").cast("long") % 3 == 0
    items = _stored(_items(spark, sf_dir).select(
        "order_id", "order_item_id", F.when(hot, "1").otherwise(F.col("product_id")).alias("product_id")), "items")
    earlier = items.filter(F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0)
    salts = sized_broadcast(salt_table(earlier, ["product_id"], min_rows=max(1, earlier.count() // 24)))
    products = _products(spark, sf_dir).select("product_id", "product_category_name")
    joined = join_by_salts(_stream_files(items, f"{root}/items", 3), _stream_files(products, f"{root}/products", 3),
                           ["product_id"], salts)
    run_once(append_stream(joined, f"{root}/out", f"{root}/_chk"))
    return read_snapshot(spark, f"{root}/out")


def q_fct_order_items_unmatched(spark, sf_dir):
    return gold.unmatched_items(_items(spark, sf_dir), _orders(spark, sf_dir), MAX_GAP)


def q_items_by_product_salted(spark, sf_dir):
    """Items with their product's category; a product with over a 64th of the items is spread over tasks."""
    items = _items(spark, sf_dir).select("order_id", "order_item_id", "product_id")
    products = _products(spark, sf_dir).select("product_id", "product_category_name")
    return salted_join(items, products, ["product_id"], how="left", min_rows=max(1, items.count() // 64))


def q_customers_scd2_incremental(spark, sf_dir):
    """History kept by the foreachBatch form: three deliveries, the last batch before the second
    (out of order), each drained by its own run. The first also brings rows without a sequence,
    which are counted and leave the history as it is."""
    root = scratch_dir(spark, "scd2-incremental")
    log = _stored(_customer_log(spark, sf_dir), "customer-log")
    landing = f"{root}/landing"
    inc = IncrementalHistory(
        spark, f"{root}/state", keys=CUSTOMER_SCD2["keys"],
        sequence_by=CUSTOMER_SCD2["sequence_by"],
        except_columns=CUSTOMER_SCD2["except_columns"],
        track_history_except=CUSTOMER_SCD2["track_history_except"],
    )
    for batch in ("batch-1", "batch-3", "batch-2"):
        rows = log.filter(F.col("_source_file") == batch)
        if batch == "batch-1":
            unplaced = rows.filter(F.pmod(F.xxhash64("customer_id"), F.lit(10)) == 0)
            rows = rows.unionByName(unplaced.withColumn(
                CUSTOMER_SCD2["sequence_by"], F.lit(None).cast("timestamp")))
        rows.write.mode("append").parquet(landing)
        changes_stream = spark.readStream.schema(log.schema).parquet(landing)
        inc.run(changes_stream, f"{root}/_chk")
    return edge(inc.history())


def q_runner_incremental(spark, sf_dir):
    """All layers over two deliveries of every feed (categories come whole with the first): the
    fact as stored after the second run."""
    root = scratch_dir(spark, "runner")
    landing = f"{root}/landing"
    with settings(spark, LEAN_CONF):
        deliveries = {name: _stage_feed(spark, sf_dir, name, root) for name in ENTITIES}
        for second in (False, True):
            for name, (feed, first) in deliveries.items():
                part = feed.filter(~first if second else first)
                if name == "product_category":
                    part = feed.filter(F.lit(not second))
                write_csv_feed(part, f"{landing}/{ENTITIES[name].source_dir}", packed=True)
            store, _ = run_layers(spark, landing, f"{root}/tables")
    return edge(BucketTable(spark, store.path("gold", "fct_order_items"), ["order_id"]).read())


# -- tables, schemas, metadata ---------------------------------------------------------------

def q_table_properties(spark, sf_dir):
    """Properties and comments as the catalog has them: tables over stored clean data, and a history that is
    declared before anything was written to it."""
    root = scratch_dir(spark, "catalog")
    store = TableStore(root, database="strata_props")
    datasets = {
        ("silver", "silver_orders"): (_orders(spark, sf_dir), ENTITIES["orders"].table_properties("silver")),
        ("silver", "silver_products"): (_products(spark, sf_dir), ENTITIES["products"].table_properties("silver")),
        ("silver", "silver_customers"): (None, ENTITIES["customers"].table_properties("silver")),
        ("gold", "dim_products"): (
            gold.dim_products(_products(spark, sf_dir)),
            table_properties("gold", GOLD_DOMAINS["dim_products"], "product_id")),
        ("gold", "fct_order_items"): (
            _fact(spark, sf_dir), table_properties("gold", GOLD_DOMAINS["fct_order_items"], "order_id")),
    }
    rows = []
    for (layer, name), (df, props) in datasets.items():
        if df is not None:
            edge(df).write.parquet(store.path(layer, name))
        store.declare(spark, layer, name, props, f"Table {name}", schema=declared_schema(name))
        info = store.describe(spark, layer, name)
        place = info["path"].removeprefix(root).strip("/")
        n = spark.table(store.table(layer, name)).count()
        rows += [(name, place, info["comment"], key, info["properties"][key], n) for key in props]
    return spark.createDataFrame(
        rows, "table_name string, place string, table_comment string, property string, "
              "property_value string, n_rows long")


def _file_ranges(spark, store: TableStore, layer: str, name: str, key: str) -> DataFrame:
    """Rows of a table of batch folders, and pairs of neighbouring files of a batch whose key ranges overlap
    by more than a shared bound."""
    files = read_snapshot(spark, store.path(layer, name)).select(F.col("_metadata.file_path").alias("f"), key).groupBy(
        "f").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n"))
    batch = F.element_at(F.split("f", "/"), -2)
    in_order = Window.partitionBy(batch).orderBy("low", "high")  # one row per file
    return files.withColumn("before", F.lag("high").over(in_order)).agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("before") > F.col("low")).alias("n_overlaps")).select(
        F.lit(name).alias("table_name"), "n_rows", "n_overlaps")


def q_clustered_ranges(spark, sf_dir):
    """Key ranges of the files that the append sinks write: raw orders from two deliveries, clean orders from
    four batches, and the clean orders again after their batches were merged."""
    root = scratch_dir(spark, "clustered")
    store, report = TableStore(f"{root}/tables", database="strata_clustered"), RunReport()
    ent = ENTITIES["orders"]
    feed, first = _stage_feed(spark, sf_dir, "orders", root)
    for part in (feed.filter(first), feed.filter(~first)):
        write_csv_feed(part, f"{root}/landing/{ent.source_dir}")
        ingest(spark, ent, f"{root}/landing", store)
    stream = _stream_files(feed, f"{root}/raw", 4)
    silver_stream(spark, store, "silver_orders", silver.silver_orders(stream, apply_rules=False), "orders", report)
    ranges = [("bronze", "bronze_orders"), ("silver", "silver_orders")]
    out = [_stored(_file_ranges(spark, store, *t, "order_id"), "ranges") for t in ranges]
    merge_batches(spark, store.path("silver", "silver_orders"), "order_id", more_than=1)
    out.append(_file_ranges(spark, store, "silver", "silver_orders", "order_id").withColumn(
        "table_name", F.lit("silver_orders_merged")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def q_schema_check(spark, sf_dir):
    """Every dataset against its declared schema: columns that are missing, extra or of another type."""
    datasets = {
        "silver_orders": _orders(spark, sf_dir),
        "silver_order_items": _items(spark, sf_dir),
        "silver_customers_preprocessed": silver.silver_customers_preprocessed(_customer_feed(spark, sf_dir)),
        "silver_product_category": _category(spark, sf_dir),
        "silver_products": _products(spark, sf_dir),
        "silver_customers": _history(spark, sf_dir),
        "dim_customers": gold.dim_customers(_history(spark, sf_dir)),
        "dim_products": gold.dim_products(_products(spark, sf_dir)),
        "fct_order_items": _fact(spark, sf_dir),
    }
    out = None
    for name, df in datasets.items():
        df = edge(df)
        wrong = quality.schema_mismatches(df.schema, declared_schema(name))
        rows = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
            F.lit(len(wrong)).alias("n_mismatches"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_dataset_schemas(spark, sf_dir):
    """Column types of the clean and star datasets, and the personal-data tag, read from the
    schemas; ``n_rows`` ties them to the data."""
    datasets = {
        "silver_orders": _orders(spark, sf_dir),
        "silver_customers_preprocessed": silver.silver_customers_preprocessed(_customer_feed(spark, sf_dir)),
        "dim_customers": gold.dim_customers(_history(spark, sf_dir)),
    }
    out = None
    for name, df in datasets.items():
        own = [(f.name, f.dataType.simpleString(), bool(f.metadata.get("pii"))) for f in edge(df).schema.fields]
        columns = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.lit(p).alias("pii"))
                            for c, t, p in own])
        rows = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.inline(columns))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_location_strict(spark, sf_dir):
    """The documented location: NULL as soon as city or state is NULL."""
    out = silver.silver_customers_preprocessed(_customer_feed(spark, sf_dir), location="strict")
    return out.select("customer_id", "customer_location")


def q_processing_stamps(spark, sf_dir):
    """Rows whose processing time is set, per dataset."""
    datasets = {
        "silver_orders": (_orders(spark, sf_dir), "_processing_timestamp"),
        "silver_products": (_products(spark, sf_dir), "_processing_timestamp"),
        "dim_products": (gold.dim_products(_products(spark, sf_dir)), "_dimension_refresh_timestamp"),
    }
    out = None
    for name, (df, column) in datasets.items():
        rows = df.agg(F.count(column).alias("n_stamped")).select(F.lit(name).alias("dataset"), "n_stamped")
        out = rows if out is None else out.unionByName(rows)
    return out


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for entity in ENTITIES:
        out[f"bronze_{entity}"] = _bronze_query(entity)
    out.update({
        "silver_orders": q_silver_orders,
        "silver_order_items": q_silver_order_items,
        "silver_customers_preprocessed": q_silver_customers_preprocessed,
        "silver_product_category": q_silver_product_category,
        "silver_products": q_silver_products,
        "silver_products_stream": q_silver_products_stream,
        "silver_products_valid_weight": q_silver_products_valid_weight,
        "customers_scd2": q_customers_scd2,
        "customers_scd2_incremental": q_customers_scd2_incremental,
        "events_scd2": q_events_scd2,
        "dim_customers": q_dim_customers,
        "dim_products": q_dim_products,
        "fct_order_items": q_fct_order_items,
        "fct_order_items_stream": q_fct_order_items_stream,
        "fct_orders": q_fct_orders,
        "dq_metrics": q_dq_metrics,
        "snapshot_changes": q_snapshot_changes,
        "change_feed": q_change_feed,
        "pk_check_incremental": q_pk_check_incremental,
        "fk_check_incremental": q_fk_check_incremental,
        "pk_check": q_pk_check,
        "fk_check": q_fk_check,
        "late_by_day": q_late_by_day,
        "bronze_lineage": q_bronze_lineage,
        "dq_metrics_stream": q_dq_metrics_stream,
        "fct_order_items_bounded": q_fct_order_items_bounded,
        "fct_order_items_unmatched": q_fct_order_items_unmatched,
        "items_by_product_salted": q_items_by_product_salted,
        "items_by_hot_product_stream": q_items_by_hot_product_stream,
        "runner_incremental": q_runner_incremental,
        "table_properties": q_table_properties,
        "clustered_ranges": q_clustered_ranges,
        "dataset_schemas": q_dataset_schemas,
        "schema_check": q_schema_check,
        "silver_products_late_names": q_silver_products_late_names,
        "location_strict": q_location_strict,
        "processing_stamps": q_processing_stamps,
    })
    return out
