"""Driver contract: entry() runs, every query has oracle SQL, oracle matches on sf0.001."""

import importlib

import pytest

from strata.plans.oracle_sql import oracle
from strata.plans.queries import registry
from tests.oracle_check import canonical, duck

SF = "/root/testdata/sf0.001"
entry_mod = importlib.import_module("__spark_entry__")

FAST = ["silver_orders", "silver_order_items", "silver_products", "customers_scd2",
        "events_scd2", "dim_customers", "fct_order_items", "dq_metrics", "pk_check",
        "fk_check", "snapshot_changes", "fct_orders", "late_by_day"]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "order_id" in df.columns and "product_volume_cm3" in df.columns


def test_every_query_has_oracle():
    assert set(registry()) == set(oracle())
    assert set(registry()) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle_sf0001(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    s_cols, s_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    res = duck(SF).execute(entry_mod.oracle_sql()[name])
    d_cols, d_rows = canonical([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows
