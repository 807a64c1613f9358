"""What the plans must look like to hold at scale."""

import pytest

from lakevault.operators import vault as ops
from lakevault.operators.vault import current
from lakevault.plans import build, marts, model
from lakevault.plans.catalogue import QUERIES
from lakevault.plans.initial import Packed, Vault, unpacked
from lakevault.plans.queries_time import AS_OF
from lakevault.sources.ingest import since_cursor


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


STATELESS = ["mart_revenue_per_customer", "mart_order_overview", "mart_product_sales", "pit_order", "asof_join",
             "sat_user_versions", "access_multi_hub", "access_pit_view", "psa_reinstated", "hub_customer_delta"]


@pytest.mark.parametrize("name", STATELESS)
def test_no_cartesian_product_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for unwanted in ("CartesianProduct", "NestedLoop", "PythonUDF", "EvalPython", "MapInPandas", "MapInArrow"):
        assert unwanted not in text


def test_staging_needs_no_shuffle(spark, sf_dir):
    assert "Exchange" not in plan(QUERIES["stage_customers"](spark, sf_dir))


def test_keyed_first_loads_need_no_shuffle(spark, sf_dir):
    for name in ("hub_customer", "sat_customer"):
        assert "Exchange" not in plan(Vault(spark, sf_dir)[name])


def test_latest_version_is_cut_before_the_shuffle(spark, sf_dir):
    sat = model.staged(spark, sf_dir, "user_states")
    text = plan(current(sat, "user_hk"))
    exchange = text.index("Exchange")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]


def test_cursor_filter_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(since_cursor(events, "ts", "2024-01-20 00:00:00"))
    assert "GreaterThanOrEqual(ts,2024-01-20T00:00" in text


def test_columns_are_pruned(spark, sf_dir):
    text = plan(QUERIES["distinct_orders_per_product"](spark, sf_dir))
    mart = plan(marts.MARTS["mart_revenue_per_customer"](Vault(spark, sf_dir)))
    assert "p_name" not in text and "o_totalprice" not in mart


def test_small_delta_filters_the_target_without_shuffling_it(spark, sf_dir):
    vault = Vault(spark, sf_dir)
    delta = model.staged(spark, sf_dir, "customers", 2)
    text = plan(ops.key_rows(delta, vault["hub_customer"], model.HUBS["hub_customer"]))
    assert "LeftSemi" in text and "BroadcastHashJoin" in text


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir):
    lake = build.warehouse(spark, sf_dir, AS_OF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.order_lines(build.Tables(lake)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_buckets_follow_the_input(spark, monkeypatch):
    """A task sorts one bucket, so a bucket holds no more of a larger input."""
    for size in (1 << 30, 6 << 30):
        monkeypatch.setattr(build, "folder_bytes", lambda *_, size=size: size)
        assert size / build.new_lake(spark, "any").buckets <= 16 << 20


def test_packed_keys_give_the_same_marts(spark, sf_dir):
    for name, mart in marts.MARTS.items():
        plain, packed = (sorted(map(str, mart(v).collect())) for v in (Vault(spark, sf_dir), Packed(Vault(spark, sf_dir))))
        assert plain == packed, name
    lines = marts.order_lines(Vault(spark, sf_dir))
    packed = marts.order_lines(Packed(Vault(spark, sf_dir)))
    assert packed.schema["order_product_hk"].dataType.simpleString() == "binary"
    assert unpacked(packed).select(lines.columns).exceptAll(lines).isEmpty() and lines.exceptAll(unpacked(packed).select(lines.columns)).isEmpty()


def test_orders_without_lines_read_none(spark, sf_dir):
    for name in ("hub_order", "lnk_order_customer"):
        plan = Vault(spark, sf_dir)[name]._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and "Exchange" not in plan, name


def test_catalog_holds_every_object_with_its_parents(spark, sf_dir):
    rows = {r["name"]: r for r in QUERIES["vault_catalog"](spark, sf_dir).collect()}
    assert rows.keys() == {*model.HUBS, *model.LINKS, *model.SATS, *model.PITS}
    assert rows["lnk_order_customer"]["parents"] == "hub_order,hub_customer" and rows["sat_order_detail"]["parents"] == "lnk_order_product"
    assert rows["pit_order"]["parents"] == "hub_order" and rows["pit_order"]["row_count"] == len(AS_OF) * rows["hub_order"]["row_count"]


def test_first_loads_shuffle_the_source_and_not_its_hashes(spark, sf_dir):
    tables = build.Tables(build.warehouse(spark, sf_dir, AS_OF))
    text = plan(tables.staged("order_details", by="order_product_hk").select("order_product_hk", "hashdiff", "quantity"))
    above, _, below = text.partition("Exchange hashpartitioning")
    assert "AS order_product_hk" in above and "AS hashdiff" in above and "AS order_product_hk" not in below and "AS hashdiff" not in below


def test_links_of_orders_lie_by_order(spark, sf_dir):
    tables = build.Tables(build.warehouse(spark, sf_dir, AS_OF))
    joined = tables["hub_order"].join(tables["lnk_order_customer"].hint("merge"), "order_hk").join(tables["lnk_order_employee"].hint("merge"), "order_hk")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)


def test_stored_keys_are_entropy_coded(spark, sf_dir):
    """32 hex digits of a key take some 16 bytes on disk."""
    lake = build.warehouse(spark, sf_dir, AS_OF)
    for layer, table in (("raw", "orders"), ("raw_vault", "sat_order_detail"), ("raw_vault", "pit_order"), ("mart", "mart_order_overview")):
        files = lake.read(layer, table).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files), table


def test_access_view_shuffles_narrow_rows(spark, sf_dir):
    """Order lines are dealt before they are hashed, and a hub that only shows its key joins them before the orders' payload."""
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["access_link_sat"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert "Exchange hashpartitioning(order_product_hk" not in text and text.count("Exchange hashpartitioning(unhex(md5(") == 2
    assert text.index("SortMergeJoin [order_hk") < text.index("SortMergeJoin [product_hk")


def test_totals_are_grouped_by_packed_keys(spark, lake, sf_dir, monkeypatch):
    plans = {}
    refresh = type(lake).refresh
    monkeypatch.setattr(type(lake), "refresh", lambda self, layer, table, key, rows=None, **more: (plans.update({table: plan(rows)}), refresh(self, layer, table, key, rows=rows, **more)))
    build.build_all(lake, spark, sf_dir, AS_OF)
    assert "Exchange hashpartitioning(order_hk" in plans["order_items"] and "unhex(order_hk" in plans["order_items"] and "unhex(product_hk" in plans["product_totals"]
    lines = marts.order_lines(build.Tables(lake))
    for name, rows in (("order_items", marts.item_totals(lines)), ("product_totals", marts.product_totals(lines))):
        stored = lake.read("meta", name)
        assert [f.dataType for f in stored.schema] == [f.dataType for f in rows.schema]
        assert stored.exceptAll(rows.select(stored.columns)).isEmpty() and rows.select(stored.columns).exceptAll(stored).isEmpty()
