"""Staging, vault loads, joins, aggregates, windows and marts as registered queries."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.functions.hashing import hash_key, hashdiff
from lakevault.operators import vault as ops
from lakevault.operators.ordered import intervals
from lakevault.operators.staging import Rank, StageSpec, stage
from lakevault.plans import marts, model, raw
from lakevault.plans.checks import diff_sql, key_sql
from lakevault.plans.initial import Packed, Vault, unpacked
from lakevault.plans.registry import query


# --- staging -------------------------------------------------------------------------------

def _register_stage(table: str) -> None:
    query(f"stage_{table}", f"SELECT * FROM stg_{table}")(
        lambda spark, sf, t=table: model.staged(spark, sf, t))


for _table in ("customers", "orders", "order_details", "products", "employees"):
    _register_stage(_table)


@query("stage_hash_key", f"SELECT c_custkey, {key_sql('c_name')} AS name_hk FROM customer")
def stage_hash_key(spark: SparkSession, sf: str) -> DataFrame:
    df = raw.given(spark, sf, "customer")
    return df.select("c_custkey", hash_key(df, ["c_name"]).alias("name_hk"))


_LINE_DIFF = ["l_quantity_dec", "l_returnflag", "l_shipdate", "l_linenumber"]


@query("stage_composite_key",
       f"SELECT l_orderkey, l_partkey, l_linenumber, "
       f"{key_sql('l_orderkey', 'l_partkey', 'l_returnflag')} AS line_hk FROM lineitem")
def stage_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    df = raw.given(spark, sf, "lineitem")
    return df.select("l_orderkey", "l_partkey", "l_linenumber",
                     hash_key(df, ["l_orderkey", "l_partkey", "l_returnflag"]).alias("line_hk"))


@query("stage_hashdiff",
       f"SELECT l_orderkey, l_partkey, {diff_sql(_LINE_DIFF)} AS line_diff "
       f"FROM (SELECT *, CAST(l_quantity AS DOUBLE) AS l_quantity_dec FROM lineitem)")
def stage_hashdiff(spark: SparkSession, sf: str) -> DataFrame:
    df = raw.given(spark, sf, "lineitem").withColumn("l_quantity_dec", F.col("l_quantity").cast("double"))
    return df.select("l_orderkey", "l_partkey", hashdiff(df, _LINE_DIFF).alias("line_diff"))


@query("stage_ranked", """SELECT id, customer_id, change_date, order_hk, delivery_rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY customer_id, change_date ORDER BY id) AS INTEGER) AS delivery_rank
        FROM stg_orders)""")
def stage_ranked(spark: SparkSession, sf: str) -> DataFrame:
    spec = StageSpec(
        derived={"record_source": "!CSV_LOAD"}, hashed={"order_hk": "id"},
        ranked={"delivery_rank": Rank(("customer_id", "change_date"), ("id",))},
    )
    return stage(raw.orders(spark, sf), spec).select(
        "id", "customer_id", "change_date", "order_hk", "delivery_rank")


@query("stage_dense_ranked", """SELECT order_id, product_id, line_number, price_rank FROM (SELECT *, CAST(dense_rank() OVER (
        PARTITION BY order_detail_status ORDER BY unit_price, discount) AS INTEGER) AS price_rank FROM raw_order_details)""")
def stage_dense_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Two or three partitions over all lines, with many equal keys."""
    spec = StageSpec(ranked={"price_rank": Rank(("order_detail_status",), ("unit_price", "discount"), dense=True)})
    return stage(raw.order_details(spark, sf), spec).select("order_id", "product_id", "line_number", "price_rank")


# --- vault loads ---------------------------------------------------------------------------

def _columns(name: str) -> list[str]:
    """Without dependent child keys, which only tell the rows of a link apart."""
    return {**model.HUBS, **model.LINKS, **model.SATS}[name].columns


def _register_load(name: str) -> None:
    query(name, f"SELECT * FROM {name}")(lambda spark, sf: Vault(spark, sf)[name].select(*_columns(name)))


for _name in (*model.HUBS, *model.LINKS, *model.SATS):
    _register_load(_name)


def _register_delta(key: str, name: str) -> None:
    query(key, f"SELECT * FROM new_{name}")(lambda spark, sf: Vault(spark, sf).delta_rows(name).select(*_columns(name)))


_register_delta("hub_customer_delta", "hub_customer")
_register_delta("hub_order_delta", "hub_order")
_register_delta("lnk_delta", "lnk_order_product")
_register_delta("sat_customer_delta", "sat_customer")
_register_delta("sat_order_detail_delta", "sat_order_detail")

_SAT_USER = """SELECT user_hk, hashdiff, state, effective_from, load_datetime, record_source FROM (
        SELECT *, lag(hashdiff) OVER (PARTITION BY user_hk ORDER BY load_datetime, hashdiff DESC) AS before
        FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_hk, load_datetime, hashdiff)
            AS rn FROM stg_user_states) WHERE rn = 1))
        WHERE before IS NULL OR before <> hashdiff"""


@query("sat_user_versions", "SELECT * FROM sat_user", sat_user=_SAT_USER)
def sat_user_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A source with many versions per key in one batch."""
    return ops.sat_rows(model.staged(spark, sf, "user_states"), None, model.USER_SAT)


@query("sat_reload_adds_nothing", "SELECT 'sat_customer' AS table_name, CAST(0 AS BIGINT) AS row_count "
       "UNION ALL SELECT 'sat_user', 0 UNION ALL SELECT 'hub_order', 0")
def sat_reload_adds_nothing(spark: SparkSession, sf: str) -> DataFrame:
    """Loading a batch a second time finds every row stored already."""
    vault, users = Vault(spark, sf), model.staged(spark, sf, "user_states")
    again = {
        "sat_customer": ops.sat_rows(
            model.staged(spark, sf, "customers"), vault["sat_customer"], model.SATS["sat_customer"]),
        "sat_user": ops.sat_rows(users, ops.sat_rows(users, None, model.USER_SAT), model.USER_SAT),
        "hub_order": ops.key_rows(
            model.staged(spark, sf, "orders"), vault["hub_order"], model.HUBS["hub_order"]),
    }
    return ops.count_tables(again)


@query("sat_reload_adds_changes", """SELECT customer_hk, hashdiff, load_datetime FROM new_sat_customer""")
def sat_reload_adds_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The first batch and the delta delivered together onto the first batch: what is stored is left out row by row."""
    vault = Vault(spark, sf)
    both = model.staged(spark, sf, "customers").unionByName(model.staged(spark, sf, "customers", 2))
    spec = dataclasses.replace(model.SATS["sat_customer"], one_row_per_key=False)
    return ops.sat_rows(both, vault["sat_customer"], spec).select("customer_hk", "hashdiff", "load_datetime")


@query("sat_current", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_hk
        ORDER BY load_datetime DESC, hashdiff) AS rn FROM all_sat_customer) WHERE rn = 1""")
def sat_current(spark: SparkSession, sf: str) -> DataFrame:
    return ops.current(Vault(spark, sf, with_delta=True)["sat_customer"], "customer_hk")


@query("sat_history", """SELECT s.*, customer_id FROM all_sat_customer s
        JOIN all_hub_customer USING (customer_hk) WHERE customer_id IN (1, 2, 3, 10000001, 10000002)""")
def sat_history(spark: SparkSession, sf: str) -> DataFrame:
    vault = Vault(spark, sf, with_delta=True)
    return ops.history(vault["sat_customer"], vault["hub_customer"], "customer_hk", "customer_id",
                       [1, 2, 3, raw.NEW_ID + 1, raw.NEW_ID + 2])


@query("sat_intervals", """SELECT customer_hk, load_datetime, lead(load_datetime) OVER (
        PARTITION BY customer_hk ORDER BY load_datetime) AS valid_to FROM all_sat_customer""")
def sat_intervals(spark: SparkSession, sf: str) -> DataFrame:
    sat = Vault(spark, sf, with_delta=True)["sat_customer"].select("customer_hk", "load_datetime")
    return intervals(sat, ["customer_hk"], "load_datetime")


_DELTA_TABLES = ("hub_customer", "sat_customer", "hub_order", "sat_order", "lnk_order_customer",
                 "lnk_order_employee", "lnk_order_product", "sat_order_detail")


@query("delta_effect", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS rows_before, "
    f"(SELECT count(*) FROM new_{n}) AS rows_added, "
    f"(SELECT count(*) FROM {n}) + (SELECT count(*) FROM new_{n}) AS rows_after"
    for n in _DELTA_TABLES))
def delta_effect(spark: SparkSession, sf: str) -> DataFrame:
    vault = Vault(spark, sf)
    return ops.delta_effect({n: vault.first_load(n) for n in _DELTA_TABLES},
                            {n: vault.delta_rows(n) for n in _DELTA_TABLES})


# --- joins, aggregates, order ---------------------------------------------------------------

@query("join_hub_sat", "SELECT customer_hk, customer_id, name, segment, nation_id, balance "
       "FROM hub_customer JOIN cur_sat_customer USING (customer_hk)")
def join_hub_sat(spark: SparkSession, sf: str) -> DataFrame:
    return marts.described(Vault(spark, sf), "hub_customer", "sat_customer", "customer_hk", "customer_id")


@query("join_link_sat", "SELECT * FROM order_lines")
def join_link_sat(spark: SparkSession, sf: str) -> DataFrame:
    return unpacked(marts.order_lines(Packed(Vault(spark, sf))).drop("line_number"))


@query("order_items", "SELECT * FROM order_items")
def order_items(spark: SparkSession, sf: str) -> DataFrame:
    return unpacked(marts.order_items(Packed(Vault(spark, sf)))).select(
        "order_hk", "line_items", (F.col("revenue_sum").cast("double") / F.lit(100.0)).alias("order_total"))


@query("distinct_orders_per_product", "SELECT product_hk, count(DISTINCT order_hk) AS orders_count, "
       "count(*) AS lines, max(load_datetime) AS last_load FROM stg_order_details GROUP BY product_hk")
def distinct_orders_per_product(spark: SparkSession, sf: str) -> DataFrame:
    """Exact distinct count on staged lines, where a pair may repeat."""
    return model.staged(spark, sf, "order_details").groupBy("product_hk").agg(
        F.count_distinct("order_hk").alias("orders_count"), F.count(F.lit(1)).alias("lines"),
        F.max("load_datetime").alias("last_load"))


@query("top_customers", """SELECT * FROM mart_revenue_per_customer
        ORDER BY total_revenue DESC NULLS FIRST, customer_id LIMIT 5""")
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    mart = marts.revenue_per_customer(Packed(Vault(spark, sf)))
    return mart.orderBy(F.desc_nulls_first("total_revenue"), "customer_id").limit(5)


# --- marts ---------------------------------------------------------------------------------

def _register_mart(name: str) -> None:
    query(name, f"SELECT * FROM {name}")(lambda spark, sf: marts.MARTS[name](Packed(Vault(spark, sf))))


for _mart in marts.MARTS:
    _register_mart(_mart)


@query("stage_hashdiff_double", """SELECT count(DISTINCT large) AS n_large, count(DISTINCT small) AS n_small,
        count(DISTINCT large) AS hashes_large, count(DISTINCT small) AS hashes_small FROM (
        SELECT CAST(o_orderkey AS DOUBLE) * 1e15 AS large, 1 / power(2.0::DOUBLE, 10 + o_orderkey % 40) AS small FROM orders)""")
def stage_hashdiff_double(spark: SparkSession, sf: str) -> DataFrame:
    """Doubles below 1e-4 and above 1e15: different values have different hashes, and none fails."""
    orders = raw.given(spark, sf, "orders").select(
        (F.col("o_orderkey").cast("double") * F.lit(1e15)).alias("large"),
        (F.lit(1.0) / F.pow(F.lit(2.0), F.col("o_orderkey") % 40 + 10)).alias("small"))
    hashed = orders.select("large", "small", hashdiff(orders, ["large"]).alias("hl"), hashdiff(orders, ["small"]).alias("hs"))
    return hashed.agg(F.count_distinct("large").alias("n_large"), F.count_distinct("small").alias("n_small"),
                      F.count_distinct("hl").alias("hashes_large"), F.count_distinct("hs").alias("hashes_small"))


class _MissingPrices:
    """The vault with the prices of all lines over 25 pieces removed."""

    def __init__(self, vault: Vault):
        self.vault = vault

    def __getitem__(self, name: str) -> DataFrame:
        rows = self.vault[name]
        if name == "sat_order_detail":
            rows = rows.withColumn("unit_price", F.when(F.col("quantity") <= 25, F.col("unit_price")))
        return rows


@query("mart_product_sales_missing_price", """SELECT product_id, sum(quantity) AS total_quantity_sold,
        cast(sum(quantity * unit_price * (100 - discount)) FILTER (quantity <= 25) AS DOUBLE) / 100 AS total_revenue,
        cast(sum(quantity * (unit_price - standard_cost)) FILTER (quantity <= 25) AS DOUBLE) AS estimated_margin
        FROM hub_product JOIN sat_product USING (product_hk) LEFT JOIN order_lines USING (product_hk) GROUP BY product_id""")
def mart_product_sales_missing_price(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without a price have no part in revenue and margin."""
    sales = marts.product_sales(Packed(_MissingPrices(Vault(spark, sf))))
    return sales.select("product_id", "total_quantity_sold", "total_revenue", "estimated_margin")


@query("mart_revenue_complete", """SELECT count(*) AS line_items, cast(sum(CAST(l_quantity AS DECIMAL(9,2)) * CAST(l_extendedprice AS DECIMAL(12,2))
        * (100 - CAST(l_discount AS DECIMAL(5,2)))) AS DOUBLE) / 100 AS revenue FROM lineitem""")
def mart_revenue_complete(spark: SparkSession, sf: str) -> DataFrame:
    """No order line is lost on the way to the marts: lines and revenue over all orders."""
    totals = marts.order_items(Packed(Vault(spark, sf))).agg(F.sum("line_items").alias("line_items"), F.sum("revenue_sum").alias("total"))
    return totals.select("line_items", (F.col("total").cast("double") / F.lit(100.0)).alias("revenue"))
