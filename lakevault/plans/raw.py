"""Raw-layer tables shaped from the given Parquet tables, with two later deliveries.

Batch 1 is the first full delivery. Batch 2 is a delta: customers with a negative balance change
segment, and every supplier becomes a new customer with one order of one line. Batch 3 is a full
delivery after that in which the accounts outside [-900, 9500] are gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NEW_ID = 10_000_000  # first id of the customers and orders that batch 2 adds
BATCH_1 = "2016-05-01 00:00:00"
BATCH_2 = "2024-01-15 00:00:00"


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").cast("decimal(19,4)").alias("balance"), _ntz(BATCH_1).alias("change_date"),
    )


def customers_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = customers(spark, sf_dir).where("balance < 0").withColumns(
        {"segment": F.lit("REASSIGNED"), "change_date": _ntz(BATCH_2)})
    new = given(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + NEW_ID).alias("id"), F.col("s_name").alias("name"),
        F.lit("SUPPLIER").alias("segment"), F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").cast("decimal(19,4)").alias("balance"), _ntz(BATCH_2).alias("change_date"),
    )
    return changed.unionByName(new)


def customers_after_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full state of the source after batch 2."""
    kept = customers(spark, sf_dir).where("balance >= 0 OR balance IS NULL")
    return kept.unionByName(customers_delta(spark, sf_dir))


def customers_batch3(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = (F.col("id") < NEW_ID) & ((F.col("balance") > 9500) | (F.col("balance") < -900))
    return customers_after_delta(spark, sf_dir).where(~F.coalesce(gone, F.lit(False)))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_code"), F.col("p_type").alias("category"),
        F.col("p_size").alias("size"), price.alias("list_price"),
        (price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(12,4)").alias("standard_cost"),
        _ntz(BATCH_1).alias("change_date"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").cast("decimal(19,4)").alias("balance"), _ntz(BATCH_1).alias("change_date"),
    )


def orders(spark: SparkSession, sf_dir: str, with_lines: bool = True) -> DataFrame:
    """Without lines, what these tell about an order (employee, shipping) is left NULL and they are not read."""
    placed = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_type"),
        F.col("o_totalprice").cast("decimal(19,4)").alias("shipping_fee"),
        F.col("o_orderdate").alias("change_date"),
    )
    columns = ["id", "employee_id", "customer_id", "order_date", "shipped_date", "shipping_fee",
               "payment_type", "order_status", "change_date"]
    if not with_lines:
        lines = given(spark, sf_dir, "lineitem").schema
        unknown = {"employee_id": "l_suppkey", "shipped_date": "l_shipdate"}
        return placed.withColumns({n: F.lit(None).cast(lines[c].dataType) for n, c in unknown.items()}).select(*columns)
    handled = given(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.min("l_suppkey").alias("employee_id"), F.min("l_shipdate").alias("shipped_date"))
    return placed.join(handled, "id", "left").select(*columns)


def orders_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per new customer; orders of suppliers with a small balance are not shipped yet."""
    key = F.col("s_suppkey") + NEW_ID
    return given(spark, sf_dir, "supplier").select(
        key.alias("id"), F.col("s_suppkey").alias("employee_id"), key.alias("customer_id"),
        _ntz("2024-01-10 00:00:00").alias("order_date"),
        F.when(F.col("s_acctbal") >= 1000, _ntz("2024-01-12 00:00:00")).alias("shipped_date"),
        F.lit("12.5000").cast("decimal(19,4)").alias("shipping_fee"),
        F.lit("1-URGENT").alias("payment_type"), F.lit("O").alias("order_status"),
        _ntz(BATCH_2).alias("change_date"),
    )


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines. The given ones can repeat an (order, product) pair, so a number within the pair, in a
    total order, completes the key."""
    order = ["l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    pair = Window.partitionBy("l_orderkey", "l_partkey").orderBy(*order)
    lines = given(spark, sf_dir, "lineitem").withColumn("line_number", F.row_number().over(pair))
    return lines.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), "line_number",
        F.col("l_quantity").cast("decimal(9,2)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_discount").cast("decimal(5,2)").alias("discount"),
        F.col("l_linestatus").alias("order_detail_status"),
        F.col("l_shipdate").alias("date_allocated"), F.col("l_shipdate").alias("change_date"),
    )


def order_details_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per new order; the product number is the supplier's, its price the part's."""
    new = given(spark, sf_dir, "supplier").select("s_suppkey")
    part = given(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return new.join(part, new.s_suppkey == part.p_partkey).select(
        (F.col("s_suppkey") + NEW_ID).alias("order_id"), F.col("p_partkey").alias("product_id"),
        F.lit(1).alias("line_number"),
        F.lit("2.00").cast("decimal(9,2)").alias("quantity"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
        F.lit("0.05").cast("decimal(5,2)").alias("discount"), F.lit("O").alias("order_detail_status"),
        F.lit(None).cast("timestamp_ntz").alias("date_allocated"), _ntz(BATCH_2).alias("change_date"),
    )


def user_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that brings many versions per key: the event stream read as user states."""
    return given(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("state"), F.col("ts").alias("change_date"))
