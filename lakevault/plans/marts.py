"""The three marts, over anything that answers ``vault[table_name]`` with a DataFrame.

Order lines are aggregated per order or per product before they are joined to anything, so the
largest table is combined on the map side and a single order, customer or product with very many
lines does not pile up in one join task. That is the same result because a link holds each
(order, customer) pair and each line of an (order, product) pair once; the first line of a pair counts
the order of a product. Money stays exact until the last step.

These totals (per order, customer and product) are additive: stored next to the marts, they take the
changes of a delta (``lakevault.plans.increments``). Each sum goes with the number of values in it, so
that a sum of nothing stays NULL.
A stored table has no order, so the marts are not sorted; sort on read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.operators.vault import current

SCALE = 100  # discounts are hundredths


def measures(discount_scale: int = SCALE) -> dict[str, Column]:
    """What a line adds to each total."""
    gross = F.col("quantity") * F.col("unit_price")
    return {
        "quantity": F.col("quantity"),
        "gross": gross,
        # lines without a price are in no part of the margin
        "priced": F.when(F.col("unit_price").isNotNull(), F.col("quantity")),
        "revenue": gross * (F.lit(discount_scale).cast("decimal(3,0)") - F.col("discount")),
    }


def _totalled(names, discount_scale: int) -> list[Column]:
    found = measures(discount_scale)
    return [part for n in names for part in (F.sum(found[n]).alias(f"{n}_sum"), F.count(found[n]).alias(f"{n}_n"))]


def order_lines(vault) -> DataFrame:
    """Link joined to the current version of its satellite.

    Both sides have a row per order line, so neither is ever small: the hint keeps Spark from
    broadcasting one on the strength of its compressed file size.
    """
    return vault["lnk_order_product"].select("order_product_hk", "order_hk", "product_hk", "line_number").join(
        current(vault["sat_order_detail"], "order_product_hk")
        .select("order_product_hk", "quantity", "unit_price", "discount").hint("merge"),
        "order_product_hk",
    )


def described(vault, hub: str, sat: str, pk: str, nk: str) -> DataFrame:
    """Hub joined to the current version of its satellite."""
    keep = current(vault[sat], pk).drop("hashdiff", "effective_from", "load_datetime", "record_source")
    return vault[hub].select(pk, nk).join(keep, pk)


def item_totals(lines: DataFrame, discount_scale: int = SCALE) -> DataFrame:
    """Per order."""
    return lines.groupBy("order_hk").agg(F.count(F.lit(1)).alias("line_items"), *_totalled(["revenue"], discount_scale))


def product_totals(lines: DataFrame, discount_scale: int = SCALE) -> DataFrame:
    """Per product."""
    first = F.count_if(F.col("line_number") == 1).alias("orders_count")
    return lines.groupBy("product_hk").agg(first, *_totalled(["quantity", "gross", "priced", "revenue"], discount_scale))


def customer_totals(vault, items: DataFrame) -> DataFrame:
    """Per customer, over the orders that have lines."""
    links = vault["lnk_order_customer"].select("order_hk", "customer_hk")
    return links.join(items.hint("merge"), "order_hk").groupBy("customer_hk").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("revenue_sum").alias("revenue_sum"), F.sum("revenue_n").alias("revenue_n"))


def order_items(vault, discount_scale: int = SCALE) -> DataFrame:
    return item_totals(order_lines(vault), discount_scale).select("order_hk", "line_items", "revenue_sum")


def _total(name: str) -> Column:
    return F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum"))


def _among(df: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    return df if keys is None else df.join(keys.select(key), key, "left_semi")


class Among:
    """A vault seen through the chosen keys of one hub: its other rows are left out of hub, satellites and links."""

    def __init__(self, vault, keys: DataFrame, key: str):
        self.vault, self.keys, self.key = vault, keys, key

    def __getitem__(self, name: str) -> DataFrame:
        rows = self.vault[name]
        return _among(rows, self.keys, self.key) if self.key in rows.columns else rows


def revenue_per_customer(vault, discount_scale: int = SCALE, totals: DataFrame | None = None) -> DataFrame:
    """Customers without order lines are left out."""
    if totals is None:
        totals = customer_totals(vault, item_totals(order_lines(vault), discount_scale))
    customers = described(vault, "hub_customer", "sat_customer", "customer_hk", "customer_id")
    return customers.join(totals, "customer_hk").select(
        "customer_id", "name", "segment", "nation_id", "total_orders",
        (_total("revenue").cast("double") / F.lit(float(discount_scale))).alias("total_revenue"),
    )


def order_overview(vault, discount_scale: int = SCALE, items: DataFrame | None = None) -> DataFrame:
    """Every order; customer, employee and totals where known."""
    if items is None:
        items = item_totals(order_lines(vault), discount_scale)
    orders = described(vault, "hub_order", "sat_order", "order_hk", "order_id")
    # names are joined to the links, so that orders without a customer or employee meet only by order
    customers = vault["lnk_order_customer"].select("order_hk", "customer_hk").join(
        described(vault, "hub_customer", "sat_customer", "customer_hk", "customer_id"), "customer_hk").select(
        "order_hk", F.concat("name", F.lit(", "), "segment").alias("customer_name"), "segment")
    employees = vault["lnk_order_employee"].select("order_hk", "employee_hk").join(
        described(vault, "hub_employee", "sat_employee", "employee_hk", "employee_id"), "employee_hk").select(
        "order_hk", F.col("name").alias("employee_name"))
    return (
        orders
        .join(items.hint("merge"), "order_hk", "left")
        .join(customers.hint("merge"), "order_hk", "left")
        .join(employees.hint("merge"), "order_hk", "left")
        .select(
            "order_id", "order_date", "shipped_date", "order_status", "payment_type", "shipping_fee",
            "customer_name", F.col("segment").alias("company"), "employee_name", "line_items",
            (_total("revenue").cast("double") / F.lit(float(discount_scale))).alias("order_total"),
        )
    )


def product_sales(vault, discount_scale: int = SCALE, totals: DataFrame | None = None) -> DataFrame:
    """Every product; the margin leaves the discount out and nets out the standard cost."""
    if totals is None:
        totals = product_totals(order_lines(vault), discount_scale)
    products = described(vault, "hub_product", "sat_product", "product_hk", "product_id")
    cost = F.col("standard_cost") * _total("priced").cast("decimal(19,2)")
    return products.join(totals, "product_hk", "left").select(
        "product_id", "product_code", "product_name", "category", "list_price", "standard_cost",
        F.coalesce("orders_count", F.lit(0)).alias("orders_count"),
        _total("quantity").cast("decimal(38,2)").alias("total_quantity_sold"),
        (_total("revenue").cast("double") / F.lit(float(discount_scale))).alias("total_revenue"),
        (_total("gross") - cost).cast("double").alias("estimated_margin"),
    )


MARTS = {
    "mart_revenue_per_customer": revenue_per_customer,
    "mart_order_overview": order_overview,
    "mart_product_sales": product_sales,
}
