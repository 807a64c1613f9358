"""The declared data-quality tests and freshness rules of the warehouse."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column

from lakevault.operators import quality as q

HUB_KEYS = {"hub_customer": "customer_hk", "hub_employee": "employee_hk",
            "hub_product": "product_hk", "hub_order": "order_hk"}
LINK_KEYS = {"lnk_order_customer": "order_customer_hk", "lnk_order_employee": "order_employee_hk",
             "lnk_order_product": "order_product_hk"}
NAME_PATTERN = "^[A-Z][a-z]+#[0-9]{9}$"


def staging_tests() -> list[q.Test]:
    quality = {"tags": ("quality",)}
    return [
        q.not_null("stg_customers", "customer_hk"), q.not_null("stg_customers", "customer_id"),
        q.matches("stg_customers", "name", NAME_PATTERN, **quality),
        q.not_null("stg_employees", "employee_hk"), q.not_null("stg_employees", "employee_id"),
        q.pair_ordered("stg_orders", "shipped_date", "order_date", where="shipped_date IS NOT NULL",
                       severity="warn", tags=("quality", "demo-highlight")),
        q.not_null("stg_orders", "order_hk"), q.not_null("stg_orders", "order_id"),
        q.between("stg_orders", "shipping_fee", 0, 100, **quality),
        q.distinct_count("stg_orders", "order_status", 4, **quality),
        q.not_null("stg_order_details", "order_product_hk"),
        q.between("stg_order_details", "discount", 0, 100, **quality),
        q.between("stg_order_details", "unit_price", 0, strictly=True, **quality),
        q.between("stg_order_details", "quantity", 0, strictly=True, **quality),
        q.not_null("stg_products", "product_hk"), q.not_null("stg_products", "product_id"),
    ]


def vault_tests(now: Column) -> list[q.Test]:
    integrity = {"tags": ("vault-integrity",)}
    tests = [t for model, key in (HUB_KEYS | LINK_KEYS).items()
             for t in (q.unique(model, key), q.not_null(model, key))]
    return tests + [
        q.unique_ratio("hub_customer", "customer_id", 1.0, 1.0, **integrity),
        q.unique_ratio("hub_order", "order_id", 1.0, 1.0, **integrity),
        q.compound_unique("lnk_order_customer", ["order_hk", "customer_hk"], **integrity),
        q.compound_unique("lnk_order_product", ["order_hk", "product_hk"], **integrity),
        q.unique_ratio("sat_customer", "customer_hk", 0.5, 1.0, **integrity),
        q.recent("sat_customer", "load_datetime", now, 3, severity="warn", tags=("freshness",)),
        q.recent("sat_order", "load_datetime", now, 3, severity="warn", tags=("freshness",)),
    ]


def mart_tests() -> list[q.Test]:
    logic = {"tags": ("business-logic",)}
    return [
        q.row_count("mart_revenue_per_customer", 1, 200, **logic),
        q.unique("mart_revenue_per_customer", "customer_id"),
        q.not_null("mart_revenue_per_customer", "customer_id"),
        q.between("mart_revenue_per_customer", "total_revenue", 0, **logic),
        q.between("mart_revenue_per_customer", "total_orders", 1, **logic),
        q.row_count("mart_order_overview", 600, **logic),
        q.unique("mart_order_overview", "order_id"), q.not_null("mart_order_overview", "order_id"),
        q.unique("mart_product_sales", "product_id"), q.not_null("mart_product_sales", "product_id"),
        q.between("mart_product_sales", "total_quantity_sold", 0, **logic),
    ]


FRESHNESS = [
    q.Freshness("customers", "change_date", warn_after=timedelta(hours=12)),
    q.Freshness("employees", "change_date", warn_after=timedelta(hours=12)),
    q.Freshness("orders", "change_date", warn_after=timedelta(hours=24)),
    q.Freshness("order_details", "change_date", warn_after=timedelta(hours=24)),
    q.Freshness("products", "change_date", warn_after=timedelta(hours=48)),
]
PSA_FRESHNESS = [
    q.Freshness("customers_psa", "ng_insert_date", timedelta(hours=48), timedelta(hours=72)),
    q.Freshness("v_customers_cln", "change_date"),
]
