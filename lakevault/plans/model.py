"""The declared warehouse: staging specs, vault specs and how they belong together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakevault.operators.staging import Diff, StageSpec, stage
from lakevault.operators.vault import HubSpec, LinkSpec, SatSpec
from lakevault.plans import raw

CUSTOMER_PAYLOAD = ("name", "segment", "nation_id", "balance")
EMPLOYEE_PAYLOAD = ("name", "nation_id", "balance")
PRODUCT_PAYLOAD = ("product_code", "product_name", "category", "size", "list_price", "standard_cost")
ORDER_PAYLOAD = ("order_date", "shipped_date", "shipping_fee", "payment_type", "order_status")
DETAIL_PAYLOAD = ("quantity", "unit_price", "discount", "order_detail_status", "date_allocated")


def _loaded(source: str, **more: str) -> dict[str, str]:
    return {"record_source": source, "effective_from": "change_date", "load_datetime": "change_date", **more}


STAGING: dict[str, StageSpec] = {
    "customers": StageSpec(
        derived=_loaded("!CSV_LOAD", customer_id="id"),
        hashed={"customer_hk": "id", "hashdiff": Diff(CUSTOMER_PAYLOAD)},
    ),
    "customers_psa": StageSpec(
        derived=_loaded("!PSA_NG_GEN", customer_id="id"),
        hashed={"customer_hk": "id", "hashdiff": Diff(CUSTOMER_PAYLOAD)},
    ),
    "employees": StageSpec(
        derived=_loaded("!CSV_LOAD", employee_id="id"),
        hashed={"employee_hk": "id", "hashdiff": Diff(EMPLOYEE_PAYLOAD)},
    ),
    "products": StageSpec(
        derived=_loaded("!CSV_LOAD", product_id="id"),
        hashed={"product_hk": "id", "hashdiff": Diff(PRODUCT_PAYLOAD)},
    ),
    "orders": StageSpec(
        derived=_loaded("!CSV_LOAD", order_id="id"),
        hashed={
            "order_hk": "id", "customer_hk": "customer_id", "employee_hk": "employee_id",
            "order_customer_hk": ["id", "customer_id"], "order_employee_hk": ["id", "employee_id"],
            "hashdiff": Diff(ORDER_PAYLOAD),
        },
    ),
    "order_details": StageSpec(
        derived=_loaded("!CSV_LOAD"),
        hashed={
            "order_hk": "order_id", "product_hk": "product_id",
            "order_product_hk": ["order_id", "product_id", "line_number"], "hashdiff": Diff(DETAIL_PAYLOAD),
        },
    ),
    "user_states": StageSpec(
        derived=_loaded("!EVENTS", user_id="id"),
        hashed={"user_hk": "id", "hashdiff": Diff(("state",))},
    ),
}

HUBS = {h.name: h for h in (
    HubSpec("hub_customer", "customer_hk", "customer_id", "customers", one_row_per_key=True),
    HubSpec("hub_employee", "employee_hk", "employee_id", "employees", one_row_per_key=True),
    HubSpec("hub_product", "product_hk", "product_id", "products", one_row_per_key=True),
    HubSpec("hub_order", "order_hk", "order_id", "orders", one_row_per_key=True),
)}
PSA_HUBS = {"hub_customer_psa": HubSpec(
    "hub_customer_psa", "customer_hk", "customer_id", "customers_psa", branch="psa", one_row_per_key=True)}

LINKS = {l.name: l for l in (
    LinkSpec("lnk_order_customer", "order_customer_hk", ("order_hk", "customer_hk"), "orders", one_row_per_key=True,
             lies_by="order_hk"),
    LinkSpec("lnk_order_employee", "order_employee_hk", ("order_hk", "employee_hk"), "orders", one_row_per_key=True,
             lies_by="order_hk"),
    LinkSpec("lnk_order_product", "order_product_hk", ("order_hk", "product_hk"), "order_details",
             one_row_per_key=True, child=("line_number",)),
)}

SATS = {s.name: s for s in (
    SatSpec("sat_customer", "customer_hk", CUSTOMER_PAYLOAD, "customers", one_row_per_key=True),
    SatSpec("sat_employee", "employee_hk", EMPLOYEE_PAYLOAD, "employees", one_row_per_key=True),
    SatSpec("sat_product", "product_hk", PRODUCT_PAYLOAD, "products", one_row_per_key=True),
    SatSpec("sat_order", "order_hk", ORDER_PAYLOAD, "orders", one_row_per_key=True),
    SatSpec("sat_order_detail", "order_product_hk", DETAIL_PAYLOAD, "order_details", one_row_per_key=True),
)}
PSA_SATS = {"sat_customer_psa": SatSpec(
    "sat_customer_psa", "customer_hk", CUSTOMER_PAYLOAD, "customers_psa", branch="psa", one_row_per_key=True)}
USER_SAT = SatSpec("sat_user", "user_hk", ("state",), "user_states", grain="day")

PITS = {"pit_customer": ("hub_customer", ("sat_customer",)), "pit_order": ("hub_order", ("sat_order",))}

# Fixed primary keys of the raw layer.
RAW_KEYS = {
    "customers": ("id",), "employees": ("id",), "products": ("id",), "orders": ("id",),
    "order_details": ("order_id", "product_id", "line_number"),
}

# The domains and their tables.
DOMAINS = {
    "domain_master": ("hub_customer", "hub_employee", "hub_product",
                      "sat_customer", "sat_employee", "sat_product"),
    "domain_orders": ("hub_order", "lnk_order_customer", "lnk_order_employee", "lnk_order_product",
                      "sat_order", "sat_order_detail", "pit_customer", "pit_order"),
    "consumption": ("mart_revenue_per_customer", "mart_order_overview", "mart_product_sales"),
}

_RAW = {
    1: {"customers": raw.customers, "employees": raw.employees, "products": raw.products,
        "orders": raw.orders, "order_details": raw.order_details, "user_states": raw.user_states},
    2: {"customers": raw.customers_delta, "orders": raw.orders_delta,
        "order_details": raw.order_details_delta},
}


def staged(spark: SparkSession, sf_dir: str, table: str, batch: int = 1) -> DataFrame:
    """A staging view over one delivery of a raw table."""
    return stage(_RAW[batch][table](spark, sf_dir), STAGING[table])
