"""SQL for the independent check of each query, put together from named parts.

``check(body, ...)`` puts the parts a body mentions (directly or through other parts) in front of
it as common table expressions.
"""

from __future__ import annotations

import re

from lakevault.plans.model import (
    CUSTOMER_PAYLOAD, DETAIL_PAYLOAD, EMPLOYEE_PAYLOAD, ORDER_PAYLOAD, PRODUCT_PAYLOAD,
)


def key_sql(*columns: str) -> str:
    parts = [f"nullif(upper(trim(cast({c} AS VARCHAR))), '')" for c in columns]
    joined = ", ".join(f"coalesce({p}, '^^')" for p in parts)
    return f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN md5(concat_ws('||', {joined})) END"


def diff_sql(columns) -> str:
    return "md5(concat_ws('||', " + ", ".join(
        f"coalesce(cast({c} AS VARCHAR), '^^')" for c in sorted(columns)) + "))"


def rowhash_sql(columns) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce(cast({c} AS VARCHAR), '')" for c in columns) + "))"


def _stage_customers(raw: str, source: str = "CSV_LOAD") -> str:
    return f"""SELECT *, '{source}' AS record_source, change_date AS effective_from,
        change_date AS load_datetime, id AS customer_id,
        {key_sql('id')} AS customer_hk, {diff_sql(CUSTOMER_PAYLOAD)} AS hashdiff FROM {raw}"""


def _stage_orders(raw: str) -> str:
    return f"""SELECT *, 'CSV_LOAD' AS record_source, change_date AS effective_from,
        change_date AS load_datetime, id AS order_id, {key_sql('id')} AS order_hk,
        {key_sql('customer_id')} AS customer_hk, {key_sql('employee_id')} AS employee_hk,
        {key_sql('id', 'customer_id')} AS order_customer_hk,
        {key_sql('id', 'employee_id')} AS order_employee_hk,
        {diff_sql(ORDER_PAYLOAD)} AS hashdiff FROM {raw}"""


def _stage_details(raw: str) -> str:
    return f"""SELECT *, 'CSV_LOAD' AS record_source, change_date AS effective_from,
        change_date AS load_datetime, {key_sql('order_id')} AS order_hk,
        {key_sql('product_id')} AS product_hk, {key_sql('order_id', 'product_id', 'line_number')} AS order_product_hk,
        {diff_sql(DETAIL_PAYLOAD)} AS hashdiff FROM {raw}"""


def _first(columns, pk, source, keys) -> str:
    cols = ", ".join(columns)
    missing = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {pk}
        ORDER BY load_datetime, record_source) AS rn FROM {source} WHERE {missing}) WHERE rn = 1"""


def _hub(pk, nk, source) -> str:
    return _first([pk, nk, "load_datetime", "record_source"], pk, source, [pk])


def _link(pk, fks, source) -> str:
    return _first([pk, *fks, "load_datetime", "record_source"], pk, source, [pk, *fks])


def _sat(pk, payload, source) -> str:
    """A first load from a source with one row per key."""
    return f"""SELECT {pk}, hashdiff, {', '.join(payload)}, effective_from, load_datetime, record_source
        FROM {source} WHERE {pk} IS NOT NULL"""


def _new_keys(rows: str, stored: str, pk: str) -> str:
    return f"SELECT * FROM ({rows}) WHERE {pk} NOT IN (SELECT {pk} FROM {stored})"


def _changed(rows: str, stored: str, pk: str) -> str:
    return f"""SELECT n.* FROM ({rows}) n LEFT JOIN {stored} s ON s.{pk} = n.{pk}
        WHERE s.{pk} IS NULL OR s.hashdiff <> n.hashdiff"""


def _current(sat: str, pk: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {pk}
        ORDER BY load_datetime DESC, hashdiff) AS rn FROM {sat}) WHERE rn = 1"""


_CUSTOMER_COLUMNS = """c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation_id,
        CAST(c_acctbal AS DECIMAL(19,4)) AS balance"""

PARTS: dict[str, str] = {
    "raw_customers": f"SELECT {_CUSTOMER_COLUMNS}, TIMESTAMP '2016-05-01 00:00:00' AS change_date FROM customer",
    "raw_customers_delta": """SELECT id, name, 'REASSIGNED' AS segment, nation_id, balance,
            TIMESTAMP '2024-01-15 00:00:00' AS change_date FROM raw_customers WHERE balance < 0
        UNION ALL SELECT s_suppkey + 10000000, s_name, 'SUPPLIER', s_nationkey,
            CAST(s_acctbal AS DECIMAL(19,4)), TIMESTAMP '2024-01-15 00:00:00' FROM supplier""",
    "raw_customers_after_delta": """SELECT * FROM raw_customers WHERE balance >= 0 OR balance IS NULL
        UNION ALL SELECT * FROM raw_customers_delta""",
    "raw_customers_batch3": """SELECT * FROM raw_customers_after_delta
        WHERE NOT coalesce(id < 10000000 AND (balance > 9500 OR balance < -900), FALSE)""",
    "raw_products": """SELECT p_partkey AS id, p_name AS product_name, p_brand AS product_code,
        p_type AS category, p_size AS size, CAST(p_retailprice AS DECIMAL(12,2)) AS list_price,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(12,4)) AS standard_cost,
        TIMESTAMP '2016-05-01 00:00:00' AS change_date FROM part""",
    "raw_employees": """SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation_id,
        CAST(s_acctbal AS DECIMAL(19,4)) AS balance, TIMESTAMP '2016-05-01 00:00:00' AS change_date
        FROM supplier""",
    "raw_orders": """SELECT o_orderkey AS id, employee_id, o_custkey AS customer_id,
        o_orderdate AS order_date, shipped_date, CAST(o_totalprice AS DECIMAL(19,4)) AS shipping_fee,
        o_orderpriority AS payment_type, o_orderstatus AS order_status, o_orderdate AS change_date
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS employee_id,
            min(l_shipdate) AS shipped_date FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "raw_orders_delta": """SELECT s_suppkey + 10000000 AS id, s_suppkey AS employee_id,
        s_suppkey + 10000000 AS customer_id, TIMESTAMP '2024-01-10 00:00:00' AS order_date,
        CASE WHEN s_acctbal >= 1000 THEN TIMESTAMP '2024-01-12 00:00:00' END AS shipped_date,
        CAST(12.5 AS DECIMAL(19,4)) AS shipping_fee, '1-URGENT' AS payment_type, 'O' AS order_status,
        TIMESTAMP '2024-01-15 00:00:00' AS change_date FROM supplier""",
    "raw_order_details": """SELECT l_orderkey AS order_id, l_partkey AS product_id, line_number,
        CAST(l_quantity AS DECIMAL(9,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
        CAST(l_discount AS DECIMAL(5,2)) AS discount, l_linestatus AS order_detail_status,
        l_shipdate AS date_allocated, l_shipdate AS change_date
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber,
            l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
            l_linestatus) AS INTEGER) AS line_number FROM lineitem)""",
    "raw_order_details_delta": """SELECT s_suppkey + 10000000 AS order_id, p_partkey AS product_id, 1 AS line_number,
        CAST(2 AS DECIMAL(9,2)) AS quantity, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
        CAST(0.05 AS DECIMAL(5,2)) AS discount, 'O' AS order_detail_status,
        CAST(NULL AS TIMESTAMP) AS date_allocated, TIMESTAMP '2024-01-15 00:00:00' AS change_date
        FROM supplier JOIN part ON s_suppkey = p_partkey""",
    "raw_user_states": "SELECT user_id AS id, event_type AS state, ts AS change_date FROM events",
    "stg_customers": _stage_customers("raw_customers"),
    "stg_customers_delta": _stage_customers("raw_customers_delta"),
    "stg_employees": f"""SELECT *, 'CSV_LOAD' AS record_source, change_date AS effective_from,
        change_date AS load_datetime, id AS employee_id, {key_sql('id')} AS employee_hk,
        {diff_sql(EMPLOYEE_PAYLOAD)} AS hashdiff FROM raw_employees""",
    "stg_products": f"""SELECT *, 'CSV_LOAD' AS record_source, change_date AS effective_from,
        change_date AS load_datetime, id AS product_id, {key_sql('id')} AS product_hk,
        {diff_sql(PRODUCT_PAYLOAD)} AS hashdiff FROM raw_products""",
    "stg_orders": _stage_orders("raw_orders"),
    "stg_orders_delta": _stage_orders("raw_orders_delta"),
    "stg_order_details": _stage_details("raw_order_details"),
    "stg_order_details_delta": _stage_details("raw_order_details_delta"),
    "stg_user_states": f"""SELECT *, 'EVENTS' AS record_source, change_date AS effective_from,
        change_date AS load_datetime, id AS user_id, {key_sql('id')} AS user_hk,
        {diff_sql(['state'])} AS hashdiff FROM raw_user_states""",
    "hub_customer": _hub("customer_hk", "customer_id", "stg_customers"),
    "hub_employee": _hub("employee_hk", "employee_id", "stg_employees"),
    "hub_product": _hub("product_hk", "product_id", "stg_products"),
    "hub_order": _hub("order_hk", "order_id", "stg_orders"),
    "lnk_order_customer": _link("order_customer_hk", ["order_hk", "customer_hk"], "stg_orders"),
    "lnk_order_employee": _link("order_employee_hk", ["order_hk", "employee_hk"], "stg_orders"),
    "lnk_order_product": _link("order_product_hk", ["order_hk", "product_hk"], "stg_order_details"),
    "sat_customer": _sat("customer_hk", CUSTOMER_PAYLOAD, "stg_customers"),
    "sat_employee": _sat("employee_hk", EMPLOYEE_PAYLOAD, "stg_employees"),
    "sat_product": _sat("product_hk", PRODUCT_PAYLOAD, "stg_products"),
    "sat_order": _sat("order_hk", ORDER_PAYLOAD, "stg_orders"),
    "sat_order_detail": _sat("order_product_hk", DETAIL_PAYLOAD, "stg_order_details"),
    "new_hub_customer": _new_keys(
        _hub("customer_hk", "customer_id", "stg_customers_delta"), "hub_customer", "customer_hk"),
    "new_hub_order": _new_keys(_hub("order_hk", "order_id", "stg_orders_delta"), "hub_order", "order_hk"),
    "new_lnk_order_customer": _new_keys(
        _link("order_customer_hk", ["order_hk", "customer_hk"], "stg_orders_delta"),
        "lnk_order_customer", "order_customer_hk"),
    "new_lnk_order_employee": _new_keys(
        _link("order_employee_hk", ["order_hk", "employee_hk"], "stg_orders_delta"),
        "lnk_order_employee", "order_employee_hk"),
    "new_lnk_order_product": _new_keys(
        _link("order_product_hk", ["order_hk", "product_hk"], "stg_order_details_delta"),
        "lnk_order_product", "order_product_hk"),
    "new_sat_customer": _changed(
        _sat("customer_hk", CUSTOMER_PAYLOAD, "stg_customers_delta"), "sat_customer", "customer_hk"),
    "new_sat_order": _changed(_sat("order_hk", ORDER_PAYLOAD, "stg_orders_delta"), "sat_order", "order_hk"),
    "new_sat_order_detail": _changed(
        _sat("order_product_hk", DETAIL_PAYLOAD, "stg_order_details_delta"),
        "sat_order_detail", "order_product_hk"),
    "all_sat_customer": "SELECT * FROM sat_customer UNION ALL SELECT * FROM new_sat_customer",
    "all_hub_customer": "SELECT * FROM hub_customer UNION ALL SELECT * FROM new_hub_customer",
    "cur_sat_customer": _current("sat_customer", "customer_hk"),
    "order_lines": """SELECT order_hk, product_hk, order_product_hk, quantity, unit_price, discount
        FROM lnk_order_product JOIN sat_order_detail USING (order_product_hk)""",
    "order_items": """SELECT order_hk, count(*) AS line_items,
        cast(sum(quantity * unit_price * (100 - discount)) AS DOUBLE) / 100 AS order_total
        FROM order_lines GROUP BY order_hk""",
    "mart_revenue_per_customer": """SELECT customer_id, name, segment, nation_id,
        count(DISTINCT order_hk) AS total_orders,
        cast(sum(quantity * unit_price * (100 - discount)) AS DOUBLE) / 100 AS total_revenue
        FROM hub_customer JOIN cur_sat_customer USING (customer_hk)
        JOIN lnk_order_customer USING (customer_hk) JOIN order_lines USING (order_hk)
        GROUP BY customer_id, name, segment, nation_id""",
    "mart_order_overview": """SELECT order_id, order_date, shipped_date, order_status, payment_type,
        shipping_fee, c.name || ', ' || c.segment AS customer_name, c.segment AS company,
        e.name AS employee_name, line_items, order_total
        FROM hub_order o JOIN sat_order USING (order_hk)
        LEFT JOIN lnk_order_customer lc ON lc.order_hk = o.order_hk
        LEFT JOIN cur_sat_customer c ON c.customer_hk = lc.customer_hk
        LEFT JOIN lnk_order_employee le ON le.order_hk = o.order_hk
        LEFT JOIN sat_employee e ON e.employee_hk = le.employee_hk
        LEFT JOIN order_items i ON i.order_hk = o.order_hk""",
    "mart_product_sales": """SELECT product_id, product_code, product_name, category, list_price,
        standard_cost, count(DISTINCT order_hk) AS orders_count, sum(quantity) AS total_quantity_sold,
        cast(sum(quantity * unit_price * (100 - discount)) AS DOUBLE) / 100 AS total_revenue,
        cast(sum(quantity * (unit_price - standard_cost)) AS DOUBLE) AS estimated_margin
        FROM hub_product JOIN sat_product USING (product_hk) LEFT JOIN order_lines USING (product_hk)
        GROUP BY product_id, product_code, product_name, category, list_price, standard_cost""",
}


def check(body: str, **extra: str) -> str:
    parts = {**PARTS, **extra}
    wanted: set[str] = set()

    def visit(text: str, leaving_out: str = "") -> None:
        for word in set(re.findall(r"\w+", text)) & parts.keys():
            if word not in wanted and word != leaving_out:
                wanted.add(word)
                visit(parts[word], word)

    visit(body)
    named = [f"{name} AS ({sql})" for name, sql in parts.items() if name in wanted]
    return (f"WITH {', '.join(named)} " if named else "") + body
