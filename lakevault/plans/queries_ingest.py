"""Sources, dispositions, cursor, stored tables and streams as registered queries.

Each writes files or tables derived from the given tables into a fresh work folder and reads them
back.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.staging import stage
from lakevault.operators.vault import HubSpec, count_tables, key_rows
from lakevault.plans import build, model, raw
from lakevault.plans.checks import PARTS, _current
from lakevault.plans.queries_quality import NOW, _SUITE_SQL
from lakevault.plans.queries_time import AS_OF
from lakevault.plans.registry import query
from lakevault.session import work_folder
from lakevault.sources import files
from lakevault.sources.ingest import IngestSpec, from_config, ingest, last_cursor
from lakevault.streaming import streams


# --- file sources ------------------------------------------------------------------------------

@query("src_csv_roundtrip", "SELECT * FROM raw_orders")
def src_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders (with missing shipping dates and employees) through a bulk CSV file."""
    orders = raw.orders(spark, sf)
    folder = work_folder(spark, "csv")
    files.write_drops(orders, folder, "csv")
    return files.read_bulk_csv(spark, folder, orders.schema)


def _register_drop(fmt: str, glob: str, body: str) -> None:
    @query(f"src_files_{fmt}", body)
    def read(spark: SparkSession, sf: str) -> DataFrame:
        events = raw.given(spark, sf, "events")
        folder = work_folder(spark, fmt)
        files.write_drops(events, folder, fmt)
        return files.read_drops(spark, folder, glob, schema=events.schema if fmt != "parquet" else None,
                                fmt="jsonl" if fmt == "jsonl" else None)


_register_drop("csv", "*.csv", "SELECT * FROM events")
_register_drop("jsonl", "part-*.json", "SELECT * FROM events")
_register_drop("parquet", "*.parquet", "SELECT * FROM events")


@query("seed_load", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def seed_load(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV seed with inferred types, loaded twice: the second run replaces the first."""
    lake = build.new_lake(spark, sf)
    nations = raw.given(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    folder = work_folder(spark, "seed")
    files.write_drops(nations, folder, "csv")
    for _ in range(2):
        files.load_seed(lake, "seed_nation", folder)
    return lake.read("staging", "seed_nation")


# --- dispositions ----------------------------------------------------------------------------------

def _drop_spec(path: str, name: str, disposition: str, **more) -> IngestSpec:
    return from_config({"name": name, "type": "filesystem", "path": path, "file_glob": "*.parquet",
                        "write_disposition": disposition, "target": {"schema": "raw"}, **more})


def _deliver(lake, name: str, disposition: str, deliveries: list[DataFrame], **more) -> DataFrame:
    """Drop each delivery into a folder of its own and ingest it; returns the table."""
    for number, delivery in enumerate(deliveries, 1):
        folder = f"{lake.root}/drops/{name}/{number}"
        delivery.write.parquet(folder)
        ingest(lake, _drop_spec(folder, name, disposition, **more), f"load-{number}")
    return lake.read("raw", name).drop("_load_id")


@query("ingest_append", "SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers_delta")
def ingest_append(spark: SparkSession, sf: str) -> DataFrame:
    return _deliver(build.new_lake(spark, sf), "customers", "append",
                    [raw.customers(spark, sf), raw.customers_delta(spark, sf)])


@query("ingest_replace", "SELECT * FROM raw_customers_batch3")
def ingest_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _deliver(build.new_lake(spark, sf), "customers", "replace",
                    [raw.customers(spark, sf), raw.customers_batch3(spark, sf)])


@query("ingest_merge", "SELECT * FROM raw_customers_after_delta")
def ingest_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _deliver(build.new_lake(spark, sf), "customers", "merge",
                    [raw.customers(spark, sf), raw.customers_delta(spark, sf)], primary_key="id")


@query("ingest_merge_composite", """SELECT * REPLACE (CASE WHEN order_detail_status = 'O' THEN CAST(0 AS DECIMAL(5,2))
        ELSE discount END AS discount) FROM raw_order_details UNION ALL SELECT * FROM raw_order_details_delta""")
def ingest_merge_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Every open line is delivered again without its discount, together with the new lines."""
    details = raw.order_details(spark, sf)
    again = details.where("order_detail_status = 'O'").withColumn(
        "discount", F.lit("0.00").cast("decimal(5,2)"))
    return _deliver(build.new_lake(spark, sf), "order_details", "merge",
                    [details, again.unionByName(raw.order_details_delta(spark, sf))],
                    primary_key=["order_id", "product_id", "line_number"])


@query("raw_upsert", "SELECT * FROM raw_orders UNION ALL SELECT * FROM raw_orders_delta")
def raw_upsert(spark: SparkSession, sf: str) -> DataFrame:
    lake = build.new_lake(spark, sf)
    lake.merge("raw", "orders", raw.orders(spark, sf), ["id"])
    lake.merge("raw", "orders", raw.orders_delta(spark, sf), ["id"])
    return lake.read("raw", "orders")


@query("ingest_schema_drift", """SELECT event_id, ts, user_id, NULL AS event_type, NULL AS value FROM events
        WHERE ts < TIMESTAMP '2024-01-16 00:00:00' UNION ALL
        SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""")
def ingest_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery brings two more columns."""
    events = raw.given(spark, sf, "events")
    early, late = (events.where(f"ts {op} TIMESTAMP_NTZ '2024-01-16 00:00:00'") for op in ("<", ">="))
    return _deliver(build.new_lake(spark, sf), "events", "append", [
        early.select("event_id", "ts", "user_id"), late.select("event_id", "ts", "user_id", "event_type", "value"),
    ])


_THIRD, _TWO_THIRDS, _FAR = 300, 600, 5_000_000_000
_WIDE = f"""SELECT event_id, CASE WHEN event_id < {_THIRD} THEN user_id ELSE user_id + {_FAR} END AS user_id,
        CASE WHEN event_id < {_TWO_THIRDS} THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS seen,
        CAST(CASE WHEN event_id < {_THIRD} THEN CAST(user_id AS DECIMAL(12,4)) ELSE CAST(event_id AS DECIMAL(12,4)) / 8 END AS DECIMAL(14,4)) AS amount
        FROM events"""


@query("ingest_type_widening", _WIDE)
def ingest_type_widening(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries: the cursor and a number grow from int to bigint, an amount gets more digits and
    decimals, a date becomes a time. The cursor goes on over the change."""
    events = raw.given(spark, sf, "events")
    first = events.where(f"event_id < {_THIRD}").selectExpr(
        "CAST(event_id AS INT) AS event_id", "CAST(user_id AS INT) AS user_id", "CAST(ts AS DATE) AS seen", "CAST(user_id AS DECIMAL(9,2)) AS amount")
    second = events.where(f"event_id < {_TWO_THIRDS}").selectExpr(
        "event_id", f"user_id + {_FAR} AS user_id", "CAST(ts AS DATE) AS seen", "CAST(event_id / 8.0D AS DECIMAL(12,4)) AS amount")
    third = events.selectExpr("event_id", f"user_id + {_FAR} AS user_id", "ts AS seen", "CAST(event_id / 8.0D AS DECIMAL(12,4)) AS amount")
    second = second.where(f"event_id >= {_THIRD}")
    third = third.where(f"event_id >= {_TWO_THIRDS}")
    wide = _deliver(build.new_lake(spark, sf), "events", "append", [first, second, third], incremental={"cursor": "event_id"})
    return wide.withColumn("amount", F.col("amount").cast("decimal(14,4)"))


@query("ingest_type_conflict", f"""SELECT event_id, CASE WHEN event_id < {_THIRD} OR event_id >= {_TWO_THIRDS} THEN value END AS value,
        CASE WHEN event_id >= {_THIRD} AND event_id < {_TWO_THIRDS} THEN event_type END AS value__v_string FROM events""")
def ingest_type_conflict(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers, then texts, then numbers again under one name: the texts go to a column of their own."""
    events = raw.given(spark, sf, "events")
    return _deliver(build.new_lake(spark, sf), "events", "append", [
        events.where(f"event_id < {_THIRD}").select("event_id", "value"),
        events.where(f"event_id >= {_THIRD} AND event_id < {_TWO_THIRDS}").select("event_id", F.col("event_type").alias("value")),
        events.where(f"event_id >= {_TWO_THIRDS}").select("event_id", "value")])


@query("ingest_merge_null_key", """SELECT CASE WHEN id % 7 = 0 THEN NULL ELSE id END AS id, nation_id, count(*) AS customers, 'second' AS delivery
        FROM raw_customers GROUP BY 1, 2 UNION ALL SELECT CASE WHEN id % 7 = 0 THEN NULL ELSE id END, nation_id + 100, count(*), 'first'
        FROM raw_customers GROUP BY 1, 2""")
def ingest_merge_null_key(spark: SparkSession, sf: str) -> DataFrame:
    """Keys with NULL parts are merged like others: the second delivery replaces the first one's row."""
    counted = raw.customers(spark, sf).groupBy(F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"), "nation_id").agg(F.count(F.lit(1)).alias("customers"))
    first = counted.withColumns({"customers": F.col("customers") + 1, "delivery": F.lit("first")})
    others = counted.withColumns({"nation_id": F.col("nation_id") + 100, "delivery": F.lit("first")})
    return _deliver(build.new_lake(spark, sf), "customers", "merge", [first.unionByName(others), counted.withColumn("delivery", F.lit("second"))],
                    primary_key=["id", "nation_id"])


@query("merge_compacted", "SELECT * FROM raw_customers_after_delta")
def merge_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Folded after the delta, delivered in part again in an older state, folded, and brought up to date."""
    lake = build.new_lake(spark, sf)
    delta = raw.customers_delta(spark, sf)
    lake.merge("raw", "customers", raw.customers(spark, sf), ["id"])
    lake.merge("raw", "customers", delta, ["id"])
    lake.fold("raw", "customers")
    lake.merge("raw", "customers", raw.customers(spark, sf).where("balance < 0"), ["id"])
    lake.fold("raw", "customers")
    lake.merge("raw", "customers", delta, ["id"])
    return lake.read("raw", "customers")


# --- cursor ------------------------------------------------------------------------------------------

_CURSOR = {"primary_key": "event_id", "incremental": {"cursor": "ts", "initial_value": "2024-01-03"}}
_BREAK = "2024-01-20 00:00:00"


def _two_loads(spark: SparkSession, sf: str):
    """First what happened before the break, then the whole log; the cursor skips what is loaded."""
    lake = build.new_lake(spark, sf)
    events = raw.given(spark, sf, "events")
    table = _deliver(lake, "events", "merge",
                     [events.where(f"ts < TIMESTAMP_NTZ '{_BREAK}'"), events], **_CURSOR)
    return lake, table


@query("ingest_incremental", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00'")
def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _two_loads(spark, sf)[1]


@query("ingest_cursor_state", f"""SELECT 'events' AS pipeline, 'events' AS table_name, 'load-1' AS load_id,
        CAST(max(ts) AS VARCHAR) AS cursor_value FROM events WHERE ts < TIMESTAMP '{_BREAK}'
        UNION ALL SELECT 'events', 'events', 'load-2', CAST(max(ts) AS VARCHAR) FROM events""")
def ingest_cursor_state(spark: SparkSession, sf: str) -> DataFrame:
    loads = _two_loads(spark, sf)[0].read("meta", "loads")
    return loads.select("pipeline", "table_name", "load_id", "cursor_value")


@query("ingest_load_log", f"""SELECT 'events' AS pipeline, 'raw' AS dataset, 'events' AS table_name, 'load-1' AS load_id,
        count(*) AS row_count, 'merge' AS write_disposition FROM events
        WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '{_BREAK}'
        UNION ALL SELECT 'events', 'raw', 'events', 'load-2', count(*), 'merge' FROM events
        WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{_BREAK}')""")
def ingest_load_log(spark: SparkSession, sf: str) -> DataFrame:
    """The second load reads from the first one's last row on; that row is loaded twice and merged."""
    return _two_loads(spark, sf)[0].read("meta", "loads").drop("cursor_value", "cursor_type")


def _append_spec(folder: str) -> IngestSpec:
    return _drop_spec(folder, "events", "append", **_CURSOR)


@query("ingest_append_incremental", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00'")
def ingest_append_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """One drop appended twice, and once more in full: rows at the cursor are stored once."""
    lake = build.new_lake(spark, sf)
    events = raw.given(spark, sf, "events")
    early = events.where(f"ts < TIMESTAMP_NTZ '{_BREAK}'")
    return _deliver(lake, "events", "append", [early, early, events, events], **_CURSOR)


@query("ingest_retry", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00'")
def ingest_retry(spark: SparkSession, sf: str) -> DataFrame:
    """Both loads die after writing and before their log row, and are repeated under their load ids."""
    lake = build.new_lake(spark, sf)
    events = raw.given(spark, sf, "events")
    for number, delivery in enumerate((events.where(f"ts < TIMESTAMP_NTZ '{_BREAK}'"), events), 1):
        folder = f"{lake.root}/drops/retry/{number}"
        delivery.write.parquet(folder)
        spec = _append_spec(folder)
        for append in (_refused, None):
            try:
                lake.append = append or type(lake).append.__get__(lake)
                ingest(lake, spec, f"load-{number}")
            except ConnectionError:
                continue
    return lake.read("raw", "events").drop("_load_id")


def _refused(layer: str, table: str, df: DataFrame, **kwargs) -> None:
    raise ConnectionError(f"died before {layer}.{table}")


@query("ingest_cursor_many_loads", """SELECT 'load-' || (8 + n) AS load_id, CAST(max(ts) AS VARCHAR) AS cursor_value,
        (SELECT CAST(max(ts) AS VARCHAR) FROM events WHERE ts < TIMESTAMP '2024-01-26 00:00:00') AS last_cursor
        FROM events, range(1, 4) r(n) WHERE ts < TIMESTAMP '2024-01-08 00:00:00' + to_days(CAST(6 * n AS INTEGER)) GROUP BY n""")
def ingest_cursor_many_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Load ids 9 to 11 do not sort as text; the cursor is the highest value all the same."""
    lake = build.new_lake(spark, sf)
    events = raw.given(spark, sf, "events")
    for number, until in ((9, "2024-01-14"), (10, "2024-01-20"), (11, "2024-01-26")):
        folder = f"{lake.root}/drops/many/{number}"
        events.where(f"ts < TIMESTAMP_NTZ '{until} 00:00:00'").write.parquet(folder)
        ingest(lake, _append_spec(folder), f"load-{number}")
    last = last_cursor(lake, "events", "events")
    return lake.read("meta", "loads").select("load_id", "cursor_value", F.lit(last).alias("last_cursor"))


# --- stored tables -------------------------------------------------------------------------------------

@query("mat_view_table_equal", """SELECT 'view' AS kind, count(*) AS row_count, count(DISTINCT order_hk) AS keys FROM stg_orders
        UNION ALL SELECT 'table', count(*), count(DISTINCT order_hk) FROM stg_orders
        UNION ALL SELECT 'incremental', count(*), count(DISTINCT order_hk) FROM stg_orders""")
def mat_view_table_equal(spark: SparkSession, sf: str) -> DataFrame:
    """The same model stored as a view, a table and an insert-only table loaded twice."""
    lake = build.new_lake(spark, sf)
    lake.merge("raw", "orders", raw.orders(spark, sf), ["id"])
    staged = stage(lake.read("raw", "orders"), model.STAGING["orders"])
    lake.replace("staging", "orders_table", staged)
    hub = model.HUBS["hub_order"]
    for _ in range(2):
        lake.append("raw_vault", hub.name, key_rows(staged, lake.read_or_none("raw_vault", hub.name), hub),
                    bucket_by=hub.pk)
    kinds = {"view": staged, "table": lake.read("staging", "orders_table"),
             "incremental": lake.read("raw_vault", hub.name)}
    out = None
    for kind, df in kinds.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("order_hk").alias("keys")).select(
            F.lit(kind).alias("kind"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("dq_persist", f"""SELECT *, 'run-1' AS run_id, TIMESTAMP '{NOW}' AS run_at FROM suite_rows""",
       suite_rows=_SUITE_SQL)
def dq_persist(spark: SparkSession, sf: str) -> DataFrame:
    """Test results of the stored warehouse, appended to the result log (a repeated run adds nothing)."""
    lake = build.warehouse(spark, sf, AS_OF)
    for _ in range(2):
        stored = build.run_tests(lake, NOW, "run-1")
    return stored.drop("run_date")


def after_delta() -> dict[str, str]:
    """SQL of the vault and marts once the delta is in: the same definitions over all rows."""
    grown = ("hub_customer", "hub_order", "lnk_order_customer", "lnk_order_employee", "lnk_order_product", "sat_customer", "sat_order", "sat_order_detail")
    same = ("hub_employee", "hub_product", "sat_employee", "sat_product")
    parts = {f"full_{n}": f"SELECT * FROM {n} UNION ALL SELECT * FROM new_{n}" for n in grown} | {f"full_{n}": f"SELECT * FROM {n}" for n in same}
    for n, pk in (("sat_customer", "customer_hk"), ("sat_order", "order_hk"), ("sat_order_detail", "order_product_hk")):
        parts[f"cur_full_{n}"] = _current(f"full_{n}", pk)
    renamed = {n: f"full_{n}" for n in (*grown, *same)} | {"cur_sat_customer": "cur_full_sat_customer", "sat_order": "cur_full_sat_order",
                                                          "sat_order_detail": "cur_full_sat_order_detail"}
    renamed |= {n: f"full_{n}" for n in ("order_lines", "order_items")}
    for n in ("order_lines", "order_items", "mart_revenue_per_customer", "mart_order_overview", "mart_product_sales"):
        parts[f"full_{n}"] = re.sub(r"\w+", lambda m: renamed.get(m[0], m[0]), PARTS[n])
    return parts


def _register_after_delta(name: str, mart: str) -> None:
    @query(name, f"SELECT * FROM full_{mart}", **after_delta())
    def read(spark: SparkSession, sf: str) -> DataFrame:
        """The mart that a delta run has brought up to date; nothing is built anew."""
        return build.changed_warehouse(spark, sf, AS_OF).read("mart", mart)


for _mart in ("revenue_per_customer", "order_overview", "product_sales"):
    _register_after_delta(f"mart_{_mart.replace('_per_customer', '')}_after_delta", f"mart_{_mart}")


_DIGESTED = {
    "hub_customer": "customer_hk, customer_id", "hub_order": "order_hk, order_id", "lnk_order_customer": "order_customer_hk, order_hk, customer_hk",
    "lnk_order_product": "order_product_hk, order_hk, product_hk", "sat_customer": "customer_hk, hashdiff", "sat_order": "order_hk, hashdiff",
    "sat_order_detail": "order_product_hk, hashdiff"}


@query("vault_after_delta", " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, count(*) AS row_count, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {columns}, load_datetime)), 1, 12) AS BIGINT)) AS DECIMAL(38,0)) AS digest
    FROM full_{n}""" for n, columns in _DIGESTED.items()), **after_delta())
def vault_after_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and contents (a sum of row hashes) of the stored vault after a delta run."""
    lake = build.changed_warehouse(spark, sf, AS_OF)
    out = None
    for name, columns in _DIGESTED.items():
        row = F.md5(F.concat_ws("|", *columns.split(", "), F.col("load_datetime").cast("string")))
        digest = F.sum(F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(28,0)"))
        part = lake.read("raw_vault", name).agg(F.count(F.lit(1)).alias("row_count"), digest.alias("digest")).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


_ALL_COUNTS = {
    "raw.customers": "raw_customers_after_delta", "raw.employees": "raw_employees", "raw.products": "raw_products",
    **{f"raw.{n}": f"(SELECT 1 FROM raw_{n} UNION ALL SELECT 1 FROM raw_{n}_delta)" for n in ("orders", "order_details")},
    **{f"raw_vault.{n}": f"(SELECT 1 FROM {n} UNION ALL SELECT 1 FROM new_{n})" for n in (
        "hub_customer", "hub_order", "lnk_order_customer", "lnk_order_employee", "lnk_order_product",
        "sat_customer", "sat_order", "sat_order_detail")},
    **{f"raw_vault.{n}": n for n in ("hub_employee", "hub_product", "sat_employee", "sat_product")},
    "raw_vault.pit_customer": f"(SELECT 1 FROM all_hub_customer, range({len(AS_OF)}))",
    "raw_vault.pit_order": f"(SELECT 1 FROM (SELECT 1 FROM hub_order UNION ALL SELECT 1 FROM new_hub_order) o, range({len(AS_OF)}))",
    "mart.mart_revenue_per_customer": """(SELECT DISTINCT customer_hk FROM
        (SELECT * FROM lnk_order_customer UNION ALL SELECT * FROM new_lnk_order_customer) JOIN
        (SELECT * FROM lnk_order_product UNION ALL SELECT * FROM new_lnk_order_product) USING (order_hk))""", "mart.mart_product_sales": "hub_product",
    "mart.mart_order_overview": "(SELECT 1 FROM hub_order UNION ALL SELECT 1 FROM new_hub_order)",
}


@query("build_end_to_end", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in _ALL_COUNTS.items()))
def build_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Raw, vault, point-in-time tables and marts stored from the first delivery, then the delta."""
    lake = build.new_lake(spark, sf)
    build.build_all(lake, spark, sf, AS_OF)
    build.apply_delta(lake, spark, sf, AS_OF)
    return lake.counts(["raw", "raw_vault", "mart"])


# --- streams -----------------------------------------------------------------------------------------------

@query("stream_file_ingest", "SELECT * FROM events")
def stream_file_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries into a watched folder; each stream run takes only the files that are new."""
    folder = work_folder(spark, "stream")
    events = raw.given(spark, sf, "events")
    for op in ("<", ">="):
        events.where(f"ts {op} TIMESTAMP_NTZ '{_BREAK}'").write.mode("append").parquet(f"{folder}/in")
        stream = streams.read_table_stream(spark, f"{folder}/in", events.schema)
        streams.ingest_files(stream, f"{folder}/out", f"{folder}/progress")
    return spark.read.parquet(f"{folder}/out")


_HUB_USER = HubSpec("hub_user", "user_hk", "user_id", "user_states")


@query("stream_vault_load", """SELECT 'hub_user' AS table_name, count(DISTINCT user_hk) AS row_count FROM stg_user_states
        UNION ALL SELECT 'sat_user', count(*) FROM (SELECT hashdiff, lag(hashdiff) OVER (PARTITION BY user_hk
            ORDER BY load_datetime, hashdiff DESC) AS before FROM stg_user_states) WHERE before IS NULL OR before <> hashdiff""")
def stream_vault_load(spark: SparkSession, sf: str) -> DataFrame:
    """The event log in two deliveries, in time order, as micro-batches into a hub and a satellite."""
    lake = build.new_lake(spark, sf)
    states = raw.user_states(spark, sf)
    for op in ("<", ">="):
        states.where(f"change_date {op} TIMESTAMP_NTZ '{_BREAK}'").write.mode("append").parquet(f"{lake.root}/in")
        stream = streams.read_table_stream(spark, f"{lake.root}/in", states.schema)
        streams.load_vault_stream(stream, lake, model.STAGING["user_states"], [_HUB_USER, model.USER_SAT],
                                  f"{lake.root}/progress")
    return count_tables({n: lake.read("raw_vault", n) for n in ("hub_user", "sat_user")})


@query("stream_dedup", "SELECT * FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log delivered twice: every event is stored once, however late it comes."""
    lake = build.new_lake(spark, sf)
    events = raw.given(spark, sf, "events")
    events.unionByName(events).write.parquet(f"{lake.root}/in")
    stream = streams.read_table_stream(spark, f"{lake.root}/in", events.schema)
    streams.merge_stream(stream, lake, "raw", "events", ["event_id"], "ts", f"{lake.root}/progress")
    return lake.read("raw", "events")


@query("stream_merge", "SELECT * REPLACE (CASE WHEN event_type = 'error' THEN 0 ELSE value END AS value) FROM events")
def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A second delivery brings all errors again with a corrected value."""
    lake = build.new_lake(spark, sf)
    events = raw.given(spark, sf, "events")
    fixed = events.where("event_type = 'error'").withColumn("value", F.lit(0.0))
    for delivery in (events, fixed):
        delivery.write.mode("append").parquet(f"{lake.root}/in")
        stream = streams.read_table_stream(spark, f"{lake.root}/in", events.schema)
        streams.merge_stream(stream, lake, "raw", "events", ["event_id"], "ts", f"{lake.root}/progress")
    return lake.read("raw", "events")
