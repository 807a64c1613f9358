"""Point-in-time, as-of, access-view and historised-staging queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.functions.hashing import hash_key, row_hash
from lakevault.operators import history as scd
from lakevault.operators import quality
from lakevault.operators import vault as ops
from lakevault.operators.access import VaultModel, access_view, store_access_view
from lakevault.operators.ordered import asof_join, interval_join
from lakevault.operators.pit import build_pit
from lakevault.operators.staging import cast_interface, stage
from lakevault.plans import build, model, raw, suite
from lakevault.plans.checks import diff_sql, key_sql, rowhash_sql
from lakevault.plans.initial import Packed, Vault
from lakevault.plans.registry import query

AS_OF = [datetime(2016, 1, 1), datetime(2016, 6, 1), datetime(2024, 1, 1), datetime(2024, 2, 1)]
ORDER_DATES = [datetime(1997 + i // 12, i % 12 + 1, 1) for i in range(24)]
USER_DATES = [datetime(2024, 1, d) for d in (1, 8, 15, 22, 29)]


def _ntz(value: datetime):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _values(dates) -> str:
    return "SELECT unnest([" + ", ".join(f"TIMESTAMP '{d}'" for d in dates) + "]) AS as_of_date"


def _pit_sql(hub: str, pk: str, sats: dict[str, str], dates) -> str:
    columns, joins = [], []
    for name, sat in sats.items():
        columns.append(f"coalesce({name}_v.{pk}, repeat('0', 32)) AS {name}_pk, "
                       f"coalesce({name}_v.load_datetime, TIMESTAMP '1900-01-01 00:00:00') AS {name}_ldts")
        joins.append(f"ASOF LEFT JOIN (SELECT DISTINCT {pk}, load_datetime FROM {sat}) {name}_v "
                     f"ON {name}_v.{pk} = s.{pk} AND s.as_of_date >= {name}_v.load_datetime")
    return (f"SELECT s.{pk}, s.as_of_date, {', '.join(columns)} FROM "
            f"(SELECT {pk}, as_of_date FROM {hub}, ({_values(dates)})) s {' '.join(joins)}")


# --- point in time and as-of ----------------------------------------------------------------

@query("src_asof_seed", """SELECT unnest(generate_series(min(date_trunc('month', o_orderdate)),
        max(o_orderdate), INTERVAL 1 MONTH)) AS as_of_date FROM orders""")
def src_asof_seed(spark: SparkSession, sf: str) -> DataFrame:
    """One as-of date per month the orders span."""
    first = F.date_trunc("month", F.min("o_orderdate")).cast("timestamp_ntz")
    months = F.sequence(first, F.max("o_orderdate"), F.expr("interval 1 month"))
    return raw.given(spark, sf, "orders").agg(months.alias("m")).select(F.explode("m").alias("as_of_date"))


@query("pit_incremental", _pit_sql("all_hub_customer", "customer_hk", {"sat_customer": "all_sat_customer"}, AS_OF))
def pit_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table after a delta run: pointers moved, keys and a date added, the rest left as it was."""
    return build.changed_warehouse(spark, sf, AS_OF).read("raw_vault", "pit_customer")


@query("pit_customer", _pit_sql("all_hub_customer", "customer_hk", {"sat_customer": "all_sat_customer"}, AS_OF))
def pit_customer(spark: SparkSession, sf: str) -> DataFrame:
    vault = Vault(spark, sf, with_delta=True)
    return build_pit(vault["hub_customer"], "customer_hk", {"sat_customer": vault["sat_customer"]}, AS_OF)


@query("pit_order", _pit_sql("hub_order", "order_hk", {"sat_order": "sat_order"}, ORDER_DATES))
def pit_order(spark: SparkSession, sf: str) -> DataFrame:
    vault = Vault(spark, sf)
    return build_pit(vault["hub_order"], "order_hk", {"sat_order": vault["sat_order"]}, ORDER_DATES)


USER_HOURS = [datetime(2024, 1, 1) + timedelta(hours=6 * i) for i in range(120)]

_USER_PARTS = {
    "hub_user": f"SELECT DISTINCT user_hk FROM stg_user_states",
    "sat_activity": "SELECT user_hk, load_datetime FROM stg_user_states",
    "sat_purchase": "SELECT user_hk, load_datetime FROM stg_user_states WHERE state = 'purchase'",
}


@query("pit_multi_sat", _pit_sql(
    "hub_user", "user_hk", {"activity": "sat_activity", "purchase": "sat_purchase"}, USER_DATES), **_USER_PARTS)
def pit_multi_sat(spark: SparkSession, sf: str) -> DataFrame:
    """Two satellites, many versions per key, one PIT."""
    users = model.staged(spark, sf, "user_states")
    return build_pit(
        users.select("user_hk").distinct(), "user_hk",
        {"activity": users, "purchase": users.where("state = 'purchase'")}, USER_DATES)


@query("pit_many_dates", _pit_sql("hub_user", "user_hk", {"activity": "sat_activity"}, USER_HOURS), **_USER_PARTS)
def pit_many_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Four dates a day over the whole log, one pass over the satellite."""
    users = model.staged(spark, sf, "user_states")
    return build_pit(users.select("user_hk").distinct(), "user_hk", {"activity": users}, USER_HOURS)


@query("asof_join", """SELECT p.event_id, p.user_id, p.ts, s.state, s.load_datetime AS state_since
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT user_id, state, load_datetime FROM stg_user_states WHERE state <> 'purchase') s
        ON s.user_id = p.user_id AND p.ts >= s.load_datetime""")
def asof(spark: SparkSession, sf: str) -> DataFrame:
    """What each buyer did last before buying."""
    bought = raw.given(spark, sf, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    states = raw.user_states(spark, sf).where("state <> 'purchase'").select(
        F.col("id").alias("user_id"), "state", F.col("change_date").alias("state_since"))
    return asof_join(bought, states, ["user_id"], "ts", "state_since", ["state", "state_since"],
                     tie_break=[F.col("state")], grain="day")


# --- access views -----------------------------------------------------------------------------

VAULT_MODEL = VaultModel(model.HUBS, model.LINKS, model.SATS, model.PITS)

_CUSTOMER = "name, segment, nation_id, balance"
_ORDER = "order_date, shipped_date, shipping_fee, payment_type, order_status"
_DETAIL = "quantity, unit_price, discount, order_detail_status, date_allocated"
_PRODUCT = "product_code, product_name, category, size, list_price, standard_cost"


@query("access_single", f"SELECT customer_id, {_CUSTOMER} FROM hub_customer JOIN cur_sat_customer USING (customer_hk)")
def access_single(spark: SparkSession, sf: str) -> DataFrame:
    return access_view(VAULT_MODEL, Vault(spark, sf), ["sat_customer"])


@query("access_multi_hub", f"""SELECT customer_id, product_id, order_id, {_CUSTOMER}, {_PRODUCT}, {_ORDER}
        FROM hub_customer JOIN cur_sat_customer USING (customer_hk) JOIN lnk_order_customer USING (customer_hk)
        JOIN hub_order USING (order_hk) JOIN sat_order USING (order_hk)
        JOIN lnk_order_product USING (order_hk) JOIN hub_product USING (product_hk)
        JOIN sat_product USING (product_hk)""")
def access_multi_hub(spark: SparkSession, sf: str) -> DataFrame:
    """Customer and product are connected only over the order hub, whatever the order of choice."""
    return access_view(VAULT_MODEL, Packed(Vault(spark, sf)), ["sat_customer", "sat_product", "sat_order"])


@query("access_link_sat", f"""SELECT order_id, product_id, {_DETAIL}, {_ORDER}
        FROM hub_order JOIN sat_order USING (order_hk) JOIN lnk_order_product USING (order_hk)
        JOIN sat_order_detail USING (order_product_hk) JOIN hub_product USING (product_hk)""")
def access_link_sat(spark: SparkSession, sf: str) -> DataFrame:
    vault = Vault(spark, sf, dealt=("lnk_order_product", "sat_order_detail"))
    return access_view(VAULT_MODEL, Packed(vault), ["sat_order_detail", "sat_order"])


_PIT_DATE = datetime(2024, 1, 1)


class _WithPits:
    """A vault that also answers for its point-in-time tables."""

    def __init__(self, vault: Vault, dates):
        self.vault, self.dates = vault, dates

    def __getitem__(self, name: str) -> DataFrame:
        if name not in model.PITS:
            return self.vault[name]
        hub, sats = model.PITS[name]
        return build_pit(self.vault[hub], model.HUBS[hub].pk, {s: self.vault[s] for s in sats}, self.dates)


@query("access_pit_view", f"""SELECT customer_id, {_CUSTOMER} FROM all_hub_customer JOIN (
        SELECT * FROM all_sat_customer WHERE load_datetime <= TIMESTAMP '2024-01-01 00:00:00')
        USING (customer_hk)""")
def access_pit_view(spark: SparkSession, sf: str) -> DataFrame:
    """The customers as they were before the delta."""
    tables = _WithPits(Vault(spark, sf, with_delta=True), AS_OF)
    return access_view(VAULT_MODEL, tables, ["sat_customer"], as_of=_ntz(_PIT_DATE))


@query("access_as_of_any_date", f"""SELECT customer_id, {_CUSTOMER} FROM all_hub_customer JOIN (
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_hk ORDER BY load_datetime DESC, hashdiff) AS rn
        FROM all_sat_customer WHERE load_datetime <= TIMESTAMP '2024-01-20 00:00:00') WHERE rn = 1) USING (customer_hk)""")
def access_as_of_any_date(spark: SparkSession, sf: str) -> DataFrame:
    """A date the point-in-time table does not hold: the versions themselves are asked."""
    tables = _WithPits(Vault(spark, sf, with_delta=True), AS_OF)
    return access_view(VAULT_MODEL, tables, ["sat_customer"], as_of=_ntz(datetime(2024, 1, 20)))


@query("access_stored_view", f"SELECT customer_id, {_CUSTOMER} FROM hub_customer JOIN cur_sat_customer USING (customer_hk)")
def access_stored_view(spark: SparkSession, sf: str) -> DataFrame:
    """An access view that stays, by its name."""
    lake = build.new_lake(spark, sf)
    return lake.read("mart", store_access_view(lake, VAULT_MODEL, Vault(spark, sf), ["sat_customer"]))


@query("access_extra_table", f"""SELECT employee_id, name, nation_id, balance, n_name, n_regionkey
        FROM hub_employee JOIN sat_employee USING (employee_hk) LEFT JOIN nation ON n_nationkey = nation_id""")
def access_extra_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table outside the vault, joined on a condition."""
    nations = raw.given(spark, sf, "nation").withColumnRenamed("n_nationkey", "nation_id")
    return access_view(VAULT_MODEL, Vault(spark, sf), ["sat_employee"],
                       extra={"nation": (nations, ["nation_id"])})


class _WithNations:
    """The vault with one hub and two links more: the nations of customers and of products."""

    LINKS = {"lnk_customer_nation": ("customer", "customer_hk", "c_custkey", "c_nationkey"), "lnk_product_nation": ("part", "product_hk", "p_partkey", "p_size")}

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf, self.vault = spark, sf, Vault(spark, sf)

    def __getitem__(self, name: str) -> DataFrame:
        if name == "hub_nation":
            nations = raw.given(self.spark, self.sf, "nation")
            return nations.select(hash_key(nations, ["n_nationkey"]).alias("nation_hk"), F.col("n_nationkey").alias("nation_id"))
        if name not in self.LINKS:
            return self.vault[name]
        table, pk, key, nation = self.LINKS[name]
        rows = raw.given(self.spark, self.sf, table).withColumn("n", F.col(nation) % 25)
        return rows.select(hash_key(rows, [key, "n"]).alias(f"{name}_hk"), hash_key(rows, [key]).alias(pk), hash_key(rows, ["n"]).alias("nation_hk"))


_NATION_MODEL = VaultModel(
    {"hub_nation": ops.HubSpec("hub_nation", "nation_hk", "nation_id", "nation"), **model.HUBS},
    {**{n: ops.LinkSpec(n, f"{n}_hk", (pk, "nation_hk"), t) for n, (t, pk, *_) in _WithNations.LINKS.items()}, **model.LINKS}, model.SATS)


@query("access_steiner", """SELECT customer_id, product_id, employee_id, c.segment, product_code, e.name AS sat_employee_name
        FROM lnk_order_customer JOIN lnk_order_product USING (order_hk) JOIN lnk_order_employee USING (order_hk)
        JOIN hub_customer USING (customer_hk) JOIN cur_sat_customer c USING (customer_hk)
        JOIN hub_product USING (product_hk) JOIN sat_product USING (product_hk)
        JOIN hub_employee USING (employee_hk) JOIN sat_employee e USING (employee_hk)""")
def access_steiner(spark: SparkSession, sf: str) -> DataFrame:
    """Customer and product are as near over the nation as over the order; with the employee, the order is
    the smallest way for all three, whatever was chosen first."""
    view = access_view(_NATION_MODEL, Packed(_WithNations(spark, sf)), ["sat_customer", "sat_product", "sat_employee"])
    return view.select("customer_id", "product_id", "employee_id", "segment", "product_code", "sat_employee_name")


_KINDS = [("hub", n, h.pk, (), 0) for n, h in model.HUBS.items()]
_KINDS += [("link", n, l.pk, [f"hub_{fk.removesuffix('_hk')}" for fk in l.fks], len(l.fks)) for n, l in model.LINKS.items()]
_KINDS += [("satellite", n, s.pk, [p for p, of in (model.HUBS | model.LINKS).items() if of.pk == s.pk], len(s.payload)) for n, s in model.SATS.items()]
_KINDS += [("pit", n, model.HUBS[h].pk, [h], len(s)) for n, (h, s) in model.PITS.items()]


@query("vault_catalog", " UNION ALL ".join(
    f"SELECT '{k}' AS kind, '{n}' AS name, '{pk}' AS pk, '{','.join(parents)}' AS parents, {c} AS n_columns, count(*) AS row_count "
    f"FROM {f'{parents[0]}, range({len(AS_OF)})' if k == 'pit' else n}" for k, n, pk, parents, c in _KINDS))
def vault_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The inventory of the vault: every hub, link, satellite and point-in-time table with its parents and its size."""
    catalog = VAULT_MODEL.catalog(spark).withColumn("parents", F.array_join("parents", ","))
    tables = build.Tables(build.warehouse(spark, sf, AS_OF))
    return catalog.join(ops.count_tables({n: tables[n] for _, n, *_ in _KINDS}, "name"), "name")


# --- historised staging -------------------------------------------------------------------------

CUSTOMERS = scd.Scd2Spec(
    key="id",
    types={"id": "bigint", "name": "string", "segment": "string", "nation_id": "int",
           "balance": "decimal(19,4)", "change_date": "timestamp_ntz"},
    tracked=("name", "segment", "nation_id", "balance"),
    dedup=("id", "name", "segment", "change_date"),
    change_col="change_date", source="raw.customers", surrogate="customers_sk",
)
PRODUCTS = scd.Scd2Spec(
    key="id",
    types={"id": "bigint", "product_code": "string", "product_name": "string", "category": "string",
           "size": "int", "list_price": "decimal(12,2)", "standard_cost": "decimal(12,4)",
           "change_date": "timestamp_ntz"},
    tracked=("product_code", "product_name", "category", "size", "list_price", "standard_cost"),
    dedup=("id", "product_code", "product_name", "change_date"),
    change_col="change_date", source="raw.products", surrogate="products_sk",
)
_PSA_NOW = datetime(2024, 1, 18, 18)
RUNS = [datetime(2024, 1, 2, 6), datetime(2024, 1, 16, 6), datetime(2024, 1, 23, 6), datetime(2024, 1, 30, 6)]

_BATCHES = {1: raw.customers, 2: raw.customers_after_delta, 3: raw.customers_batch3,
            4: raw.customers_after_delta}


def customer_history(spark: SparkSession, sf: str, upto: int) -> DataFrame:
    """All versions after the given number of deliveries, each a stored run; delete detection from the
    third on."""
    return stored_history(spark, sf, upto).read("psa", "customers_psa")


def stored_history(spark: SparkSession, sf: str, upto: int):
    lake = build.new_lake(spark, sf)
    for batch in range(1, upto + 1):
        build.psa_run(lake, CUSTOMERS, "customers_psa", _BATCHES[batch](spark, sf), RUNS[batch - 1], detect_deletes=batch >= 3)
    return lake


def _cln(raw_name: str, spec: scd.Scd2Spec) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, {rowhash_sql(spec.tracked)} AS ng_rowhash, "
            f"row_number() OVER (PARTITION BY {', '.join(spec.dedup)} ORDER BY {spec.change_col}) AS rn "
            f"FROM (SELECT {', '.join(spec.types)} FROM {raw_name})) WHERE rn = 1")


def _open_sql(clean: str, spec: scd.Scd2Spec, run: datetime) -> str:
    ts = f"TIMESTAMP '{run}'"
    return (f"SELECT sha256(concat_ws('|', cast(id AS VARCHAR), ng_rowhash, cast({ts} AS VARCHAR))) "
            f"AS {spec.surrogate}, {', '.join(spec.types)}, ng_rowhash, {ts} AS ng_valid_from, "
            f"CAST(NULL AS TIMESTAMP) AS ng_valid_to, 1 AS ng_is_current, 0 AS ng_is_deleted, "
            f"{ts} AS ng_insert_date, CAST(NULL AS TIMESTAMP) AS ng_update_date, "
            f"'{spec.source}' AS ng_source FROM {clean}")


def _run_sql(before: str, clean: str, run: datetime, deletes: bool) -> str:
    """Close changed rows, add new versions, then close rows whose key is gone."""
    ts = f"TIMESTAMP '{run}'"
    gone = f"ng_is_current = 1 AND id NOT IN (SELECT id FROM {clean})" if deletes else "FALSE"
    changed = f"ng_is_current = 1 AND EXISTS (SELECT 1 FROM {clean} c WHERE c.id = t.id AND c.ng_rowhash <> t.ng_rowhash)"
    return f"""SELECT * REPLACE (
            CASE WHEN ({changed}) OR ({gone}) THEN {ts} ELSE ng_valid_to END AS ng_valid_to,
            CASE WHEN ({changed}) OR ({gone}) THEN 0 ELSE ng_is_current END AS ng_is_current,
            CASE WHEN {gone} THEN 1 ELSE ng_is_deleted END AS ng_is_deleted,
            CASE WHEN ({changed}) OR ({gone}) THEN {ts} ELSE ng_update_date END AS ng_update_date)
        FROM {before} t
        UNION ALL {_open_sql(f"(SELECT * FROM {clean} c WHERE NOT EXISTS (SELECT 1 FROM {before} b "
                             f"WHERE b.id = c.id AND b.ng_is_current = 1 AND b.ng_rowhash = c.ng_rowhash))",
                             CUSTOMERS, run)}"""


PSA_PARTS = {
    "cln_1": _cln("raw_customers", CUSTOMERS), "cln_2": _cln("raw_customers_after_delta", CUSTOMERS),
    "cln_3": _cln("raw_customers_batch3", CUSTOMERS), "cln_4": _cln("raw_customers_after_delta", CUSTOMERS),
    "psa_1": _open_sql("cln_1", CUSTOMERS, RUNS[0]),
    "psa_2": _run_sql("psa_1", "cln_2", RUNS[1], False),
    "psa_3": _run_sql("psa_2", "cln_3", RUNS[2], True),
    "psa_4": _run_sql("psa_3", "cln_4", RUNS[3], True),
    "psa_stg": f"""SELECT id AS customer_id, name, segment, nation_id, balance, 'PSA_NG_GEN' AS record_source,
        change_date AS effective_from, change_date AS load_datetime, {key_sql('id')} AS customer_hk,
        {diff_sql(model.CUSTOMER_PAYLOAD)} AS hashdiff FROM psa_2
        WHERE ng_is_current = 1 AND ng_is_deleted = 0""",
}


@query("psa_interface", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
        CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders""")
def psa_interface(spark: SparkSession, sf: str) -> DataFrame:
    return cast_interface(raw.given(spark, sf, "orders"), {
        "o_orderkey": "string", "o_custkey": "bigint", "o_orderdate": "date", "o_totalprice": "decimal(18,2)"})


@query("psa_rowhash", f"SELECT id, {rowhash_sql(CUSTOMERS.tracked)} AS ng_rowhash FROM raw_customers")
def psa_rowhash(spark: SparkSession, sf: str) -> DataFrame:
    df = raw.customers(spark, sf)
    return df.select("id", row_hash(df, CUSTOMERS.tracked).alias("ng_rowhash"))


@query("psa_clean", "SELECT * FROM cln_x", cln_x=_cln(
    "(SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers_delta)",
    CUSTOMERS))
def psa_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Batch 1 delivered twice together with the delta: the repeats go, both versions stay."""
    twice = raw.customers(spark, sf).unionByName(raw.customers(spark, sf))
    return scd.clean(twice.unionByName(raw.customers_delta(spark, sf)), CUSTOMERS)


@query("psa_scd2_close", """SELECT * FROM psa_2 WHERE ng_is_current = 0""", **PSA_PARTS)
def psa_scd2_close(spark: SparkSession, sf: str) -> DataFrame:
    return scd.changed_rows(customer_history(spark, sf, 1), scd.clean(_BATCHES[2](spark, sf), CUSTOMERS),
                            CUSTOMERS, _ntz(RUNS[1]))


@query("psa_scd2_load", "SELECT * FROM psa_2", **PSA_PARTS)
def psa_scd2_load(spark: SparkSession, sf: str) -> DataFrame:
    return customer_history(spark, sf, 2)


@query("psa_delete_detection", f"SELECT * FROM psa_3 WHERE ng_is_deleted = 1", **PSA_PARTS)
def psa_delete_detection(spark: SparkSession, sf: str) -> DataFrame:
    live = customer_history(spark, sf, 2).where("ng_is_current = 1")
    return scd.detect_deletes(live, scd.clean(_BATCHES[3](spark, sf), CUSTOMERS), CUSTOMERS, _ntz(RUNS[2]))


@query("psa_reinstated", "SELECT * FROM psa_4", **PSA_PARTS)
def psa_reinstated(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted customers that come back get a fresh version; the deleted one stays."""
    return customer_history(spark, sf, 4)


@query("psa_current", "SELECT * FROM psa_3 WHERE ng_is_current = 1 AND ng_is_deleted = 0", **PSA_PARTS)
def psa_current(spark: SparkSession, sf: str) -> DataFrame:
    return scd.current_view(customer_history(spark, sf, 3))


@query("psa_history", "SELECT * FROM psa_3", **PSA_PARTS)
def psa_history(spark: SparkSession, sf: str) -> DataFrame:
    return customer_history(spark, sf, 3).select(*CUSTOMERS.columns)


@query("psa_deleted", "SELECT * FROM psa_3 WHERE ng_is_deleted = 1", **PSA_PARTS)
def psa_deleted(spark: SparkSession, sf: str) -> DataFrame:
    return scd.deleted_view(customer_history(spark, sf, 3))


@query("psa_as_of", """SELECT * FROM psa_4 WHERE ng_valid_from <= TIMESTAMP '2024-01-25 00:00:00'
        AND (ng_valid_to IS NULL OR ng_valid_to > TIMESTAMP '2024-01-25 00:00:00')""", **PSA_PARTS)
def psa_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return scd.as_of(customer_history(spark, sf, 4), _ntz(datetime(2024, 1, 25)))


@query("psa_as_of_events", """SELECT event_id, user_id, ts, segment, ng_valid_from, ng_is_deleted FROM events
        JOIN psa_4 ON id = user_id % 50 AND ts >= ng_valid_from AND (ng_valid_to IS NULL OR ts < ng_valid_to)""", **PSA_PARTS)
def psa_as_of_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with the version of its customer that was valid then; few customers have all events."""
    events = raw.given(spark, sf, "events").select("event_id", "user_id", "ts", (F.col("user_id") % 50).alias("id"))
    versions = customer_history(spark, sf, 4)
    found = interval_join(events, versions, ["id"], "ts", "ng_valid_from", "ng_valid_to", ["segment", "ng_valid_from", "ng_is_deleted"])
    return found.drop("id")


@query("psa_status", """SELECT total, current_versions, deleted, total - current_versions - deleted AS historic FROM (
        SELECT count(*) AS total, count(*) FILTER (ng_is_current = 1 AND ng_is_deleted = 0) AS current_versions,
        count(*) FILTER (ng_is_deleted = 1) AS deleted FROM psa_4)""", **PSA_PARTS)
def psa_status(spark: SparkSession, sf: str) -> DataFrame:
    return scd.status(customer_history(spark, sf, 4))


def _psa_branch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Hub and satellite on top of the current view after batch 2."""
    staged = stage(scd.current_view(customer_history(spark, sf, 2)), model.STAGING["customers_psa"])
    return (ops.key_rows(staged, None, model.PSA_HUBS["hub_customer_psa"]),
            ops.sat_rows(staged, None, model.PSA_SATS["sat_customer_psa"]))


@query("psa_hub_sat", """SELECT customer_hk, customer_id, hashdiff, name, segment, nation_id, balance,
        effective_from, load_datetime, record_source FROM psa_stg""", **PSA_PARTS)
def psa_hub_sat(spark: SparkSession, sf: str) -> DataFrame:
    hub, sat = _psa_branch(spark, sf)
    return hub.select("customer_hk", "customer_id").join(sat, "customer_hk")


@query("psa_rebuild_counts", """SELECT 'psa_current' AS table_name, count(*) AS row_count FROM psa_stg
        UNION ALL SELECT 'hub_customer_psa', count(*) FROM psa_stg
        UNION ALL SELECT 'sat_customer_psa', count(*) FROM psa_stg""", **PSA_PARTS)
def psa_rebuild_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The vault branch on the stored history, dropped and loaded again."""
    lake = stored_history(spark, sf, 2)
    build.psa_vault(lake)
    return build.psa_rebuild(lake)


@query("psa_freshness", f"""SELECT *, CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_seconds > 72 * 3600 THEN 'error'
        WHEN age_seconds > 48 * 3600 THEN 'warn' ELSE 'pass' END AS status FROM (SELECT 'customers_psa' AS table_name,
        max(ng_insert_date) AS max_loaded_at,
        epoch_us(TIMESTAMP '{_PSA_NOW}' - max(ng_insert_date)) / 1000000.0::DOUBLE AS age_seconds FROM psa_2)""", **PSA_PARTS)
def psa_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Age of the stored history against its limits."""
    tables = {"customers_psa": customer_history(spark, sf, 2)}
    rules = [r for r in suite.PSA_FRESHNESS if r.table in tables]
    return quality.source_freshness(tables, rules, _ntz(_PSA_NOW))


@query("psa_vs_classic", """SELECT 'hub_customer' AS table_name, (SELECT count(*) FROM all_hub_customer) AS classic_rows,
        (SELECT count(*) FROM psa_stg) AS psa_rows,
        (SELECT count(*) FROM all_hub_customer) = (SELECT count(*) FROM psa_stg) AS counts_match,
        (SELECT count(*) FROM (SELECT customer_hk, customer_id FROM all_hub_customer EXCEPT SELECT customer_hk, customer_id FROM psa_stg))
        + (SELECT count(*) FROM (SELECT customer_hk, customer_id FROM psa_stg EXCEPT SELECT customer_hk, customer_id FROM all_hub_customer)) AS differing_rows
        UNION ALL SELECT 'sat_customer', (SELECT count(*) FROM all_sat_customer), (SELECT count(*) FROM psa_stg),
        (SELECT count(*) FROM all_sat_customer) = (SELECT count(*) FROM psa_stg),
        (SELECT count(*) FROM (SELECT customer_hk, hashdiff FROM all_sat_customer EXCEPT SELECT customer_hk, hashdiff FROM psa_stg))
        + (SELECT count(*) FROM (SELECT customer_hk, hashdiff FROM psa_stg EXCEPT SELECT customer_hk, hashdiff FROM all_sat_customer))""",
       **PSA_PARTS)
def psa_vs_classic(spark: SparkSession, sf: str) -> DataFrame:
    """The PSA branch holds current versions only, so its satellite lacks the replaced ones."""
    vault = Vault(spark, sf, with_delta=True)
    hub, sat = _psa_branch(spark, sf)
    return scd.compare_branches({
        "hub_customer": (vault["hub_customer"].select("customer_hk", "customer_id"),
                         hub.select("customer_hk", "customer_id")),
        "sat_customer": (vault["sat_customer"].select("customer_hk", "hashdiff"),
                         sat.select("customer_hk", "hashdiff")),
    })


@query("psa_viewer", """SELECT id, name, segment, ng_valid_from, ng_valid_to, ng_is_current, ng_is_deleted,
        ng_rowhash FROM psa_3 ORDER BY id, ng_valid_from LIMIT 50""", **PSA_PARTS)
def psa_viewer(spark: SparkSession, sf: str) -> DataFrame:
    return customer_history(spark, sf, 3).select(
        "id", "name", "segment", "ng_valid_from", "ng_valid_to", "ng_is_current", "ng_is_deleted", "ng_rowhash",
    ).orderBy("id", "ng_valid_from").limit(50)


@query("psa_products", "SELECT * FROM psa_p", cln_p=_cln("raw_products", PRODUCTS),
       psa_p=_open_sql("cln_p", PRODUCTS, RUNS[0]))
def psa_products(spark: SparkSession, sf: str) -> DataFrame:
    """The same pattern for another table: only the spec differs."""
    return scd.first_delivery(scd.clean(raw.products(spark, sf), PRODUCTS), PRODUCTS, _ntz(RUNS[0]))
