"""Data-quality, freshness and run-result queries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.functions import runs
from lakevault.operators import quality as q
from lakevault.operators import vault as ops
from lakevault.plans import build, marts, model, raw, suite
from lakevault.plans.initial import Packed, Vault
from lakevault.plans.queries_time import AS_OF
from lakevault.plans.registry import query
from lakevault.session import work_folder
from lakevault.sources import artefacts
from lakevault.sources.contracts import check_key

NOW = datetime(2024, 1, 31)


def _ntz(value: datetime):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


class Models:
    """Staging, vault and mart tables by name, each described when it is asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf, self.vault = spark, sf, Vault(spark, sf)

    def __getitem__(self, name: str) -> DataFrame:
        if name.startswith("stg_"):
            return model.staged(self.spark, self.sf, name.removeprefix("stg_"))
        return marts.MARTS[name](Packed(self.vault)) if name.startswith("mart_") else self.vault[name]


def _result(model_name: str, test: str, column: str, failures: str, checked: str, severity: str = "fail",
            source: str = "") -> str:
    """The result row of one test as SQL; ``failures`` and ``checked`` are aggregates over the model."""
    return (f"SELECT '{model_name}' AS model, '{test}' AS test, '{column}' AS \"column\", "
            f"'{severity}' AS severity, CASE WHEN f = 0 THEN 'pass' ELSE '{severity}' END AS status, "
            f"f AS failures, c AS checked_rows FROM (SELECT CAST(coalesce({failures}, 0) AS BIGINT) AS f, "
            f"CAST({checked} AS BIGINT) AS c FROM {source or model_name})")


def _grouped(model_name: str, columns: str) -> str:
    return f"(SELECT {columns}, count(*) AS n FROM {model_name} GROUP BY {columns})"


def _register(name: str, tests: Callable[[], list[q.Test]], sql: str) -> None:
    """``tests`` is called when the query runs, since column expressions need a session."""
    query(name, sql)(lambda spark, sf: q.run(Models(spark, sf), tests()))


_NOT_NULL_SQL = _result("stg_orders", "not_null", "employee_id", "count_if(employee_id IS NULL)", "count(*)")
_register("dq_not_null", lambda: [q.not_null("stg_orders", "employee_id")], _NOT_NULL_SQL)
_register("dq_unique", lambda: [q.unique("hub_order", "order_hk"), q.unique("stg_order_details", "order_hk")],
          _result("hub_order", "unique", "order_hk", "count_if(n > 1)", "sum(n)",
                  source=_grouped("hub_order", "order_hk")) + " UNION ALL "
          + _result("stg_order_details", "unique", "order_hk", "count_if(n > 1)", "sum(n)",
                    source=_grouped("stg_order_details", "order_hk")))
_register("dq_regex", lambda: [q.matches("stg_customers", "name", suite.NAME_PATTERN),
                       q.matches("stg_products", "product_code", "^Brand#1[0-9]$")],
          _result("stg_customers", "match_regex", "name",
                  f"count_if(NOT regexp_matches(name, '{suite.NAME_PATTERN}'))", "count(*)") + " UNION ALL "
          + _result("stg_products", "match_regex", "product_code",
                    "count_if(NOT regexp_matches(product_code, '^Brand#1[0-9]$'))", "count(*)"))
_register("dq_between", lambda: [q.between("stg_orders", "shipping_fee", 0, 100),
                         q.between("stg_order_details", "discount", 0, 100),
                         q.between("stg_customers", "balance", low=0)],
          _result("stg_orders", "between", "shipping_fee", "count_if(NOT shipping_fee BETWEEN 0 AND 100)", "count(*)")
          + " UNION ALL " + _result("stg_order_details", "between", "discount",
                                    "count_if(NOT discount BETWEEN 0 AND 100)", "count(*)")
          + " UNION ALL " + _result("stg_customers", "between", "balance", "count_if(balance < 0)", "count(*)"))
_register("dq_between_strict", lambda: [q.between("stg_order_details", "quantity", 0, strictly=True),
                                q.between("stg_order_details", "discount", 0, strictly=True)],
          _result("stg_order_details", "between_strict", "quantity", "count_if(quantity <= 0)", "count(*)")
          + " UNION ALL " + _result("stg_order_details", "between_strict", "discount",
                                    "count_if(discount <= 0)", "count(*)"))
_register("dq_pair", lambda: [q.pair_ordered("stg_orders", "shipped_date", "order_date",
                                     where="shipped_date IS NOT NULL", severity="warn")],
          _result("stg_orders", "pair_a_not_below_b", "shipped_date,order_date",
                  "count_if(shipped_date IS NOT NULL AND shipped_date < order_date)", "count(*)", "warn"))
_register("dq_distinct_count", lambda: [q.distinct_count("stg_orders", "order_status", 4),
                                q.distinct_count("stg_orders", "payment_type", 5)],
          _result("stg_orders", "distinct_count", "order_status",
                  "CASE WHEN count(DISTINCT order_status) <> 4 THEN 1 ELSE 0 END", "count(*)") + " UNION ALL "
          + _result("stg_orders", "distinct_count", "payment_type",
                    "CASE WHEN count(DISTINCT payment_type) <> 5 THEN 1 ELSE 0 END", "count(*)"))
_register("dq_unique_ratio", lambda: [q.unique_ratio("hub_customer", "customer_id", 1.0, 1.0),
                              q.unique_ratio("stg_order_details", "order_hk", 0.5, 1.0)],
          _result("hub_customer", "unique_ratio", "customer_id",
                  "CASE WHEN count(DISTINCT customer_id) / count(customer_id) BETWEEN 1 AND 1 THEN 0 ELSE 1 END",
                  "count(*)") + " UNION ALL "
          + _result("stg_order_details", "unique_ratio", "order_hk",
                    "CASE WHEN count(DISTINCT order_hk) / count(order_hk) BETWEEN 0.5 AND 1 THEN 0 ELSE 1 END",
                    "count(*)"))
_register("dq_compound_unique", lambda: [q.compound_unique("lnk_order_product", ["order_hk", "product_hk"]),
                                 q.compound_unique("stg_order_details", ["order_hk", "date_allocated"])],
          _result("lnk_order_product", "compound_unique", "order_hk,product_hk",
                  "sum(CASE WHEN n > 1 THEN n ELSE 0 END)", "sum(n)",
                  source=_grouped("lnk_order_product", "order_hk, product_hk")) + " UNION ALL "
          + _result("stg_order_details", "compound_unique", "order_hk,date_allocated",
                    "sum(CASE WHEN n > 1 THEN n ELSE 0 END)", "sum(n)",
                    source=_grouped("stg_order_details", "order_hk, date_allocated")))
_register("dq_recent", lambda: [q.recent("sat_customer", "load_datetime", _ntz(NOW), 3, severity="warn"),
                        q.recent("sat_customer", "load_datetime", _ntz(NOW), 10, severity="warn"),
                        q.recent("sat_order", "load_datetime", _ntz(NOW), 25)],
          " UNION ALL ".join(
              _result(m, "recent_data", "load_datetime", "CASE WHEN max(load_datetime) >= "
                      f"CAST(CAST('{NOW.date()}' AS DATE) - INTERVAL {y} YEAR AS TIMESTAMP) THEN 0 ELSE 1 END",
                      "count(*)", s)
              for m, y, s in (("sat_customer", 3, "warn"), ("sat_customer", 10, "warn"), ("sat_order", 25, "fail"))))
_register("dq_row_count", lambda: [q.row_count("mart_order_overview", low=600),
                           q.row_count("mart_revenue_per_customer", 1, 200)],
          _result("mart_order_overview", "row_count", "", "CASE WHEN count(*) < 600 THEN 1 ELSE 0 END", "count(*)")
          + " UNION ALL " + _result("mart_revenue_per_customer", "row_count", "",
                                    "CASE WHEN count(*) NOT BETWEEN 1 AND 200 THEN 1 ELSE 0 END", "count(*)"))
_register("dq_accepted_values", lambda: [q.accepted("stg_orders", "order_status", ["F", "O"])],
          _result("stg_orders", "accepted_values", "order_status",
                  "count_if(order_status NOT IN ('F', 'O'))", "sum(n)",
                  source=_grouped("stg_orders", "order_status")))


@query("dq_relationship", _result(
    "new_details", "relationship", "product_id",
    "count_if(product_id NOT IN (SELECT p_partkey FROM part WHERE p_brand <> 'Brand#1'))", "count(*)"),
    new_details="SELECT * FROM raw_order_details UNION ALL SELECT * FROM raw_order_details_delta")
def dq_relationship(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines whose product is missing, here because one brand is not delivered."""
    details = raw.order_details(spark, sf).unionByName(raw.order_details_delta(spark, sf))
    parts = raw.given(spark, sf, "part").where("p_brand <> 'Brand#1'").select("p_partkey")
    return q.run({"new_details": details, "products": parts},
                 [q.relationship("new_details", "product_id", "products", "p_partkey")])


def _suite_sql() -> str:
    nn = lambda m, c: _result(m, "not_null", c, f"count_if({c} IS NULL)", "count(*)")
    un = lambda m, c: _result(m, "unique", c, "count_if(n > 1)", "sum(n)",
                              source=f"(SELECT {c}, count(*) AS n FROM {m} WHERE {c} IS NOT NULL GROUP BY {c})")
    flag = lambda cond: f"CASE WHEN {cond} THEN 0 ELSE 1 END"
    ratio = lambda m, c, lo: _result(
        m, "unique_ratio", c, flag(f"count(DISTINCT {c}) / count({c}) BETWEEN {lo} AND 1"), "count(*)")
    pairs = lambda m, a, b: _result(
        m, "compound_unique", f"{a},{b}", "sum(CASE WHEN n > 1 THEN n ELSE 0 END)", "sum(n)",
        source=_grouped(m, f"{a}, {b}"))
    recent = lambda m: _result(m, "recent_data", "load_datetime", flag(
        f"max(load_datetime) >= CAST(CAST('{NOW.date()}' AS DATE) - INTERVAL 3 YEAR AS TIMESTAMP)"),
        "count(*)", "warn")
    rng = lambda m, c, cond: _result(m, "between", c, f"count_if(NOT ({cond}))", "count(*)")
    strict = lambda m, c: _result(m, "between_strict", c, f"count_if({c} <= 0)", "count(*)")
    rows = [
        nn("stg_customers", "customer_hk"), nn("stg_customers", "customer_id"),
        _result("stg_customers", "match_regex", "name",
                f"count_if(NOT regexp_matches(name, '{suite.NAME_PATTERN}'))", "count(*)"),
        nn("stg_employees", "employee_hk"), nn("stg_employees", "employee_id"),
        _result("stg_orders", "pair_a_not_below_b", "shipped_date,order_date",
                "count_if(shipped_date < order_date)", "count(*)", "warn"),
        nn("stg_orders", "order_hk"), nn("stg_orders", "order_id"),
        rng("stg_orders", "shipping_fee", "shipping_fee BETWEEN 0 AND 100"),
        _result("stg_orders", "distinct_count", "order_status",
                flag("count(DISTINCT order_status) = 4"), "count(*)"),
        nn("stg_order_details", "order_product_hk"),
        rng("stg_order_details", "discount", "discount BETWEEN 0 AND 100"),
        strict("stg_order_details", "unit_price"), strict("stg_order_details", "quantity"),
        nn("stg_products", "product_hk"), nn("stg_products", "product_id"),
    ]
    for m, c in (suite.HUB_KEYS | suite.LINK_KEYS).items():
        rows += [un(m, c), nn(m, c)]
    rows += [
        ratio("hub_customer", "customer_id", 1), ratio("hub_order", "order_id", 1),
        pairs("lnk_order_customer", "order_hk", "customer_hk"),
        pairs("lnk_order_product", "order_hk", "product_hk"),
        ratio("sat_customer", "customer_hk", 0.5), recent("sat_customer"), recent("sat_order"),
        _result("mart_revenue_per_customer", "row_count", "", flag("count(*) BETWEEN 1 AND 200"), "count(*)"),
        un("mart_revenue_per_customer", "customer_id"), nn("mart_revenue_per_customer", "customer_id"),
        rng("mart_revenue_per_customer", "total_revenue", "total_revenue >= 0"),
        rng("mart_revenue_per_customer", "total_orders", "total_orders >= 1"),
        _result("mart_order_overview", "row_count", "", flag("count(*) >= 600"), "count(*)"),
        un("mart_order_overview", "order_id"), nn("mart_order_overview", "order_id"),
        un("mart_product_sales", "product_id"), nn("mart_product_sales", "product_id"),
        rng("mart_product_sales", "total_quantity_sold", "total_quantity_sold >= 0"),
    ]
    return " UNION ALL ".join(rows)


_SUITE_SQL = _suite_sql()


def all_tests() -> list[q.Test]:
    return suite.staging_tests() + suite.vault_tests(_ntz(NOW)) + suite.mart_tests()


@query("dq_suite", _SUITE_SQL)
def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    """Every declared test, on the stored warehouse."""
    return q.run(build.Tables(build.warehouse(spark, sf, AS_OF)), all_tests(), build.LIES_BY, build.HASHED)


@query("dq_failing_rows", "SELECT id, order_date, shipped_date FROM raw_orders WHERE shipped_date < order_date")
def dq_failing_rows(spark: SparkSession, sf: str) -> DataFrame:
    test = q.pair_ordered("stg_orders", "shipped_date", "order_date", where="shipped_date IS NOT NULL")
    return q.failing_rows(Models(spark, sf), test).select("id", "order_date", "shipped_date")


@query("dq_monotonic", " UNION ALL ".join(
    _result(n, "row_count", "", f"CASE WHEN count(*) >= (SELECT count(*) FROM {n}) THEN 0 ELSE 1 END", "count(*)",
            source=f"(SELECT * FROM {n} UNION ALL SELECT * FROM new_{n})")
    for n in ("sat_customer", "sat_order")))
def dq_monotonic(spark: SparkSession, sf: str) -> DataFrame:
    """A satellite must not have fewer rows than the run before; here before and after the delta."""
    before, after = Vault(spark, sf), Vault(spark, sf, with_delta=True)
    names = ("sat_customer", "sat_order")
    last = {r[0]: r[1] for r in ops.count_tables({n: before[n] for n in names}).collect()}
    return q.run({n: after[n] for n in names}, [q.never_shrinks(n, last[n]) for n in names])


# --- freshness -----------------------------------------------------------------------------------

def _age_sql(table: str, column: str, warn: int | None, error: int | None) -> str:
    limits = "".join(f" WHEN age_seconds > {h * 3600} THEN '{s}'" for s, h in (("error", error), ("warn", warn)) if h)
    return (f"SELECT *, CASE WHEN max_loaded_at IS NULL THEN 'error'{limits} ELSE 'pass' END AS status FROM ("
            f"SELECT '{table}' AS table_name, max({column}) AS max_loaded_at, "
            f"epoch_us(TIMESTAMP '{NOW}' - max({column})) / 1000000.0::DOUBLE AS age_seconds FROM raw_{table})")


@query("source_freshness", " UNION ALL ".join([
    _age_sql("customers", "change_date", 12, None), _age_sql("employees", "change_date", 12, None),
    _age_sql("orders", "change_date", 24, None), _age_sql("order_details", "change_date", 24, None),
    _age_sql("products", "change_date", 48, None), _age_sql("events", "ts", 48, 72)]),
    raw_events="SELECT ts FROM events")
def source_freshness(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"customers": raw.customers(spark, sf), "employees": raw.employees(spark, sf),
              "orders": raw.orders(spark, sf), "order_details": raw.order_details(spark, sf),
              "products": raw.products(spark, sf), "events": raw.given(spark, sf, "events")}
    rules = [*suite.FRESHNESS, q.Freshness("events", "ts", timedelta(hours=48), timedelta(hours=72))]
    return q.source_freshness(tables, rules, _ntz(NOW))


@query("freshness_gate", f"""SELECT max(load_datetime) AS last_load, CASE WHEN TIMESTAMP '{NOW}' - max(load_datetime)
        < INTERVAL 12 HOUR THEN 'proceed_fresh' ELSE 'proceed_stale' END AS decision FROM stg_user_states""")
def freshness_gate(spark: SparkSession, sf: str) -> DataFrame:
    return q.freshness_gate(spark, model.staged(spark, sf, "user_states"), "load_datetime", _ntz(NOW), timedelta(hours=12))


# --- domain report ---------------------------------------------------------------------------------

_ANOMALY = """SELECT id AS order_id, CAST(order_date AS DATE) AS ordered, CAST(shipped_date AS DATE) AS shipped,
        CAST(date_diff('day', CAST(shipped_date AS DATE), CAST(order_date AS DATE)) AS INTEGER) AS days_early, order_status
        FROM raw_orders WHERE shipped_date < order_date"""


def ship_report(spark: SparkSession, sf: str) -> DataFrame:
    early = raw.orders(spark, sf).where("shipped_date IS NOT NULL AND shipped_date < order_date")
    return early.select(
        F.col("id").alias("order_id"), F.to_date("order_date").alias("ordered"),
        F.to_date("shipped_date").alias("shipped"),
        F.date_diff(F.to_date("order_date"), F.to_date("shipped_date")).alias("days_early"), "order_status")


@query("ship_anomalies", _ANOMALY)
def ship_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Orders shipped before they were placed, worst first."""
    return ship_report(spark, sf).orderBy(F.desc_nulls_first("days_early"), "order_id")


@query("ship_anomalies_top20", f"SELECT * FROM ({_ANOMALY}) ORDER BY days_early DESC, order_id LIMIT 20")
def ship_anomalies_top20(spark: SparkSession, sf: str) -> DataFrame:
    return ship_report(spark, sf).orderBy(F.desc_nulls_first("days_early"), "order_id").limit(20)


@query("ship_anomaly_summary", f"SELECT count(*) AS bad_orders, max(days_early) AS max_days_early FROM ({_ANOMALY})")
def ship_anomaly_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ship_report(spark, sf).agg(
        F.count(F.lit(1)).alias("bad_orders"), F.max("days_early").alias("max_days_early"))


# --- test results as data: the event log read as a log of test runs ------------------------------------

_KNOWN = ("stg_orders", "sat_order", "sat_order_detail", "hub_customer", "mart_product_sales")
# One generated test id per event type.
_UIDS = {
    "click": "test.lakevault.not_null_stg_orders_order_hk.8f1c",
    "view": "test.lakevault.dbt_expectations_expect_column_values_to_be_between_sat_order_detail_discount_0_100.77aa",
    "purchase": "test.lakevault.unique_hub_customer_customer_hk.19d0",
    "signup": "test.lakevault.dbt_expectations_expect_table_row_count_to_be_between_mart_product_sales.c3e2",
    "error": "model.sat_order",
}
_NAMES = {
    "click": ("not_null_stg_orders_order_hk", "stg_orders", "staging", "standard",
              "NOT NULL: stg_orders.order_hk"),
    "view": ("dbt_expectations_expect_column_values_to_be_between_sat_order_detail_discount_0_100",
             "sat_order_detail", "raw_vault", "dbt-expectations", "Wertebereich: sat_order_detail.discount_0_100"),
    "purchase": ("unique_hub_customer_customer_hk", "hub_customer", "raw_vault", "standard",
                 "UNIQUE: hub_customer.customer_hk"),
    "signup": ("dbt_expectations_expect_table_row_count_to_be_between_mart_product_sales",
               "mart_product_sales", "mart", "dbt-expectations", "Zeilenanzahl plausibel: mart_product_sales"),
    "error": ("model.sat_order", "sat_order", "raw_vault", "standard", "model.sat_order"),
}
_STATUS = {"click": "pass", "view": "success", "purchase": "warn", "signup": "fail", "error": "error"}


def _mapped(column: str, values: dict[str, str]):
    out = F.lit(None).cast("string")
    for key, value in values.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def test_log(spark: SparkSession, sf: str) -> DataFrame:
    """One test result per event: the user is the domain, the day is the run."""
    uid = _mapped("event_type", _UIDS)
    return raw.given(spark, sf, "events").select(
        "event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("run_at"),
        F.concat(F.lit("domain_"), F.col("user_id").cast("string")).alias("domain"),
        runs.test_name_of(uid).alias("test_name"), runs.model_of(uid, _KNOWN).alias("model_name"),
        runs.layer_of(uid).alias("layer"), runs.test_type_of(uid).alias("test_type"),
        _mapped("event_type", _STATUS).alias("status"), F.floor("value").cast("int").alias("failures"),
        F.col("props").alias("message"),
    )


_LOG = f"""SELECT event_id, date_trunc('day', ts) AS run_at, 'domain_' || user_id AS domain,
        {_case('event_type', {k: v[0] for k, v in _NAMES.items()})} AS test_name,
        {_case('event_type', {k: v[1] for k, v in _NAMES.items()})} AS model_name,
        {_case('event_type', {k: v[2] for k, v in _NAMES.items()})} AS layer,
        {_case('event_type', {k: v[3] for k, v in _NAMES.items()})} AS test_type,
        {_case('event_type', _STATUS)} AS status, CAST(floor(value) AS INTEGER) AS failures,
        props AS message FROM events"""


@query("runs_classify", f"""SELECT event_id, {_case('event_type', {k: v[0] for k, v in _NAMES.items()})} AS test_name,
        {_case('event_type', {k: v[1] for k, v in _NAMES.items()})} AS model_name,
        {_case('event_type', {k: v[2] for k, v in _NAMES.items()})} AS layer,
        {_case('event_type', {k: v[3] for k, v in _NAMES.items()})} AS test_type,
        {_case('event_type', {k: v[4] for k, v in _NAMES.items()})} AS readable FROM events""")
def runs_classify(spark: SparkSession, sf: str) -> DataFrame:
    uid = _mapped("event_type", _UIDS)
    return raw.given(spark, sf, "events").select(
        "event_id", runs.test_name_of(uid).alias("test_name"), runs.model_of(uid, _KNOWN).alias("model_name"),
        runs.layer_of(uid).alias("layer"), runs.test_type_of(uid).alias("test_type"),
        runs.readable_name(uid, _KNOWN).alias("readable"))


# what the ids below are made of: layers by prefix, kinds of tests with the text shown for them
_PREFIXES = {"stg_": "staging", "hub_": "raw_vault", "mart_": "mart"}
_ENTITIES = ("click", "view", "purchase", "signup", "error")
_TEST_KINDS = (("not_null", "NOT NULL"), ("unique", "UNIQUE"), ("accepted_values", "Erlaubte Werte"), ("relationships", "Referenz"),
          ("dbt_expectations_expect_column_values_to_be_between", "Wertebereich"), ("dbt_expectations_expect_compound_columns_to_be_unique", "Kombination eindeutig"))
_MADE_MODELS = [f"{p}{e}_{n}" for p in _PREFIXES for e in _ENTITIES for n in range(4)]


def _pick(index: str, values) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_MADE = [
    "event_id", f"{_pick('user_id % 3', _PREFIXES)} || event_type || '_' || CAST(user_id % 4 AS STRING) AS model_name",
    f"{_pick('user_id % 3', _PREFIXES.values())} AS layer", f"{_pick('event_id % 6', [k for k, _ in _TEST_KINDS])} AS kind",
    f"{_pick('event_id % 6', [t for _, t in _TEST_KINDS])} AS label", "'c' || CAST(event_id % 97 AS STRING) || '_' || CAST(user_id AS STRING) AS about"]


@query("runs_classify_data", f"""SELECT event_id, kind || '_' || model_name || '_' || about AS test_name, model_name, layer,
        CASE WHEN event_id % 6 >= 4 THEN 'dbt-expectations' ELSE 'standard' END AS test_type,
        label || ': ' || model_name || '.' || about AS readable FROM (SELECT {', '.join(_MADE).replace('STRING', 'VARCHAR')} FROM events)""")
def runs_classify_data(spark: SparkSession, sf: str) -> DataFrame:
    """Test ids put together from the events: about as many as there are rows, over 60 models and six kinds of tests."""
    made = raw.given(spark, sf, "events").selectExpr(*_MADE)
    uid = F.concat_ws(".", F.lit("test.lakevault"), F.concat_ws("_", "kind", "model_name", "about"), F.substring(F.md5(F.col("event_id").cast("string")), 1, 8))
    found = made.select("event_id", uid.alias("uid"))
    uid, model_name = F.col("uid"), F.col("model_name")
    found = found.withColumn("model_name", runs.model_of(uid, _MADE_MODELS))
    return found.select("event_id", runs.test_name_of(uid).alias("test_name"), "model_name", runs.layer_of(uid).alias("layer"),
                        runs.test_type_of(uid).alias("test_type"), runs.readable_name(uid, _MADE_MODELS, model_name).alias("readable"))


@query("dq_latest_summary", "SELECT layer, status, count(*) AS n FROM log "
       "WHERE run_at = (SELECT max(run_at) FROM log) GROUP BY layer, status", log=_LOG)
def dq_latest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return artefacts.summary_by_layer(test_log(spark, sf))


@query("dq_trend", "SELECT CAST(run_at AS DATE) AS day, count(*) AS failures FROM log "
       "WHERE status IN ('fail', 'error') GROUP BY 1", log=_LOG)
def dq_trend(spark: SparkSession, sf: str) -> DataFrame:
    return artefacts.failures_per_day(test_log(spark, sf))


@query("dq_headline", """SELECT count(*) AS total, count(*) FILTER (status IN ('pass', 'success')) AS passed,
        count(*) FILTER (status = 'warn') AS warned, count(*) FILTER (status IN ('fail', 'error')) AS failed FROM log""", log=_LOG)
def dq_headline(spark: SparkSession, sf: str) -> DataFrame:
    return artefacts.headline(test_log(spark, sf))


@query("dq_dedup_runs", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY test_name, model_name ORDER BY run_at DESC, event_id DESC) AS rn FROM log) WHERE rn = 1""", log=_LOG)
def dq_dedup_runs(spark: SparkSession, sf: str) -> DataFrame:
    return artefacts.keep_last(test_log(spark, sf), ["run_at", "event_id"])


@query("dq_filter", "SELECT * FROM log WHERE layer IN ('raw_vault', 'mart') AND status IN ('warn', 'fail')", log=_LOG)
def dq_filter(spark: SparkSession, sf: str) -> DataFrame:
    return artefacts.filtered(test_log(spark, sf), ["raw_vault", "mart"], ["warn", "fail"])


@query("dq_detail", """SELECT run_at, domain, model_name, test_name, status, failures, message FROM log
        WHERE status IN ('fail', 'warn', 'error')""", log=_LOG)
def dq_detail(spark: SparkSession, sf: str) -> DataFrame:
    return artefacts.detail(test_log(spark, sf))


# --- artefacts: suite results written as JSON documents, then read back -----------------------------------

RUN_AT = datetime(2024, 1, 31, 4, 30)


def _domain_of_model():
    return F.when(F.col("model").startswith("mart_"), "consumption").when(
        F.col("model").rlike("order|lnk_"), "domain_orders").otherwise("domain_master")


def write_run_documents(results: DataFrame, folder: str) -> list[str]:
    """One document per domain; a document has one entry per declared test."""
    uid = F.concat_ws(".", F.lit("test"), F.lit("lakevault"),
                      F.concat_ws("_", "test", "model", F.translate("column", ",", "_")),
                      F.substring(F.md5(F.concat_ws("|", "model", "test", "column")), 1, 8))
    entry = F.struct(uid.alias("unique_id"), "status", F.col("failures").cast("int").alias("failures"),
                     F.lit(0.5).alias("execution_time"), F.lit(None).cast("string").alias("message"))
    documents = results.withColumn("domain", _domain_of_model()).groupBy("domain").agg(
        F.to_json(F.struct(
            F.struct(F.lit("run-1").alias("invocation_id"), F.lit(RUN_AT.isoformat()).alias("generated_at")).alias("metadata"),
            F.collect_list(entry).alias("results"))).alias("value"))
    documents.write.partitionBy("domain").text(folder)
    return ["domain_master", "domain_orders", "consumption"]


@query("runs_parse", f"""SELECT 'run-1' AS run_id, TIMESTAMP '{RUN_AT}' AS run_at,
        CASE WHEN model LIKE 'mart_%' THEN 'consumption' WHEN regexp_matches(model, 'order|lnk_')
            THEN 'domain_orders' ELSE 'domain_master' END AS domain,
        concat_ws('_', test, model, replace("column", ',', '_')) AS test_name, model AS model_name,
        CASE WHEN model LIKE 'stg%' THEN 'staging' WHEN model LIKE 'mart%' THEN 'mart' ELSE 'raw_vault' END AS layer,
        'standard' AS test_type, status, CAST(failures AS INTEGER) AS failures, 0.5::DOUBLE AS execution_time,
        '' AS message FROM suite_rows""", suite_rows=_SUITE_SQL)
def runs_parse(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "runs")
    domains = write_run_documents(dq_suite(spark, sf), folder)
    known = {t.model for t in all_tests()}
    return artefacts.run_results(spark, {d: f"{folder}/domain={d}" for d in domains}, sorted(known))


_FRESH_BODY = " UNION ALL ".join([
    _age_sql("customers", "change_date", 12, None), _age_sql("orders", "change_date", 24, None),
    _age_sql("products", "change_date", 48, None), _age_sql("events", "ts", 48, None)])


@query("freshness_parse", f"""SELECT TIMESTAMP '{NOW}' AS checked_at, 'raw' AS source_name, table_name, max_loaded_at,
        status, age_seconds, CASE WHEN age_seconds < 3600 THEN CAST(floor(age_seconds / 60) AS INTEGER) || ' Min'
            WHEN age_seconds < 172800 THEN printf('%.1f Std', age_seconds / 3600)
            ELSE printf('%.1f Tage', age_seconds / 86400) END AS age,
        CASE table_name WHEN 'customers' THEN '12h' WHEN 'orders' THEN '24h' ELSE '48h' END AS warn_limit,
        '' AS error_limit FROM fresh""", raw_events="SELECT ts FROM events", fresh=_FRESH_BODY)
def freshness_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Freshness measured, written as a document, read back; the split run's file is preferred."""
    tables = {"customers": raw.customers(spark, sf), "orders": raw.orders(spark, sf),
              "products": raw.products(spark, sf), "events": raw.given(spark, sf, "events")}
    hours = {"customers": 12, "orders": 24, "products": 48, "events": 48}
    rules = [q.Freshness(t, "ts" if t == "events" else "change_date", timedelta(hours=h)) for t, h in hours.items()]
    measured = q.source_freshness(tables, rules, _ntz(NOW))
    warn = _mapped("table_name", {t: str(h) for t, h in hours.items()}).cast("int")
    entry = F.struct(
        F.concat(F.lit("source.lakevault.raw."), F.col("table_name")).alias("unique_id"),
        F.date_format("max_loaded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("max_loaded_at"), "status",
        F.col("age_seconds").alias("max_loaded_at_time_ago_in_s"),
        F.struct(F.struct(warn.alias("count"), F.lit("hour").alias("period")).alias("warn_after")).alias("criteria"))
    meta = F.struct(F.lit("run-1").alias("invocation_id"), F.lit(NOW.isoformat()).alias("generated_at"))
    folder = work_folder(spark, "freshness")
    measured.agg(F.to_json(F.struct(meta.alias("metadata"), F.collect_list(entry).alias("results"))).alias("value")) \
        .write.text(f"{folder}/domain_orders")
    return artefacts.freshness_results(
        spark, artefacts.choose_existing(spark, f"{folder}/domain_orders", f"{folder}/classic"))


# --- scalar functions in one projection ---------------------------------------------------------------------

@query("scalar_functions", """SELECT o_orderkey, o_orderstatus || '/' || o_orderpriority AS joined,
        concat_ws('-', o_orderstatus, NULL, o_orderpriority) AS joined_ws,
        coalesce(nullif(o_orderstatus, 'P'), 'none') AS filled, sha256(o_orderpriority) AS sha,
        md5(cast(o_orderkey AS VARCHAR)) AS md, cast(o_orderkey AS VARCHAR) AS as_text,
        CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS days_ago, CAST(o_orderdate AS DATE) AS day,
        CASE WHEN o_orderstatus IN ('F', 'O') THEN 'known' WHEN o_orderpriority LIKE '1-%' THEN 'urgent'
            ELSE 'other' END AS kind, regexp_matches(o_orderpriority, '^[0-9]-[A-Z ]+$') AS well_formed,
        CAST(o_custkey AS DOUBLE) * 3 / 4 - 1 AS arithmetic,
        CASE WHEN o_orderkey < 60 THEN '0 Min' ELSE CASE WHEN o_orderkey < 3600
            THEN CAST(floor(o_orderkey / 60) AS INTEGER) || ' Min' ELSE printf('%.1f Std', o_orderkey / 3600) END END AS age
        FROM orders""")
def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return raw.given(spark, sf, "orders").select(
        "o_orderkey", F.concat(status, F.lit("/"), priority).alias("joined"),
        F.concat_ws("-", status, F.lit(None), priority).alias("joined_ws"),
        F.coalesce(F.nullif(status, F.lit("P")), F.lit("none")).alias("filled"),
        F.sha2(priority, 256).alias("sha"), F.md5(F.col("o_orderkey").cast("string")).alias("md"),
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.date_diff(F.lit("2002-01-01").cast("date"), F.to_date("o_orderdate")).alias("days_ago"),
        F.to_date("o_orderdate").alias("day"),
        F.when(status.isin("F", "O"), "known").when(priority.like("1-%"), "urgent").otherwise("other").alias("kind"),
        priority.rlike("^[0-9]-[A-Z ]+$").alias("well_formed"),
        (F.col("o_custkey").cast("double") * 3 / 4 - 1).alias("arithmetic"),
        runs.readable_age(F.col("o_orderkey").cast("double")).alias("age"))


# --- table inventories -----------------------------------------------------------------------------------------

_LAYERS = {"raw": tuple(model.RAW_KEYS), "raw_vault": (*model.HUBS, *model.LINKS, *model.SATS, *model.PITS),
           "mart": tuple(marts.MARTS)}
_PIT_ROWS = {"pit_customer": f"(SELECT 1 FROM hub_customer, range({len(AS_OF)}))",
             "pit_order": f"(SELECT 1 FROM hub_order, range({len(AS_OF)}))"}


def _counted(name: str, layer: str = "") -> str:
    return f"(SELECT count(*) FROM {_PIT_ROWS.get(name, 'raw_' + name if layer == 'raw' else name)})"


@query("layer_row_counts", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, CAST({len(names)} AS BIGINT) AS tables, " + " + ".join(_counted(n, layer) for n in names)
    + " AS row_count" for layer, names in _LAYERS.items()))
def layer_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = build.warehouse(spark, sf, AS_OF).counts(list(_LAYERS))
    return counts.groupBy(F.substring_index("table_name", ".", 1).alias("layer")).agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("row_count"))


@query("domain_row_counts", " UNION ALL ".join(
    f"SELECT '{d}' AS domain, CAST({len(names)} AS BIGINT) AS tables, " + " + ".join(_counted(n) for n in names) + " AS row_count"
    for d, names in model.DOMAINS.items()))
def domain_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = build.warehouse(spark, sf, AS_OF).counts(["raw_vault", "mart"])
    table = F.substring_index("table_name", ".", -1)
    return counts.groupBy(runs.domain_of(table, model.DOMAINS).alias("domain")).agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("row_count"))


@query("src_contract_check", """SELECT 'customers' AS table_name, count(*) AS row_count,
        count(*) - count(DISTINCT id) AS repeated_keys, count(*) FILTER (id IS NULL) AS missing_keys FROM raw_customers
        UNION ALL SELECT 'orders', count(*), count(*) - count(DISTINCT id), count(*) FILTER (id IS NULL) FROM raw_orders
        UNION ALL SELECT 'order_details', count(*), count(*) - count(DISTINCT (order_id, product_id, line_number)),
            count(*) FILTER (order_id IS NULL OR product_id IS NULL) FROM raw_order_details
        UNION ALL SELECT 'lineitem', count(*), count(*) - count(DISTINCT (l_orderkey, l_partkey)),
            count(*) FILTER (l_orderkey IS NULL OR l_partkey IS NULL) FROM lineitem""")
def src_contract_check(spark: SparkSession, sf: str) -> DataFrame:
    checks = [check_key(name, model._RAW[1][name](spark, sf), model.RAW_KEYS[name])
              for name in ("customers", "orders", "order_details")]
    checks.append(check_key("lineitem", raw.given(spark, sf, "lineitem"), ("l_orderkey", "l_partkey")))
    out = checks[0]
    for part in checks[1:]:
        out = out.unionByName(part)
    return out
