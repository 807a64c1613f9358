"""The stored warehouse: full run, delta run, historised-staging run."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakevault.operators import history as scd
from lakevault.operators import quality
from lakevault.operators.staging import dealt, stage
from lakevault.operators.vault import HubSpec, LinkSpec, SatSpec, count_tables, key_rows, sat_rows
from lakevault.plans import increments, marts, model, suite
from lakevault.session import work_folder
from lakevault.sources.contracts import require_key
from lakevault.sources.tables import Lake, buckets_for, folder_bytes

PARALLEL = 8  # independent tables loaded at the same time
#: compressed input per bucket; rows of the vault are some ten times as large in memory, and a task sorts a bucket
BUCKET_BYTES = 16 << 20

# Models with their tags and direct upstreams, in dependency order.
TAGS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    **{f"stg_{t}": (("staging",), ()) for t in model.RAW_KEYS},
    "stg_customers_psa": (("staging", "psa"), ()),
    **{n: (("raw_vault", s.branch), (f"stg_{s.source}",))
       for group in (model.HUBS, model.LINKS, model.SATS, model.PSA_HUBS, model.PSA_SATS)
       for n, s in group.items()},
    **{n: (("raw_vault", "pit"), (hub, *sats)) for n, (hub, sats) in model.PITS.items()},
    "mart_revenue_per_customer": (("mart",), (
        "hub_customer", "sat_customer", "lnk_order_customer", "lnk_order_product", "sat_order_detail")),
    "mart_order_overview": (("mart",), (
        "hub_order", "sat_order", "hub_customer", "sat_customer", "hub_employee", "sat_employee",
        "lnk_order_customer", "lnk_order_employee", "lnk_order_product", "sat_order_detail")),
    "mart_product_sales": (("mart",), (
        "hub_product", "sat_product", "lnk_order_product", "sat_order_detail")),
}


def _tags_of(name: str) -> set[str]:
    domain = {d for d, names in model.DOMAINS.items() if name in names}
    return set(TAGS[name][0]) | domain


def select_models(tags: Iterable[str] = (), exclude: Iterable[str] = (), names: Iterable[str] = (),
                  upstream: bool = False, all_of: Iterable[str] = ()) -> list[str]:
    """Model names in dependency order: any of ``tags`` or ``names`` (all models when neither is
    given), every tag of ``all_of``, none of ``exclude``; ``upstream`` adds what they are built from."""
    tags, exclude, names, all_of = set(tags), set(exclude), set(names), set(all_of)
    unknown = names - TAGS.keys()
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    chosen = {
        n for n in TAGS
        if (n in names or tags & _tags_of(n) or not (tags or names)) and all_of <= _tags_of(n)
    }
    if upstream:
        waiting = list(chosen)
        while waiting:
            for parent in TAGS[waiting.pop()][1]:
                if parent not in chosen:
                    chosen.add(parent)
                    waiting.append(parent)
    return [n for n in TAGS if n in chosen and not exclude & _tags_of(n)]


def spread_of(spec: HubSpec | LinkSpec | SatSpec) -> str | None:
    """The column a vault table's rows lie by; none where a key may have very many."""
    if isinstance(spec, SatSpec):
        return spec.pk if spec.one_row_per_key else None
    return getattr(spec, "lies_by", "") or spec.pk


#: the column that the rows of a stored vault table lie by
LIES_BY = {n: spread_of(s) for n, s in {**model.HUBS, **model.LINKS, **model.SATS}.items()}
#: the columns of the vault that hold MD5 texts
HASHED = {k for s in {**model.HUBS, **model.LINKS, **model.SATS}.values() for k in (s.pk, *getattr(s, "fks", ()))}


def _each(items: Sequence, job: Callable) -> None:
    with ThreadPoolExecutor(PARALLEL) as pool:
        list(pool.map(job, items))


class Tables:
    """The stored vault as ``tables[name]``."""

    def __init__(self, lake: Lake):
        self.lake = lake

    def __getitem__(self, name: str) -> DataFrame:
        if name.startswith("stg_"):
            return self.staged(name.removeprefix("stg_"))
        return self.lake.read("mart" if name.startswith("mart_") else "raw_vault", name)

    def staged(self, table: str, by: str | None = None) -> DataFrame:
        """Staging over a raw table; with ``by`` its rows are dealt to the buckets of that key before they are hashed."""
        spec, rows = model.STAGING[table], self.lake.read("raw", table)
        return stage(dealt(rows, spec, by, self.lake.buckets) if by else rows, spec)


def load_raw(lake: Lake, spark, sf_dir: str, batch: int = 1) -> None:
    """Upsert a delivery; a first one just fills the tables."""
    deliveries = {t: d for t, d in model._RAW[batch].items() if t in model.RAW_KEYS}
    _each(list(deliveries), lambda t: lake.merge("raw", t, deliveries[t](spark, sf_dir), model.RAW_KEYS[t]))


def load_vault(lake: Lake, staged: Callable[[str], DataFrame | None], names: Iterable[str], keep: bool = False,
               dealt_by: Callable[[str, str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Append what the staged sources bring that is not stored yet; with ``keep`` returns these rows.

    A table that is not there yet takes its source as ``dealt_by`` a key, if given: all rows of it are stored.
    """
    added: dict[str, DataFrame] = {}
    specs = {**model.HUBS, **model.LINKS, **model.SATS, **model.PSA_HUBS, **model.PSA_SATS}

    def load(name: str) -> None:
        spec: HubSpec | LinkSpec | SatSpec = specs[name]
        rule = sat_rows if isinstance(spec, SatSpec) else key_rows
        spread = spread_of(spec)
        if dealt_by is not None and spread and spec.one_row_per_key and not lake.exists("raw_vault", name):
            lake.append("raw_vault", name, rule(dealt_by(spec.source, spread), None, spec), bucket_by=spread, dealt=True)
            return
        source = staged(spec.source)
        if source is None:
            return
        # a delta of few keys reads the files that may hold them
        target = lake.holding("raw_vault", name, spec.pk, source) if lake.exists("raw_vault", name) else None
        rows = rule(source, target, spec)
        if keep:
            rows = added[name] = lake.landed(rows, name)
        lake.append("raw_vault", name, rows, bucket_by=spread)

    _each([n for n in names if n in specs], load)
    return added


def build_pits(lake: Lake, names: Iterable[str], dates: Sequence[datetime]) -> None:
    _each([n for n in names if n in model.PITS], lambda n: increments.build_pit(lake, n, Tables(lake), dates))


def build_marts(lake: Lake, names: Iterable[str]) -> None:
    """Totals and marts from the whole vault."""
    wanted = [n for n in names if n in marts.MARTS]
    if wanted:
        increments.build_totals(lake, Tables(lake))
        _each(wanted, lambda n: increments.build_mart(lake, n, Tables(lake)))


def run_tests(lake: Lake, run_ts: datetime, run_id: str, tests: Sequence[quality.Test] | None = None,
              store_failures: bool = False) -> DataFrame:
    """Run the suite on the stored tables and append the results; returns the stored rows of the run.

    ``store_failures`` keeps the failing rows of each test that has some as a table of its own.
    """
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    tests = tests if tests is not None else suite.staging_tests() + suite.vault_tests(now) + suite.mart_tests()
    tables = Tables(lake)

    def run_model(name: str) -> list:
        # one row per declared test comes back, whatever the size of the model
        return quality.run(tables, [t for t in tests if t.model == name], LIES_BY, HASHED).collect()

    with ThreadPoolExecutor(PARALLEL) as pool:
        rows = [r for part in pool.map(run_model, dict.fromkeys(t.model for t in tests)) for r in part]
    results = lake.spark.createDataFrame(rows, quality.RESULT_SCHEMA)
    persist(lake, "test_results", results, run_ts, run_id)
    if store_failures:
        broken = {(r["model"], r["test"], r["column"]) for r in rows if r["failures"]}
        for test in tests:
            if (test.model, test.name, test.label) in broken and quality.has_failing_rows(test):
                name = "_".join([test.name, test.model, *test.columns])
                lake.replace("dq_audit", name, quality.failing_rows(tables, test))
    return lake.read("dq", "test_results").where(F.col("run_id") == run_id)


def run_freshness(lake: Lake, run_ts: datetime, run_id: str) -> DataFrame:
    """Measure the age of the raw tables and append it."""
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    tables = {rule.table: lake.read("raw", rule.table) for rule in suite.FRESHNESS}
    persist(lake, "source_freshness", quality.source_freshness(tables, suite.FRESHNESS, now), run_ts, run_id)
    return lake.read("dq", "source_freshness").where(F.col("run_id") == run_id)


def persist(lake: Lake, table: str, results: DataFrame, run_ts: datetime, run_id: str) -> None:
    """Append one run to a result log; a run that is stored already is not stored twice."""
    stamped = results.withColumns({
        "run_id": F.lit(run_id), "run_at": F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz"),
        "run_date": F.lit(run_ts.date().isoformat()).cast("date"),
    })
    if lake.exists("dq", table):
        done = lake.read("dq", table).where(
            (F.col("run_date") == F.lit(run_ts.date().isoformat()).cast("date")) & (F.col("run_id") == run_id))
        if not done.isEmpty():
            return
    lake.append("dq", table, stamped, partition_by=["run_date"])


def build_all(lake: Lake, spark, sf_dir: str, dates: Sequence[datetime], names: Sequence[str] | None = None) -> None:
    """Raw, vault, point-in-time tables and marts from the first delivery."""
    names = list(names) if names is not None else select_models(exclude=["psa"])
    tables = Tables(lake)
    load_raw(lake, spark, sf_dir)
    load_vault(lake, tables.staged, names, dealt_by=tables.staged)
    increments.side_by_side([lambda: build_pits(lake, names, dates), lambda: build_marts(lake, names)])


def apply_delta(lake: Lake, spark, sf_dir: str, dates: Sequence[datetime]) -> None:
    """Upsert the delta into raw, load its rows into the vault, and bring what is derived up to date with them."""
    load_raw(lake, spark, sf_dir, batch=2)
    changed = model._RAW[2]

    def staged(source: str) -> DataFrame | None:
        return model.staged(spark, sf_dir, source, 2) if source in changed else None

    names = select_models(exclude=["psa"])
    deltas = load_vault(lake, staged, names, keep=True)
    tables = Tables(lake)
    pits = [lambda n=n: increments.update_pit(lake, n, tables, deltas, dates) for n in names if n in model.PITS]
    increments.side_by_side([*pits, lambda: increments.update_marts(lake, tables, deltas, names)])


_BUILT: dict[tuple[str, str], Lake] = {}


def warehouse(spark, sf_dir: str, dates: Sequence[datetime]) -> Lake:
    """The stored warehouse over the first delivery, built once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        lake = new_lake(spark, sf_dir)
        build_all(lake, spark, sf_dir, dates)
        _BUILT[key] = lake
    return _BUILT[key]


def changed_warehouse(spark, sf_dir: str, dates: Sequence[datetime]) -> Lake:
    """The stored warehouse after a delta run, built once per application and input. It takes its point-in-time
    tables from all but the last date, so that the run has a date to add."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} after delta")
    if key not in _BUILT:
        lake = new_lake(spark, sf_dir)
        build_all(lake, spark, sf_dir, dates[:-1])
        apply_delta(lake, spark, sf_dir, dates)
        _BUILT[key] = lake
    return _BUILT[key]


def new_lake(spark, input_folder: str | None = None) -> Lake:
    """An empty warehouse in a fresh part of the work folder, with databases of its own, its bucket
    count chosen for the size of the input."""
    root = work_folder(spark, "lake")
    size = folder_bytes(spark, input_folder) if input_folder else 0
    return Lake(spark, root, env_prefix="lv_" + root.rsplit("-", 1)[1], buckets=buckets_for(size, BUCKET_BYTES))


# --- historised staging ---

#: a snapshot of the open versions is stored when so many events per open version came since the last one
SNAPSHOT_AFTER = 0.5


def _open_versions(lake: Lake, spec: scd.Scd2Spec, table: str, state: dict) -> DataFrame:
    """The open versions after the last run: its snapshot, what was opened since, without what was closed since."""
    log = lake.spark.table(f"{lake.name('psa', table)}__log").where(F.col("ng_run") <= state["run"])
    held = (F.col("ng_run") == state["base"]) & (F.col("ng_kind") == state["base_kind"])
    since = F.col("ng_run") > state["base"]
    closed = log.where(since & (F.col("ng_kind") == "closed")).select(spec.surrogate)
    return log.where(held | since & (F.col("ng_kind") == "opened")).join(closed, spec.surrogate, "left_anti")


def psa_state(lake: Lake, table: str) -> dict | None:
    return json.loads(lake.spark.catalog.getTable(lake.name("psa", table)).description) if lake.exists("psa", table) else None


def psa_run(lake: Lake, spec: scd.Scd2Spec, table: str, source: DataFrame, run_ts: datetime,
            detect_deletes: bool = True) -> None:
    """Apply one full delivery to a stored history.

    A run appends the versions it opened and closed to a log, and nothing else; when enough events have
    come together, also a snapshot of the open versions, so that the next run need not read the whole
    log. The view is replaced last and names the newest run it trusts, so a run becomes visible at
    once, and one that died half way is written anew when it is repeated. Applying a run a second time
    does nothing; another delivery under the time of the last run, or an older run, is refused.
    """
    run = int((run_ts - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    view, log = lake.name("psa", table), f"{lake.name('psa', table)}__log"
    state = psa_state(lake, table)
    if state is not None and run < state["run"]:
        raise ValueError(f"psa.{table}: a run at {run_ts} is older than the last one")
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    cleaned = scd.clean(source, spec)
    require_key(spec.source, cleaned, [spec.key])
    if state is not None and run == state["run"]:
        if not scd.delivery_events(_open_versions(lake, spec, table, state), cleaned, spec, now, detect_deletes).isEmpty():
            raise ValueError(f"psa.{table}: another delivery was applied at {run_ts} already")
        return
    if state is None:
        events = scd.first_events(cleaned, spec, now)
    else:
        events = scd.delivery_events(_open_versions(lake, spec, table, state), cleaned, spec, now, detect_deletes)
    seen = Observation()
    counted = events.observe(seen, F.count_if(F.col("ng_kind") == "opened").alias("opened"), F.count_if(F.col("ng_kind") == "closed").alias("closed"))
    rows = counted.withColumn("ng_run", F.lit(run).cast("bigint"))
    if lake.exists("psa", f"{table}__log"):
        # what a run that died left behind
        lake.drop_partitions("psa", f"{table}__log", lambda values: int(values["ng_run"]) > (state["run"] if state else -(2**63)))
        _append_events(lake, log, rows)
    else:
        rows.write.partitionBy("ng_run", "ng_kind").format("parquet").saveAsTable(log)
        lake.spark.catalog.refreshTable(log)
    if state is None:
        state = {"run": run, "base": run, "base_kind": "opened", "held": seen.get["opened"], "since": 0}
    else:
        state = {**state, "run": run, "since": state["since"] + seen.get["opened"] + seen.get["closed"]}
        if state["since"] > SNAPSHOT_AFTER * max(state["held"], 1):
            open_ = Observation()
            held = _open_versions(lake, spec, table, state).withColumns({"ng_kind": F.lit("open"), "ng_run": F.lit(run).cast("bigint")})
            _append_events(lake, log, held.observe(open_, F.count(F.lit(1)).alias("rows")))
            state = {"run": run, "base": run, "base_kind": "open", "held": open_.get["rows"], "since": 0}
    lake.spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT '{json.dumps(state)}' AS {scd.versions_sql(log, spec, run)}")


def _append_events(lake: Lake, log: str, rows: DataFrame) -> None:
    rows.select(*lake.spark.table(log).columns).write.mode("append").insertInto(log)
    lake.spark.catalog.refreshTable(log)


def psa_vault(lake: Lake, table: str = "customers_psa") -> None:
    """Hub and satellite on top of the current view."""
    current = scd.current_view(lake.read("psa", table))
    load_vault(lake, lambda s: stage(current, model.STAGING[s]), [*model.PSA_HUBS, *model.PSA_SATS])


def psa_rebuild(lake: Lake, table: str = "customers_psa") -> DataFrame:
    """Drop the PSA branch of the vault, load it again, and count."""
    names = [*model.PSA_HUBS, *model.PSA_SATS]
    for name in names:
        lake.drop("raw_vault", name)
    psa_vault(lake, table)
    return count_tables({"psa_current": scd.current_view(lake.read("psa", table)),
                         **{n: lake.read("raw_vault", n) for n in names}})
