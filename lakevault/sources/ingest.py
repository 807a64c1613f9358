"""Declarative ingest: one specification per source, one load per table.

A load extracts rows at or after the stored cursor, lands them once (so that the source is read
once, whatever the write needs), writes them by disposition, and logs counts and the new cursor.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.operators.ordered import first_per_key
from lakevault.sources import drift, files, paged_api, relational
from lakevault.sources.tables import LOAD_ID, Lake

DISPOSITIONS = ("append", "replace", "merge")
DESTINATIONS = ("postgres", "duckdb", "lake")
TYPES = (*relational.DIALECTS, "rest_api", "filesystem")


@dataclass(frozen=True)
class TableSpec:
    name: str
    primary_key: tuple[str, ...] = ()
    write_disposition: str = "append"
    cursor: str | None = None
    initial_value: object = None
    options: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class IngestSpec:
    name: str
    type: str
    schema: str
    tables: tuple[TableSpec, ...]
    destination: str = "lake"
    options: Mapping = field(default_factory=dict)


def _table(entry: Mapping, default: str) -> TableSpec:
    key = entry.get("primary_key") or ()
    incremental = entry.get("incremental") or {}
    chosen = entry.get("write_disposition") or default
    if chosen not in DISPOSITIONS:
        raise ValueError(f"unknown write disposition {chosen!r}; allowed: {', '.join(DISPOSITIONS)}")
    spec = TableSpec(
        name=entry["name"], primary_key=(key,) if isinstance(key, str) else tuple(key),
        write_disposition=chosen, cursor=incremental.get("cursor"),
        initial_value=incremental.get("initial_value"), options=dict(entry))
    if chosen == "merge" and not spec.primary_key:
        raise ValueError(f"{spec.name}: merge needs a primary_key")
    return spec


def from_config(cfg: Mapping) -> IngestSpec:
    """A table's own disposition wins over the target's, the target's over ``append``."""
    kind = cfg["type"]
    if kind not in TYPES:
        raise ValueError(f"unknown source type: {kind}; allowed: {', '.join(TYPES)}")
    target = cfg.get("target") or {}
    destination = target.get("destination", "lake")
    if destination not in DESTINATIONS:
        raise ValueError(f"unknown destination type: {destination}; allowed: {', '.join(DESTINATIONS)}")
    default = target.get("write_disposition", "append")
    if kind == "filesystem":
        entries = [{**cfg, "name": cfg.get("resource_name") or cfg["name"]}]
    else:
        entries = cfg["resources"] if kind == "rest_api" else cfg["tables"]
    return IngestSpec(
        name=cfg["name"], type=kind, schema=target.get("schema") or f"raw_{cfg['name']}",
        tables=tuple(_table(e, default) for e in entries), destination=destination, options=dict(cfg))


def load_configs(folder: str) -> list[IngestSpec]:
    """All ``.json``, ``.yml`` and ``.yaml`` specifications of a folder; other endings are ignored."""
    specs = []
    for path in sorted(Path(folder).iterdir()):
        if path.suffix == ".json":
            specs.append(from_config(json.loads(path.read_text())))
        elif path.suffix in (".yml", ".yaml"):
            try:
                import yaml
            except ImportError as problem:
                raise RuntimeError(f"{path.name}: reading YAML needs the yaml package") from problem
            specs.append(from_config(yaml.safe_load(path.read_text())))
    return specs


# --- readers: (lake, spec, table, last cursor) -> DataFrame ---

def _read_files(lake: Lake, spec: IngestSpec, table: TableSpec, last) -> DataFrame:
    o = spec.options
    return files.read_drops(lake.spark, o["path"], o.get("file_glob", "*"), o.get("format"), o.get("schema"))


def _read_relational(lake: Lake, spec: IngestSpec, table: TableSpec, last) -> DataFrame:
    connection = relational.connection_options(spec.options, spec.options.get("connections"))
    split = table.primary_key[0] if len(table.primary_key) == 1 and table.options.get("numeric_key") else None
    return relational.read_table(lake.spark, connection, spec.options.get("source_schema"), table.name, split)


def _read_api(lake: Lake, spec: IngestSpec, table: TableSpec, last) -> DataFrame:
    o = table.options
    source = spec.options.get("reader", "paged_api")
    if source == "paged_api":
        paged_api.register(lake.spark, source)
    since = None if last is None else str(last)
    return paged_api.read_resource(
        lake.spark, source, spec.options["base_url"], o["endpoint"], o["schema"], params=o.get("params"),
        auth=spec.options.get("auth"), incremental=o.get("incremental"), last=since)


READERS: dict[str, Callable[..., DataFrame]] = {
    **{kind: _read_relational for kind in relational.DIALECTS},
    "rest_api": _read_api, "filesystem": _read_files,
}


# --- cursor state ---

_LOADS = ("pipeline string, dataset string, table_name string, load_id string, row_count bigint, "
          "write_disposition string, cursor_value string, cursor_type string")


def _loads_of(lake: Lake, pipeline: str, table: str) -> DataFrame | None:
    log = lake.read_or_none("meta", "loads")
    if log is not None:
        return log.where((F.col("pipeline") == pipeline) & (F.col("table_name") == table))
    return None


def cursor_type(lake: Lake, pipeline: str, table: str) -> str | None:
    """The type that holds every cursor value the finished loads of this table have stored."""
    loads = _loads_of(lake, pipeline, table)
    if loads is None:
        return None
    # one row per type the cursor column ever had
    types = sorted(r[0] for r in loads.where("cursor_value IS NOT NULL").select("cursor_type").distinct().collect())
    wide = drift.widest(types) if types else None
    if types and wide is None:
        raise ValueError(f"{pipeline}.{table}: the cursor had unrelated types ({', '.join(types)})")
    return wide


def last_cursor(lake: Lake, pipeline: str, table: str) -> str | None:
    """The highest cursor value any finished load of this table has stored, compared as values of
    the widest type the cursor had, whatever the load ids are."""
    kind = cursor_type(lake, pipeline, table)
    if kind is None:
        return None
    return _loads_of(lake, pipeline, table).agg(F.max(F.col("cursor_value").cast(kind)).cast("string")).first()[0]


def _cursor_literal(df: DataFrame, cursor: str, start, kind: str | None = None):
    """A start as a literal of the cursor column's type, or of the wider one that a stored start had;
    text that is none fails the load."""
    own = df.schema[cursor].dataType.simpleString()
    wide = drift.widest([own, kind]) if kind else own
    if wide is None:
        raise ValueError(f"{cursor}: the cursor's type changed from {kind} to {own}")
    return F.lit(str(start)).cast(wide)


def since_cursor(df: DataFrame, cursor: str, start, kind: str | None = None) -> DataFrame:
    """Rows at or after ``start``. The literal has the column's type where that can hold it, so the
    filter is pushed to the source."""
    return df if start is None else df.where(F.col(cursor) >= _cursor_literal(df, cursor, start, kind))


def without_loaded(lake: Lake, spec: IngestSpec, table: TableSpec, landed: DataFrame, last, load_id: str) -> DataFrame:
    """Rows at the cursor's last value come from the source a second time; those the table holds
    already (by key, else by their whole content) are left out. Only rows at that one value are
    compared."""
    if last is None or not lake.exists(spec.schema, table.name):
        return landed
    held = lake.read(spec.schema, table.name)
    shape, goes = drift.merged(T.StructType([f for f in held.schema if f.name != LOAD_ID]), landed.schema)
    start = _cursor_literal(landed, table.cursor, last, held.schema[table.cursor].dataType.simpleString())
    at = F.col(table.cursor) == start
    known = drift.aligned(held.where((F.col(LOAD_ID) != load_id) & at), shape, {c: c for c in shape.names if c in held.columns})
    on = list(table.primary_key) or [goes[f.name] for f in landed.schema if not isinstance(f.dataType, T.MapType)]
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"l.`{c}`").eqNullSafe(F.col(f"k.`{c}`"))
    rows = drift.aligned(landed, shape, goes)
    boundary = rows.where(at).alias("l").join(known.select(*on).alias("k"), same, "left_anti")
    return rows.where(F.col(table.cursor) > start).unionByName(boundary)


# --- the load ---

def _repeats(rows: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key may be there twice: false only if all hashes of keys differ, and so the keys."""
    hashed = rows.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return not hashed.where("n > 1").isEmpty()


def _to_database(spec: IngestSpec, table: TableSpec, landed: DataFrame) -> None:
    if table.write_disposition == "merge":
        raise ValueError(f"{table.name}: a JDBC target takes append and replace only")
    target = {**spec.options["target"], "type": spec.destination}
    connection = relational.connection_options(target, spec.options.get("connections"))
    mode = "overwrite" if table.write_disposition == "replace" else "append"
    relational.write_table(landed, connection, spec.schema, table.name, mode)


def load_table(lake: Lake, spec: IngestSpec, table: TableSpec, load_id: str) -> dict:
    """Load one table; a load id that is in the log already is not loaded again."""
    log = _loads_of(lake, spec.name, table.name)
    done = log.where(F.col("load_id") == load_id).first() if log is not None else None
    if done:
        return done.asDict()
    last = last_cursor(lake, spec.name, table.name) if table.cursor else None
    start = last if last is not None else table.initial_value
    rows = READERS[spec.type](lake, spec, table, start)
    if table.cursor:
        rows = since_cursor(rows, table.cursor, start, cursor_type(lake, spec.name, table.name))

    seen = Observation()
    newest = F.max(F.col(table.cursor)).cast("string") if table.cursor else F.lit(None).cast("string")
    landing = f"{lake.root}/landing/{spec.name}/{table.name}/{load_id}"
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("newest")).write.mode(
        "overwrite").parquet(landing)
    landed = lake.spark.read.schema(rows.schema).parquet(landing)

    if spec.destination != "lake":
        _to_database(spec, table, landed)
    elif table.write_disposition == "merge":
        order = [F.col(table.cursor).desc()] if table.cursor else []
        whole_row = F.xxhash64(*[F.col(f.name) for f in rows.schema if not isinstance(f.dataType, T.MapType)])
        # whole rows are shuffled only where a key may be there twice
        unique = first_per_key(landed, list(table.primary_key), [*order, whole_row]) if _repeats(landed, table.primary_key) else landed
        lake.ensure(spec.schema)
        lake.merge(spec.schema, table.name, unique, table.primary_key, check=False)
    elif table.write_disposition == "replace":
        lake.ensure(spec.schema)
        lake.replace(spec.schema, table.name, landed)
    else:
        fresh = without_loaded(lake, spec, table, landed, last, load_id) if table.cursor else landed
        lake.append_load(spec.schema, table.name, fresh, load_id)

    # one row holds counts and cursor and is written last: a load that died before it leaves no state,
    # and starts again from what the other loads have stored
    result = {"pipeline": spec.name, "dataset": spec.schema, "table_name": table.name, "load_id": load_id,
              "row_count": seen.get["rows"], "write_disposition": table.write_disposition,
              "cursor_value": seen.get["newest"],
              "cursor_type": rows.schema[table.cursor].dataType.simpleString() if table.cursor else None}
    lake.append("meta", "loads", lake.spark.createDataFrame([tuple(result.values())], _LOADS))
    lake.remove_folder(landing)
    return result


def ingest(lake: Lake, spec: IngestSpec, load_id: str) -> list[dict]:
    """Load every table of a source; returns the load metadata."""
    return [load_table(lake, spec, table, load_id) for table in spec.tables]
