"""Stored tables: one Spark database per layer, Parquet underneath.

Five ways to store, by how a table changes:

* ``append``: insert-only tables (vault, result logs), optionally bucketed by their key so that
  joins and per-key windows on it need no shuffle;
* ``replace``: rebuilt tables (marts, point-in-time tables). The new content becomes a table of its
  own and a view is pointed at it, so readers never see half a table;
* ``refresh``: derived tables that take changes (marts, totals, point-in-time tables). Rows lie in cells
  (a hash bucket of their key, or a column such as a date); only cells that hold changed keys are
  written anew, rows of new keys are added next to them, and the view names the run each cell counts
  from;
* ``append_load``: raw loads, one partition each; a repeated load overwrites its own;
* ``merge``: keyed raw tables. A delivery is a partition like any load, and nothing else is written.
  The table is a view: the newest delivered row of a key, else its base row; keys with NULL parts are
  keys like others. After ``FOLD_AFTER`` deliveries the content is stored as a new base partition and
  the view starts there.

Raw tables take schema drift: a delivery that brings new columns or wider types opens a new store of
that shape, and the view reads older stores through casts; values of an unrelated type go to a variant
column (``lakevault.sources.drift``). Nothing that is stored is rewritten for it. The view names the
loads it trusts and is replaced last, so a load that died is not seen. One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from threading import Lock
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.operators.vault import count_tables
from lakevault.sources import drift, keyfilter
from lakevault.sources.contracts import require_key

LAYERS = ("raw", "staging", "raw_vault", "psa", "mart", "dq", "dq_audit", "meta")
MERGE = "_merge_no"
LOAD_ID = "_load_id"
RUN, BUCKET = "_run", "_bucket"
#: metastores bound the length of a comment
COMMENT_CHARS = 3000
#: deliveries to a keyed table that are read one by one before they are folded into a new base
FOLD_AFTER = 16
# kept with a table when it is created, so that later inserts follow them: hash keys are stored as 32 hex digits, of
# which only a codec with an entropy coder makes 16 bytes again
PACKED = {"compression": "zstd"}
# an overwriting insert replaces only the partitions it brings
BY_PARTITION = {"partitionOverwriteMode": "dynamic", **PACKED}


class ProtectedTableError(RuntimeError):
    pass


def layer_name(layer: str, target: str = "", env_prefix: str = "") -> str:
    """The layer's own name, else the target's; an environment prefix goes in front."""
    name = layer.strip() or target
    return f"{env_prefix}_{name}" if env_prefix else name


def folder_bytes(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def buckets_for(size: int, bucket_bytes: int = 512 << 20, least: int = 8) -> int:
    """A power of two, so that a later, larger choice still lines up with an earlier one."""
    buckets = least
    while buckets * bucket_bytes < size:
        buckets *= 2
    return buckets


class Lake:
    """``root`` is a folder all executors reach. ``buckets`` has to grow with the data, see
    ``buckets_for``; it is the same for all tables, so that their buckets line up in joins."""

    def __init__(self, spark: SparkSession, root: str, env_prefix: str = "", buckets: int = 8,
                 protected: Sequence[str] = ("raw_vault",)):
        self.spark, self.root, self.env_prefix = spark, root.rstrip("/"), env_prefix
        self.buckets, self.protected = buckets, tuple(protected)
        self._log = Lock()
        for layer in LAYERS:
            self.ensure(layer)

    def ensure(self, layer: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db(layer)} LOCATION '{self.root}/{layer}'")

    def db(self, layer: str) -> str:
        return layer_name(layer, env_prefix=self.env_prefix)

    def name(self, layer: str, table: str) -> str:
        return f"{self.db(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def read_or_none(self, layer: str, table: str) -> DataFrame | None:
        return self.read(layer, table) if self.exists(layer, table) else None

    # --- append ---

    def append(self, layer: str, table: str, df: DataFrame, bucket_by: str | None = None,
               partition_by: Sequence[str] = (), dealt: bool = False) -> None:
        """``bucket_by`` is for columns without frequent values, such as the key of a hub; rows that are ``dealt``
        lie by it already."""
        if bucket_by:
            # one task per bucket writes one file; the same hash places rows for later joins
            writer = (df if dealt else df.repartition(self.buckets, bucket_by)).write.bucketBy(self.buckets, bucket_by)
        elif partition_by:
            writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
        else:
            writer = df.write
        writer.options(**PACKED).mode("append").format("parquet").saveAsTable(self.name(layer, table))
        self._written(layer, table)

    def _written(self, layer: str, table: str) -> None:
        """A streaming micro-batch writes in a session of its own; forget this one's file listing."""
        self.spark.catalog.refreshTable(self.name(layer, table))

    def holding(self, layer: str, table: str, key: str, source: DataFrame, most_keys: int = keyfilter.MOST_KEYS,
                least_files: int = keyfilter.LEAST_FILES) -> DataFrame:
        """An insert-only table without the files that hold none of the source's keys.

        All of it where the source has too many keys or the table few files. A file's filter is kept in
        ``meta``, a row per file.
        """
        stored = self.read(layer, table)
        listed = stored.inputFiles()
        if len(listed) < least_files:
            return stored
        hashes = [r[0] for r in source.select(F.xxhash64(key)).distinct().limit(most_keys + 1).collect()]
        if len(hashes) > most_keys:
            return stored
        name = f"{layer}__{table}__filters"
        known = {r[0] for r in self.read("meta", name).select("file").distinct().collect()} if self.exists("meta", name) else set()
        plain = {unquote(f.split(":", 1)[1].replace("///", "/")): f for f in listed}
        place = lambda file: unquote(file.split(":", 1)[1].replace("///", "/"))
        known = {place(f) for f in known}
        fresh = [plain[f] for f in plain.keys() - known]
        if fresh:
            rows = self.spark.read.schema(stored.schema).parquet(*fresh)
            self.append("meta", name, keyfilter.filters_of(rows, key))
        chosen = [plain[place(f)] for f in keyfilter.files_holding(self.read("meta", name), hashes) if place(f) in plain]
        return self.spark.read.schema(stored.schema).parquet(*chosen) if chosen else stored.limit(0)

    # --- replace ---

    def replace(self, layer: str, table: str, df: DataFrame, force: bool = False,
                partition_by: Sequence[str] = ()) -> None:
        if layer in self.protected and not force:
            raise ProtectedTableError(f"{layer}.{table} is insert-only; drop it to rebuild it")
        versions = self._numbered(layer, table, "__v")
        shown = self._shown_version(layer, table)
        fresh = max(versions, default=0) + 1
        stored = f"{self.name(layer, table)}__v{fresh}"
        writer = df.hint("rebalance", *partition_by) if partition_by else df
        writer.write.options(**PACKED).partitionBy(*partition_by).format("parquet").saveAsTable(stored)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} COMMENT 'v{fresh}' "
                       f"AS SELECT * FROM {stored}")
        # the version shown until now stays for readers that are still on it
        for old in versions:
            if old != shown:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}__v{old}")

    def _numbered(self, layer: str, table: str, mark: str) -> list[int]:
        prefix = f"{table}{mark}"
        names = [t.name for t in self.spark.catalog.listTables(self.db(layer), f"{prefix}*")]
        return [int(n.removeprefix(prefix)) for n in names if n.removeprefix(prefix).isdigit()]

    def _shown_version(self, layer: str, table: str) -> int | None:
        if not self.exists(layer, table):
            return None
        comment = self.spark.catalog.getTable(self.name(layer, table)).description or ""
        return int(comment[1:]) if comment[1:].isdigit() else None

    # --- refresh ---

    def landed(self, df: DataFrame, purpose: str) -> DataFrame:
        """Store rows that are read several times; plans above them know their true size."""
        path = f"{self.root}/landing/{purpose}/{uuid.uuid4().hex[:12]}"
        df.write.options(**PACKED).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _cells(self, df: DataFrame, cell: str, key: Sequence[str]) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")) if cell == BUCKET else df

    def _bases(self, layer: str, table: str, state: dict) -> dict[str, int]:
        """The run that each rewritten cell counts from; a value per cell at most."""
        if "bases" in state:
            return {cell: int(run) for run, cells in state["bases"].items() for cell in cells}
        with self._log:
            cells = self.read("meta", "cells")
        own = cells.where((F.col("table_name") == f"{layer}.{table}") & (F.col("run") == state["run"]))
        return dict(own.select("cell", "base").collect())

    def _with_bases(self, layer: str, table: str, state: dict, bases: Mapping[str, int]) -> dict:
        """Few are kept in the view's comment, many as rows of ``meta.cells``."""
        by_run: dict[int, list[str]] = {}
        for cell, run in sorted(bases.items()):
            by_run.setdefault(run, []).append(cell)
        if len(json.dumps(by_run)) <= COMMENT_CHARS:
            return {**state, "bases": by_run}
        rows = [(f"{layer}.{table}", state["run"], cell, run) for cell, run in bases.items()]
        with self._log:  # tables are refreshed side by side, and this one takes one writer at a time
            # a partition per table, so that it can be dropped with it
            self.append("meta", "cells", self.spark.createDataFrame(rows, "table_name string, run int, cell string, base int").coalesce(1),
                        partition_by=["table_name"])
        return state

    def _trusted(self, kind: T.DataType, state: dict, bases: Mapping[str, int]) -> str:
        by_run: dict[int, list[str]] = {}
        for value, base in bases.items():
            by_run.setdefault(base, []).append(value)
        text = "".join(
            f" AND NOT ({RUN} < {base} AND `{state['cell']}` IN ({', '.join(f'CAST({v!r} AS {kind.simpleString()})' for v in sorted(values))}))"
            for base, values in sorted(by_run.items()) if base > state["from"])
        return f"{RUN} BETWEEN {state['from']} AND {state['run']}{text}"

    def refresh(self, layer: str, table: str, key: Sequence[str], rows: DataFrame | None = None, added: DataFrame | None = None,
                cell: str = BUCKET, whole: bool = False) -> None:
        """Bring a derived table up to date.

        ``rows`` replace what is stored under their keys, ``added`` have keys that are not stored yet. With
        ``whole`` (and the first time) they are all the table holds. They are written first; the cells that
        ``rows`` came to lie in are then completed with the stored rows of other keys.
        """
        store = f"{self.name(layer, table)}__r"
        state = json.loads(self.spark.catalog.getTable(self.name(layer, table)).description) if self.exists(layer, table) else None
        whole = whole or state is None
        run = state["run"] + 1 if state else 1
        old = {} if whole else self._bases(layer, table, state)
        if self.exists(layer, f"{table}__r"):
            # what a refresh that died left behind
            self._remove_partitions(layer, f"{table}__r", f"*/{RUN}={run}")
        put = lambda df, number: self._put_cells(layer, table, cell, key, df, number, as_they_lie=whole and cell != BUCKET)
        touched: list[str] = []
        if rows is not None:
            put(rows, run)
            touched = [] if whole else self._partition_values(layer, f"{table}__r", f"*/{RUN}={run}")
        if added is not None:
            put(added, run)
        stored = self.spark.table(store)
        kind = stored.schema[cell].dataType
        if touched:
            listed = F.col(cell).isin([F.lit(v).cast(kind) for v in touched])
            kept = stored.where(self._trusted(kind, state, old)).where(listed).drop(RUN)
            fresh = stored.where((F.col(RUN) == run) & listed).select(*key)
            put(kept.join(fresh, list(key), "left_anti"), run)
        bases = {**old, **dict.fromkeys(touched, run)}
        state = self._with_bases(layer, table, {"run": run, "from": run if whole else state["from"], "cell": cell}, bases)
        shown = [f"`{c}`" for c in stored.columns if c not in (RUN, BUCKET)]
        self._show(layer, table, f"SELECT {', '.join(shown)} FROM {store} WHERE {self._trusted(kind, state, bases)}", state)
        # what the last state did not show any more, nobody reads
        if old or whole and run > 2:
            self.drop_partitions(layer, f"{table}__r", lambda values: int(values[RUN]) < (run - 1 if whole else old.get(unquote(values[cell]), 0)))

    def _put_cells(self, layer: str, table: str, cell: str, key: Sequence[str], df: DataFrame, run: int, as_they_lie: bool = False) -> None:
        """Rows of a cell come together first, unless every task holds so many of each of a few cells that its files are large."""
        store = f"{self.name(layer, table)}__r"
        content = df if cell in df.columns else self._cells(df, cell, key)
        content = content.withColumn(RUN, F.lit(run))
        content = content if as_they_lie else content.hint("rebalance", cell)
        if self.exists(layer, f"{table}__r"):
            drift.aligned(content, self.spark.table(store).schema).write.mode("append").insertInto(store)
        else:
            content.write.options(**PACKED).partitionBy(cell, RUN).format("parquet").saveAsTable(store)
        self._written(layer, f"{table}__r")

    def _partitions(self, layer: str, table: str, pattern: str):
        """The partition folders that fit a pattern, and their file system."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{layer}/{table}")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [f.getPath() for f in files.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or ()], files

    def _partition_values(self, layer: str, table: str, pattern: str) -> list[str]:
        """The values of the first partition column, of partitions that fit a pattern."""
        return [unquote(p.getParent().getName().partition("=")[2]) for p in self._partitions(layer, table, pattern)[0]]

    def _remove_partitions(self, layer: str, table: str, pattern: str) -> None:
        """Remove partitions that no reader sees yet."""
        found, files = self._partitions(layer, table, pattern)
        for path in found:
            files.delete(path, True)
        if found:
            self.spark.catalog.refreshTable(f"{self.db(layer)}.{table}")

    # --- loads and merges: stores by shape, a view over them ---

    def _state(self, layer: str, table: str) -> dict:
        """What the table's view trusts: its stores and, of a keyed table, key, base and newest delivery."""
        if not self.exists(layer, table):
            return {"stores": []}
        return json.loads(self.spark.catalog.getTable(self.name(layer, table)).description)

    def _store(self, layer: str, table: str, number: int) -> str:
        return f"{self.name(layer, table)}__s{number}"

    def _put(self, layer: str, table: str, rows: DataFrame, partition: str, value) -> tuple[list[int], T.StructType]:
        """Write a partition into the newest store, or a new one if the rows bring another shape."""
        stores = self._state(layer, table)["stores"]
        if stores:
            known = T.StructType([f for f in self.spark.table(self._store(layer, table, stores[-1])).schema if f.name != partition])
            shape, goes = drift.merged(known, rows.schema)
        else:
            known, (shape, goes) = None, drift.merged(T.StructType([]), rows.schema)
        content = drift.aligned(rows, shape, goes).withColumn(partition, F.lit(value))
        if known is not None and drift.same_shape(known, shape):
            content.write.mode("overwrite").insertInto(self._store(layer, table, stores[-1]))
            self.spark.catalog.refreshTable(self._store(layer, table, stores[-1]))
            return stores, shape
        fresh = max(self._numbered(layer, table, "__s"), default=0) + 1
        content.write.options(**BY_PARTITION).partitionBy(partition).format("parquet").saveAsTable(self._store(layer, table, fresh))
        return [*stores, fresh], shape

    def _stored_rows(self, layer: str, table: str, stores: Sequence[int], shape: T.StructType) -> str:
        """SQL over all stores in the newest one's shape."""
        parts = []
        for number in stores:
            name = self._store(layer, table, number)
            parts.append(f"SELECT {', '.join(drift.select_list(self.spark.table(name).schema, shape))} FROM {name}")
        return " UNION ALL ".join(parts)

    def _show(self, layer: str, table: str, body: str, state: dict) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} COMMENT '{json.dumps(state)}' AS {body}")

    def append_load(self, layer: str, table: str, df: DataFrame, load_id: str) -> None:
        """Append a load as a partition of its own; loading it again overwrites only that partition."""
        self.ensure(layer)
        stores, shape = self._put(layer, table, df, LOAD_ID, load_id)
        shape = T.StructType([*shape, T.StructField(LOAD_ID, T.StringType())])
        self._show(layer, table, self._stored_rows(layer, table, stores, shape), {"stores": stores})

    def merge(self, layer: str, table: str, delta: DataFrame, keys: Sequence[str], check: bool = True) -> None:
        """Insert new keys and replace the whole row of known ones; a key twice in a batch is an error.

        A delivery is written as it is, so its cost is its own size, however its keys are spread.
        Without ``check`` the caller answers for its keys; NULL parts are then values like others.
        """
        state = self._state(layer, table)
        if state["stores"]:
            moved = drift.merged(self.read(layer, table).schema, delta.schema)[1]
            if any(moved.get(k) != k for k in keys):
                raise ValueError(f"{layer}.{table}: a key column's type does not fit")
        number = state.get("newest", 0) + 1
        for left in state["stores"]:
            # of a delivery that was refused or died; this one may go to another store
            self.drop_partitions(layer, f"{table}__s{left}", lambda values: int(values[MERGE]) >= number)
        stores, shape = self._put(layer, table, delta, MERGE, number)
        if check:
            # the delivery is made once, and only the key columns of what is stored are read; what fails never becomes
            # visible, and goes with the next delivery
            stored = self.spark.table(self._store(layer, table, stores[-1])).where(F.col(MERGE) == number)
            require_key(f"{layer}.{table}", stored, keys)
        self._show_merged(layer, table, shape, {**state, "stores": stores, "keys": list(keys), "base": state.get("base", number), "newest": number})
        if number - state.get("base", number) >= FOLD_AFTER:
            self.fold(layer, table)

    def fold(self, layer: str, table: str) -> None:
        """Store a keyed table's content as its new base; what only older readers see goes with the next fold."""
        state = self._state(layer, table)
        if state["base"] == state["newest"]:
            return
        number = state["newest"] + 1
        stores, shape = self._put(layer, table, self.read(layer, table), MERGE, number)
        self._show_merged(layer, table, shape, {**state, "stores": stores[-1:], "base": number, "newest": number, "folded": state["base"]})
        for old in self._numbered(layer, table, "__s"):
            name = self._store(layer, table, old)
            if old not in stores:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            elif "folded" in state:
                self.drop_partitions(layer, name.rpartition(".")[2], lambda values: int(values[MERGE]) < state["base"])

    def _show_merged(self, layer: str, table: str, shape: T.StructType, state: dict) -> None:
        stored = T.StructType([*shape, T.StructField(MERGE, T.IntegerType())])
        rows = self._stored_rows(layer, table, state["stores"], stored)
        columns = ", ".join(f"`{f.name}`" for f in shape)
        if state["base"] == state["newest"]:
            body = f"SELECT {columns} FROM ({rows}) WHERE {MERGE} = {state['base']}"
        else:
            keys = ", ".join(f"`{k}`" for k in state["keys"])
            same = " AND ".join(f"b.`{k}` <=> d.`{k}`" for k in state["keys"])
            body = f"""
                WITH stored AS ({rows}), delivered AS (SELECT * FROM stored WHERE {MERGE} > {state['base']} AND {MERGE} <= {state['newest']})
                SELECT {columns} FROM (SELECT * FROM stored WHERE {MERGE} = {state['base']}) b WHERE NOT EXISTS (SELECT 1 FROM delivered d WHERE {same})
                UNION ALL SELECT {columns} FROM (
                    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {MERGE} DESC) AS _newest FROM delivered) WHERE _newest = 1"""
        self._show(layer, table, body, state)

    # --- drop, counts ---

    def drop(self, layer: str, table: str) -> None:
        """Drop a table with everything that is kept under its name, also its filters and cells in ``meta``."""
        kind = "VIEW" if self.exists(layer, table) and self._is_view(layer, table) else "TABLE"
        self.spark.sql(f"DROP {kind} IF EXISTS {self.name(layer, table)}")
        for kept in (f"{self.name(layer, table)}__r", f"{self.name(layer, table)}__log", self.name("meta", f"{layer}__{table}__filters")):
            self.spark.sql(f"DROP TABLE IF EXISTS {kept}")
        with self._log:
            if self.exists("meta", "cells"):
                self.drop_partitions("meta", "cells", lambda values: unquote(values["table_name"]) == f"{layer}.{table}")
        for mark in ("__v", "__s"):
            for number in self._numbered(layer, table, mark):
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}{mark}{number}")

    def drop_partitions(self, layer: str, table: str, goes) -> None:
        """Drop the partitions for whose values (text by column) ``goes`` is true."""
        target = f"{self.db(layer)}.{table}"
        if self.spark.conf.get("spark.sql.catalogImplementation") == "hive":
            for (found,) in self.spark.sql(f"SHOW PARTITIONS {target}").collect():
                values = dict(part.split("=") for part in found.split("/"))
                if goes(values):
                    spec = ", ".join(f"{k} = '{v}'" for k, v in values.items())
                    self.spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")
            return
        # without a metastore the partitions are the folders
        depth = sum(c.isPartition for c in self.spark.catalog.listColumns(target))
        found, files = self._partitions(layer, table, "/".join(["*=*"] * depth))
        for path in found:
            if goes(dict(part.split("=") for part in path.toString().rsplit("/", depth)[1:])):
                files.delete(path, True)
        self.spark.catalog.refreshTable(target)

    def remove_folder(self, path: str) -> None:
        """Delete a landing folder under the root."""
        if not path.startswith(f"{self.root}/landing/"):
            raise ValueError(f"{path} is not a landing folder")
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def _is_view(self, layer: str, table: str) -> bool:
        return self.spark.catalog.getTable(self.name(layer, table)).tableType == "VIEW"

    def teardown(self, layers: Sequence[str] = ("mart", "raw_vault", "staging")) -> None:
        """Drop whole layers, dependents first."""
        for layer in layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.db(layer)} CASCADE")
            self.spark.sql(f"CREATE DATABASE {self.db(layer)} LOCATION '{self.root}/{layer}'")

    def tables(self, layer: str) -> list[str]:
        names = (t.name for t in self.spark.catalog.listTables(self.db(layer)) if not t.isTemporary)
        return sorted(n for n in names if "__" not in n)

    def counts(self, layers: Sequence[str]) -> DataFrame:
        """Row count of every table of the layers, named ``layer.table``."""
        found: Mapping[str, DataFrame] = {
            f"{layer}.{table}": self.read(layer, table) for layer in layers for table in self.tables(layer)}
        return count_tables(found)
