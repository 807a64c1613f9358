"""Insert-only vault loads: hubs, links, satellites.

Each load is a function from (staged source, stored target) to the rows to append, so it can be
checked without a table. ``target=None`` means the table does not exist yet.

``one_row_per_key`` in a spec states a contract of the source: at most one row per hash key in a
batch. It holds where the hash key covers the numeric primary key of a raw table, which is checked
when a delivery is stored, and saves the shuffle that would find repeats inside the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakevault.operators.ordered import first_per_key, with_previous


@dataclass(frozen=True)
class HubSpec:
    name: str
    pk: str
    nk: str
    source: str
    ldts: str = "load_datetime"
    record_source: str = "record_source"
    branch: str = "classic"
    one_row_per_key: bool = False

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.pk,)

    @property
    def columns(self) -> list[str]:
        return [self.pk, self.nk, self.ldts, self.record_source]

    @property
    def stored(self) -> list[str]:
        return self.columns


@dataclass(frozen=True)
class LinkSpec:
    """``child`` names dependent child keys: what tells rows of one relation apart, kept with the link. ``lies_by`` is the
    key that its stored rows lie by, where it is joined on that and not on its own."""

    name: str
    pk: str
    fks: tuple[str, ...]
    source: str
    ldts: str = "load_datetime"
    record_source: str = "record_source"
    branch: str = "classic"
    one_row_per_key: bool = False
    child: tuple[str, ...] = ()
    lies_by: str = ""

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.pk, *self.fks)

    @property
    def columns(self) -> list[str]:
        return [self.pk, *self.fks, self.ldts, self.record_source]

    @property
    def stored(self) -> list[str]:
        return [*self.columns, *self.child]


@dataclass(frozen=True)
class SatSpec:
    """``grain`` sets the time slices over which the versions of one key are spread."""

    name: str
    pk: str
    payload: tuple[str, ...]
    source: str
    hashdiff: str = "hashdiff"
    eff: str = "effective_from"
    ldts: str = "load_datetime"
    record_source: str = "record_source"
    branch: str = "classic"
    one_row_per_key: bool = False
    grain: str = "month"

    @property
    def columns(self) -> list[str]:
        return [self.pk, self.hashdiff, *self.payload, self.eff, self.ldts, self.record_source]


def touching(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key occurs in the source.

    Spark broadcasts the source keys when its size estimate allows, so a small delta against a
    large target filters the target in place of shuffling it.
    """
    return target.join(source.select(key), key, "left_semi")


def key_rows(source: DataFrame, target: DataFrame | None, spec: HubSpec | LinkSpec) -> DataFrame:
    """Hub or link rows not stored yet: the earliest row per new key, keys with NULL parts dropped."""
    rows = source.select(*spec.stored).dropna(subset=list(spec.keys))
    if spec.one_row_per_key:
        fresh = rows
    else:
        order = [F.col(spec.ldts), F.col(spec.record_source)]
        if isinstance(spec, HubSpec):
            order.append(F.col(spec.nk))
        fresh = first_per_key(rows, [spec.pk], order)
    if target is None:
        return fresh
    known = touching(target.select(spec.pk), rows, spec.pk)
    return fresh.join(known, spec.pk, "left_anti")


def current(sat: DataFrame, pk: str, ldts: str = "load_datetime", hashdiff: str = "hashdiff") -> DataFrame:
    """The latest version per key; equal load times are decided by the smaller hashdiff."""
    return first_per_key(sat, [pk], [F.col(ldts).desc(), F.col(hashdiff)])


def _latest_load(target: DataFrame, spec: SatSpec) -> DataFrame:
    """(pk, ldts, hashdiff) of every row at its key's latest load time; ``_cur`` marks the current one."""
    whole = Window.partitionBy(spec.pk)
    return (
        target.select(F.col(spec.pk), F.col(spec.ldts).alias("_t_ldts"), F.col(spec.hashdiff).alias("_t_diff"))
        .withColumn("_rank", F.rank().over(Window.partitionBy(spec.pk).orderBy(F.col("_t_ldts").desc())))
        .where("_rank = 1")
        .withColumn("_cur", F.col("_t_diff") == F.min("_t_diff").over(whole))
        .drop("_rank")
    )


def sat_rows(
    source: DataFrame, target: DataFrame | None, spec: SatSpec, late: str = "ignore"
) -> DataFrame:
    """Versions to append: rows whose payload hash differs from the version before them.

    A value that returns after a change is a new version. Rows older than the key's latest stored
    load time are ignored (``late="ignore"``) or placed in order among all stored versions
    (``late="insert"``). Loading the same batch again adds nothing.
    """
    if late not in ("ignore", "insert"):
        raise ValueError(f"late must be 'ignore' or 'insert', not {late!r}")
    rows = source.select(*spec.columns).dropna(subset=[spec.pk])
    if spec.one_row_per_key and late == "ignore":
        if target is None:
            return rows
        stored = _latest_load(touching(target, rows, spec.pk), spec)
        settled = (
            (F.col(spec.ldts) < F.col("_t_ldts"))
            | ((F.col(spec.ldts) == F.col("_t_ldts")) & (F.col(spec.hashdiff) == F.col("_t_diff")))
            | (F.col("_cur") & (F.col(spec.hashdiff) == F.col("_t_diff")))
        )
        stored = stored.withColumnRenamed(spec.pk, "_t_pk")
        return rows.join(stored, (F.col(spec.pk) == F.col("_t_pk")) & settled, "left_anti")

    # one row per (key, load time, payload); stored rows win so that repeats are never appended
    chain = rows.withColumn("_stored", F.lit(0))
    if target is not None:
        base = touching(target.select(*spec.columns), rows, spec.pk)
        if late == "ignore":
            stored = _latest_load(base, spec).withColumnRenamed(spec.pk, "_t_pk")
            old = (F.col(spec.pk) == F.col("_t_pk")) & (F.col(spec.ldts) < F.col("_t_ldts"))
            chain = chain.join(stored.where("_cur"), old, "left_anti")
            newest = Window.partitionBy(spec.pk).orderBy(F.col(spec.ldts).desc())
            base = base.withColumn("_rank", F.rank().over(newest)).where("_rank = 1").drop("_rank")
        chain = chain.unionByName(base.withColumn("_stored", F.lit(1)))
    chain = first_per_key(
        chain, [spec.pk, spec.ldts, spec.hashdiff],
        [F.col("_stored").desc(), F.col(spec.eff), F.col(spec.record_source)],
    )
    ordered = with_previous(
        chain, [spec.pk], [F.col(spec.ldts), F.col(spec.hashdiff).desc()],
        F.date_trunc(spec.grain, F.col(spec.ldts)), spec.hashdiff, "_before",
    )
    changed = F.col("_before").isNull() | (F.col("_before") != F.col(spec.hashdiff))
    return ordered.where((F.col("_stored") == 0) & changed).select(*spec.columns)


def history(sat: DataFrame, hub: DataFrame, pk: str, nk: str, keys: list) -> DataFrame:
    """All versions of the chosen natural keys."""
    chosen = hub.where(F.col(nk).isin(keys)).select(pk, nk)
    return sat.join(chosen, pk)


def count_tables(tables: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    """One row per table with its row count; the counts are computed by one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def delta_effect(before: dict[str, DataFrame], added: dict[str, DataFrame]) -> DataFrame:
    """Rows before, added and after, per table."""
    counted = count_tables(before).withColumnRenamed("row_count", "rows_before").join(
        count_tables(added).withColumnRenamed("row_count", "rows_added"), "table_name")
    return counted.withColumn("rows_after", F.col("rows_before") + F.col("rows_added"))
