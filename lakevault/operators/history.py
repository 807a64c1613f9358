"""Historised staging area: every version of a source table, with change and delete detection.

A delivery is compared with the current versions by one full outer join on the business key; both
sides hold a key once. The outcome is a list of events: versions it opens and versions it closes. They
are all that a run has to store; versions with their validity are the opened ones, joined to what
closed them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.functions.hashing import row_hash
from lakevault.operators.ordered import first_per_key
from lakevault.operators.staging import cast_interface

META = ("ng_rowhash", "ng_valid_from", "ng_valid_to", "ng_is_current", "ng_is_deleted",
        "ng_insert_date", "ng_update_date", "ng_source")


@dataclass(frozen=True)
class Scd2Spec:
    """``types`` lists all source columns with their declared types, in hash order."""

    key: str
    types: Mapping[str, str]
    tracked: tuple[str, ...]
    dedup: tuple[str, ...]
    change_col: str
    source: str
    surrogate: str

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, *self.types, *META]


def clean(source: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Declared types, exact repeats removed, content hash added."""
    typed = cast_interface(source, spec.types)
    hashed = typed.withColumn("ng_rowhash", row_hash(typed, spec.tracked))
    return first_per_key(hashed, list(spec.dedup), [F.col(spec.change_col), F.col("ng_rowhash")])


def surrogate(spec: Scd2Spec) -> Column:
    """A key computed from its row: no counter, hence no global order."""
    parts = [F.col(spec.key).cast("string"), F.col("ng_rowhash"), F.col("ng_valid_from").cast("string")]
    return F.sha2(F.concat_ws("|", *parts), 256)


def _opened(rows: DataFrame, spec: Scd2Spec, run_ts: Column) -> DataFrame:
    none = F.lit(None).cast("timestamp_ntz")
    opened = rows.select(
        *spec.types, "ng_rowhash", run_ts.alias("ng_valid_from"), none.alias("ng_valid_to"),
        F.lit(1).alias("ng_is_current"), F.lit(0).alias("ng_is_deleted"),
        run_ts.alias("ng_insert_date"), none.alias("ng_update_date"), F.lit(spec.source).alias("ng_source"),
    )
    return opened.withColumn(spec.surrogate, surrogate(spec)).select(*spec.columns)


def _closed(rows: DataFrame, run_ts: Column, deleted: int) -> DataFrame:
    return rows.withColumns({
        "ng_valid_to": run_ts, "ng_is_current": F.lit(0), "ng_is_deleted": F.lit(deleted),
        "ng_update_date": run_ts,
    })


def first_delivery(cleaned: DataFrame, spec: Scd2Spec, run_ts: Column) -> DataFrame:
    return _opened(cleaned, spec, run_ts)


LOG = ("ng_rowhash", "ng_at", "ng_is_deleted", "ng_kind")


def log_columns(spec: Scd2Spec) -> list[str]:
    """Columns of an event; one that closes a version has only its surrogate, its time and whether the key is gone."""
    return [spec.surrogate, *spec.types, *LOG]


def delivery_events(current: DataFrame, cleaned: DataFrame, spec: Scd2Spec, run_ts: Column, detect_deletes: bool = False) -> DataFrame:
    """The versions that a delivery opens and closes.

    ``current`` holds key, ``ng_rowhash`` and surrogate of the versions that are open. Without delete
    detection, keys missing from the delivery stay open.
    """
    old = F.struct("ng_rowhash", spec.surrogate).alias("_old")
    new = F.struct(*[F.col(c) for c in cleaned.columns]).alias("_new")
    both = current.select(F.col(spec.key).alias("_key"), old).join(cleaned.select(F.col(spec.key).alias("_key"), new), "_key", "full_outer")
    differs = ~F.col("_old.ng_rowhash").eqNullSafe(F.col("_new.ng_rowhash"))
    key_text = F.concat_ws("|", F.col("_key").cast("string"), F.col("_new.ng_rowhash"), run_ts.cast("string"))
    kinds = {**spec.types, "ng_rowhash": "string"}
    empty = [F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]

    def event(kind: str, surrogate_: Column, payload: list[Column], deleted: Column) -> Column:
        return F.struct(surrogate_.alias(spec.surrogate), *payload, run_ts.alias("ng_at"), deleted.alias("ng_is_deleted"), F.lit(kind).alias("ng_kind"))

    opened = event("opened", F.sha2(key_text, 256), [F.col(f"_new.{c}").alias(c) for c in kinds], F.lit(0))
    gone = F.col("_new").isNull()
    closed = event("closed", F.col(f"_old.{spec.surrogate}"), empty, gone.cast("int"))
    closes = F.col("_old").isNotNull() & (F.lit(detect_deletes) & gone | ~gone & differs)
    opens = ~gone & (F.col("_old").isNull() | differs)
    events = F.filter(F.array(F.when(closes, closed), F.when(opens, opened)), lambda e: e.isNotNull())
    return both.where(closes | opens).select(F.inline(events))


def first_events(cleaned: DataFrame, spec: Scd2Spec, run_ts: Column) -> DataFrame:
    """Every row of a first delivery opens a version."""
    key_text = F.concat_ws("|", F.col(spec.key).cast("string"), F.col("ng_rowhash"), run_ts.cast("string"))
    return cleaned.select(F.sha2(key_text, 256).alias(spec.surrogate), *spec.types, "ng_rowhash", run_ts.alias("ng_at"), F.lit(0).alias("ng_is_deleted"), F.lit("opened").alias("ng_kind"))


def versions_sql(log: str, spec: Scd2Spec, run: int) -> str:
    """SQL for all versions up to a run: the opened ones with what closed them."""
    columns = {
        **{c: f"o.`{c}`" for c in (spec.surrogate, *spec.types, "ng_rowhash")}, "ng_valid_from": "o.ng_at", "ng_valid_to": "c.ng_at",
        "ng_is_current": "IF(c.ng_at IS NULL, 1, 0)", "ng_is_deleted": "coalesce(c.ng_is_deleted, 0)", "ng_insert_date": "o.ng_at",
        "ng_update_date": "c.ng_at", "ng_source": f"'{spec.source}'"}
    listed = ", ".join(f"{columns[c]} AS `{c}`" for c in spec.columns)
    return (f"SELECT {listed} FROM (SELECT * FROM {log} WHERE ng_kind = 'opened' AND ng_run <= {run}) o LEFT JOIN "
            f"(SELECT `{spec.surrogate}` AS _sk, ng_at, ng_is_deleted FROM {log} WHERE ng_kind = 'closed' AND ng_run <= {run}) c ON o.`{spec.surrogate}` = c._sk")


def detect_deletes(stored_current: DataFrame, cleaned: DataFrame, spec: Scd2Spec, run_ts: Column) -> DataFrame:
    """The current rows whose key is missing from the delivery, closed and marked deleted."""
    gone = stored_current.join(cleaned.select(spec.key), spec.key, "left_anti").select(*stored_current.columns)
    return _closed(gone, run_ts, deleted=1)


def changed_rows(stored_current: DataFrame, cleaned: DataFrame, spec: Scd2Spec, run_ts: Column) -> DataFrame:
    """The current rows a delivery replaces, closed."""
    new = cleaned.select(spec.key, F.col("ng_rowhash").alias("_new_hash"))
    hit = stored_current.join(new, spec.key).where("ng_rowhash <> _new_hash").select(*stored_current.columns)
    return _closed(hit, run_ts, deleted=0)


def current_view(psa: DataFrame) -> DataFrame:
    return psa.where("ng_is_current = 1 AND ng_is_deleted = 0")


def deleted_view(psa: DataFrame) -> DataFrame:
    return psa.where("ng_is_deleted = 1")


def as_of(psa: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at the moment; the end of an interval is exclusive."""
    return psa.where(
        (F.col("ng_valid_from") <= moment) & (F.col("ng_valid_to").isNull() | (moment < F.col("ng_valid_to"))))


def status(psa: DataFrame) -> DataFrame:
    """Total, current, deleted and historic versions in one pass."""
    counts = psa.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if((F.col("ng_is_current") == 1) & (F.col("ng_is_deleted") == 0)).alias("current_versions"),
        F.count_if(F.col("ng_is_deleted") == 1).alias("deleted"),
    )
    return counts.withColumn("historic", F.col("total") - F.col("current_versions") - F.col("deleted"))


def compare_branches(pairs: Mapping[str, tuple[DataFrame, DataFrame]], ignore: tuple[str, ...] = ()) -> DataFrame:
    """Per table: row counts of both branches, whether they match, and rows found in one branch only."""
    out = None
    for name, (classic, psa) in pairs.items():
        columns = [c for c in classic.columns if c not in ignore]
        sides = classic.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
            psa.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
        per_row = sides.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
        part = per_row.agg(
            F.coalesce(F.sum("_a"), F.lit(0)).alias("classic_rows"),
            F.coalesce(F.sum("_b"), F.lit(0)).alias("psa_rows"),
            F.coalesce(F.sum(F.abs(F.col("_a") - F.col("_b"))), F.lit(0)).alias("differing_rows"),
        ).select(F.lit(name).alias("table_name"), "*", (
            F.col("classic_rows") == F.col("psa_rows")).alias("counts_match"))
        out = part if out is None else out.unionByName(part)
    return out
