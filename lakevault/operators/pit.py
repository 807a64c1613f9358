"""Point-in-time tables.

For every hub key and as-of date: which satellite version was valid. Only the load time of the
version is needed, and the latest load time at or before a date is a maximum. Every version belongs
to the first date at or after it (found by halving the date list); one hash aggregate, combined on
the map side, keeps the latest version per key and date, and the few that are left per key are laid
out over the dates up to the next one. So each satellite is read once for any number of dates, without
a range join or a window over a key's versions, and a key with very many versions costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.operators.ordered import first_per_key

GHOST_KEY = "0" * 32
GHOST_TIME = datetime(1900, 1, 1)


def _ntz(value: datetime):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _dates_before(ldts: str, dates: Sequence[datetime]) -> Column:
    """How many of the ascending dates lie before a load time."""
    steps, step = [], 1
    while step <= len(dates):
        steps.insert(0, step)
        step *= 2
    listed = F.array(*[_ntz(d) for d in dates])
    halves = F.array(*[F.lit(s) for s in steps])
    fits = lambda at: (at <= len(dates)) & (F.get(listed, at - 1) < F.col(ldts))
    return F.aggregate(halves, F.lit(0), lambda at, s: F.when(fits(at + s), at + s).otherwise(at))


def _laid_out(sat: DataFrame, pk: str, name: str, dates: Sequence[datetime], ldts: str) -> DataFrame:
    """Per key one array over the dates: the load time valid at each, NULL before the first version."""
    placed = sat.select(pk, F.col(ldts).alias("t"), _dates_before(ldts, dates).alias("i")).where(F.col("i") < len(dates))
    latest = placed.groupBy(pk, "i").agg(F.max("t").alias("t"))
    # at most one entry per date
    found = latest.groupBy(pk).agg(F.sort_array(F.collect_list(F.struct("i", "t"))).alias("v"))
    until = F.concat(F.slice(F.transform("v", lambda e: e["i"]), 2, len(dates)), F.array(F.lit(len(dates))))
    runs = F.zip_with("v", until, lambda e, end: F.array_repeat(e["t"], (end - e["i"]).cast("int")))
    lead = F.array_repeat(F.lit(None).cast("timestamp_ntz"), F.element_at("v", 1)["i"].cast("int"))
    return found.select(pk, F.concat(lead, F.flatten(runs)).alias(name))


def build_pit(
    hub: DataFrame, pk: str, satellites: dict[str, DataFrame], as_of_dates: Sequence[datetime],
    ldts: str = "load_datetime",
) -> DataFrame:
    """Columns: pk, as_of_date, and per satellite ``<name>_pk`` and ``<name>_ldts``."""
    dates = sorted(set(as_of_dates))
    if not dates:
        raise ValueError("no as-of dates given")
    spine = hub.select(pk)
    for name, sat in satellites.items():
        spine = spine.join(_laid_out(sat, pk, f"_{name}", dates, ldts), pk, "left")
    nothing = F.array_repeat(F.lit(None).cast("timestamp_ntz"), len(dates))
    slots = F.arrays_zip(
        F.array(*[_ntz(d) for d in dates]).alias("as_of_date"),
        *[F.coalesce(F.col(f"_{name}"), nothing).alias(name) for name in satellites])
    exploded = spine.select(pk, F.explode(slots).alias("_slot")).select(pk, "_slot.*")
    columns = [F.col(pk), F.col("as_of_date")]
    for name in satellites:
        found = F.col(name)
        columns.append(F.when(found.isNotNull(), F.col(pk)).otherwise(F.lit(GHOST_KEY)).alias(f"{name}_pk"))
        columns.append(F.coalesce(found, _ntz(GHOST_TIME)).alias(f"{name}_ldts"))
    return exploded.select(*columns)


def moved(pit: DataFrame, pk: str, versions: dict[str, DataFrame], dates: Sequence[datetime], ldts: str = "load_datetime") -> DataFrame:
    """The rows of a stored table that new versions point elsewhere.

    Only dates at or after the earliest new version are read.
    """
    dates = sorted(dates)
    state, changed = pit, F.lit(False)
    keys, earliest = None, None
    for name, rows in versions.items():
        laid = _laid_out(rows, pk, "_slots", dates, ldts)
        slots = F.arrays_zip(F.array(*[_ntz(d) for d in dates]).alias("as_of_date"), F.col("_slots").alias(f"_new_{name}"))
        found = laid.select(pk, F.explode(slots).alias("_s")).select(pk, "_s.*").where(F.col(f"_new_{name}").isNotNull())
        state = state.join(found, [pk, "as_of_date"], "left")
        changed = changed | F.coalesce(F.col(f"_new_{name}") > F.col(f"{name}_ldts"), F.lit(False))
        keys = rows.select(pk) if keys is None else keys.unionByName(rows.select(pk))
        first = rows.agg(F.min(ldts)).first()[0]
        earliest = first if earliest is None or first is not None and first < earliest else earliest
    state = state.join(keys.distinct(), pk, "left_semi")
    if earliest is not None:
        state = state.where(F.col("as_of_date") >= _ntz(earliest))
    columns = []
    for c in pit.columns:
        name = c.removesuffix("_ldts").removesuffix("_pk") if c not in (pk, "as_of_date") else None
        if name in versions:
            later = F.col(f"_new_{name}") > F.col(f"{name}_ldts")
            columns.append(F.when(later, F.col(f"_new_{name}") if c.endswith("_ldts") else F.col(pk)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return state.where(changed).select(*columns)


def carried(
    pit: DataFrame, hub: DataFrame, pk: str, satellites: dict[str, DataFrame], known: Sequence[datetime],
    new: Sequence[datetime], ldts: str = "load_datetime",
) -> DataFrame:
    """Rows for dates that a stored table does not have yet.

    The pointers of the last stored date before a new one are carried forward, and only versions after
    that date are read.
    """
    out = None
    groups: dict[datetime | None, list[datetime]] = {}
    for date in sorted(new):
        groups.setdefault(max((k for k in known if k < date), default=None), []).append(date)
    for before, dates in groups.items():
        later = {n: s.where(F.col(ldts) <= _ntz(dates[-1])) for n, s in satellites.items()}
        if before is not None:
            later = {n: s.where(F.col(ldts) > _ntz(before)) for n, s in later.items()}
        rows = build_pit(hub, pk, later, dates, ldts)
        if before is not None:
            old = pit.where(F.col("as_of_date") == _ntz(before)).select(
                pk, *[F.col(f"{n}_{part}").alias(f"_{n}_{part}") for n in satellites for part in ("pk", "ldts")])
            columns = [F.col(pk), F.col("as_of_date")]
            for n in satellites:
                stays = F.col(f"{n}_ldts") == _ntz(GHOST_TIME)
                columns += [F.when(stays, F.coalesce(f"_{n}_{part}", f"{n}_{part}")).otherwise(F.col(f"{n}_{part}")).alias(f"{n}_{part}") for part in ("pk", "ldts")]
            rows = rows.join(old, pk, "left").select(*columns)
        out = rows if out is None else out.unionByName(rows)
    return out


def at_point(
    pit: DataFrame, sat: DataFrame, pk: str, sat_name: str,
    ldts: str = "load_datetime", hashdiff: str = "hashdiff",
) -> DataFrame:
    """PIT rows with the satellite row they point to: an equi join on key and load time."""
    versions = first_per_key(sat, [pk, ldts], [F.col(hashdiff)])
    pointer = pit.select(pk, "as_of_date", F.col(f"{sat_name}_ldts").alias(ldts))
    return pointer.join(versions, [pk, ldts])
