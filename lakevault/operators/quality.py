"""Data-quality tests as DataFrames.

A suite reads each model once: the column sets of its group tests (unique, proportion of unique values,
distinct count) and the empty set of its row tests, row counts and freshness are grouping sets of one
aggregate, combined on the map side and shuffled once. Column sets that hold the column a stored table lies by are
grouped where they lie, by a scan of their own and no shuffle. Only relationships ask a second table. Results are rows
``(model, test, column, severity, status, failures, checked_rows)``.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = ["model", "test", "column", "severity", "status", "failures", "checked_rows"]
RESULT_SCHEMA = ("model string, test string, column string, severity string, status string, "
                 "failures bigint, checked_rows bigint")


@dataclass(frozen=True)
class Test:
    """``kind`` is one of ``row``, ``table``, ``group`` or ``relation``."""

    __test__ = False

    model: str
    name: str
    kind: str
    columns: tuple[str, ...] = ()
    broken: Column | None = None          # row: true for a failing row
    failures: Column | None = None        # table, group: aggregate giving the number of failures
    parent: tuple[str, str] | None = None  # relation: (model, column)
    values: tuple = ()                    # accepted values
    severity: str = "fail"
    tags: tuple[str, ...] = field(default=())

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(model: str, column: str, **kw) -> Test:
    return Test(model, "not_null", "row", (column,), F.col(column).isNull(), **kw)


def matches(model: str, column: str, regex: str, **kw) -> Test:
    return Test(model, "match_regex", "row", (column,), ~F.col(column).rlike(regex), **kw)


def between(model: str, column: str, low=None, high=None, strictly: bool = False, **kw) -> Test:
    """Inclusive unless ``strictly``; a side left out is open. NULLs pass."""
    col = F.col(column)
    inside = F.lit(True)
    if low is not None:
        inside = inside & ((col > low) if strictly else (col >= low))
    if high is not None:
        inside = inside & ((col < high) if strictly else (col <= high))
    return Test(model, "between_strict" if strictly else "between", "row", (column,), ~inside, **kw)


def pair_ordered(model: str, a: str, b: str, or_equal: bool = True, where: str | None = None, **kw) -> Test:
    ordered = (F.col(a) >= F.col(b)) if or_equal else (F.col(a) > F.col(b))
    broken = ~ordered if where is None else F.expr(where) & ~ordered
    return Test(model, "pair_a_not_below_b", "row", (a, b), broken, **kw)


def accepted(model: str, column: str, values: Sequence, **kw) -> Test:
    """Failures are distinct values outside the list."""
    outside = F.col("_n").isNotNull() & ~F.col(column).isin(list(values))
    return Test(model, "accepted_values", "group", (column,), failures=F.count_if(outside), values=tuple(values), **kw)


def unique(model: str, column: str, **kw) -> Test:
    """Failures are values that occur more than once."""
    twice = (F.col("_n") > 1) & F.col(column).isNotNull()
    return Test(model, "unique", "group", (column,), failures=F.count_if(twice), **kw)


def compound_unique(model: str, columns: Sequence[str], **kw) -> Test:
    """Failures are the rows of combinations that occur more than once."""
    rows = F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(F.lit(0)))
    return Test(model, "compound_unique", "group", tuple(columns), failures=rows, **kw)


def distinct_count(model: str, column: str, value: int, **kw) -> Test:
    wrong = F.count(F.col(column)) != value
    return Test(model, "distinct_count", "group", (column,), failures=wrong.cast("bigint"), **kw)


def unique_ratio(model: str, column: str, low: float, high: float, **kw) -> Test:
    """Distinct values over non-null rows."""
    rows = F.sum(F.when(F.col(column).isNotNull(), F.col("_n")).otherwise(F.lit(0)))
    ratio = F.count(F.col(column)).cast("double") / F.nullif(rows, F.lit(0)).cast("double")
    return Test(model, "unique_ratio", "group", (column,),
                failures=(~F.coalesce(ratio.between(low, high), F.lit(False))).cast("bigint"), **kw)


def recent(model: str, column: str, now: Column, years: int, **kw) -> Test:
    limit = F.add_months(now.cast("date"), -12 * years).cast("timestamp_ntz")
    fresh = F.coalesce(F.max(column) >= limit, F.lit(False))
    return Test(model, "recent_data", "table", (column,), failures=(~fresh).cast("bigint"), **kw)


def row_count(model: str, low: int | None = None, high: int | None = None, **kw) -> Test:
    n = F.count(F.lit(1))
    outside = F.lit(False)
    if low is not None:
        outside = outside | (n < low)
    if high is not None:
        outside = outside | (n > high)
    return Test(model, "row_count", "table", (), failures=outside.cast("bigint"), **kw)


def relationship(model: str, column: str, parent: str, parent_column: str, **kw) -> Test:
    """Failures are rows whose non-null value the parent does not have."""
    return Test(model, "relationship", "relation", (column,), parent=(parent, parent_column), **kw)


def never_shrinks(model: str, last_count: int, **kw) -> Test:
    return row_count(model, low=last_count, **kw)


def select(tests: Iterable[Test], tags: Iterable[str] = (), exclude: Iterable[str] = ()) -> list[Test]:
    wanted, unwanted = set(tags), set(exclude)
    return [t for t in tests if (not wanted or wanted & set(t.tags)) and not unwanted & set(t.tags)]


def _scalar(i: int, test: Test) -> Column:
    value = F.count_if(test.broken) if test.kind == "row" else test.failures
    return F.coalesce(value, F.lit(0)).cast("bigint").alias(f"f{i}")


def _result(test: Test, failures: Column, checked: Column) -> Column:
    return F.struct(
        F.lit(test.model).alias("model"), F.lit(test.name).alias("test"), F.lit(test.label).alias("column"),
        F.lit(test.severity).alias("severity"), failures.cast("bigint").alias("failures"), checked.cast("bigint").alias("checked_rows"))


def _related(models: Mapping[str, DataFrame], test: Test) -> DataFrame:
    child = models[test.model].where(F.col(test.columns[0]).isNotNull())
    parent = models[test.parent[0]].select(F.col(test.parent[1]).alias("_parent"))
    # counted per value first, so that a frequent value meets the parent only once
    values = child.groupBy(F.col(test.columns[0]).alias("_child")).agg(F.count(F.lit(1)).alias("_n"))
    marked = values.join(parent.distinct(), F.col("_child") == F.col("_parent"), "left")
    missing = F.coalesce(F.sum(F.when(F.col("_parent").isNull(), F.col("_n")).otherwise(F.lit(0))), F.lit(0))
    return marked.agg(_result(test, missing, F.coalesce(F.sum("_n"), F.lit(0))).alias("r")).select("r.*")


def _measured(df: DataFrame, tests: Sequence[Test], hashed: Collection[str] = ()) -> DataFrame:
    """All row, table and group tests of one model from one scan and one shuffle of it."""
    scalars = [t for t in tests if t.kind in ("row", "table")]
    by_set: dict[tuple[str, ...], list[Test]] = {}
    for test in tests:
        if test.kind == "group":
            by_set.setdefault(test.columns, []).append(test)
    measures = [F.count(F.lit(1)).alias("_n"), *[_scalar(i, t) for i, t in enumerate(scalars)]]
    if not by_set:
        one = df.agg(*measures)
        return one.select(F.inline(F.array(*[_result(t, F.col(f"f{i}"), F.col("_n")) for i, t in enumerate(scalars)])))
    # columns are grouped under names of their own, so that the measures still see the rows' values
    columns = list(dict.fromkeys(c for s in by_set for c in s))
    named = {c: f"_g{i}" for i, c in enumerate(columns)}
    # MD5 texts are grouped as the 16 bytes they stand for, unless a test asks for their values
    packed = set(hashed) - {c for t in tests if t.kind == "group" and t.values for c in t.columns}
    kind = lambda c: "binary" if c in packed else df.schema[c].dataType
    sets = [*by_set, *([()] if scalars else [])]
    wide = df.withColumns({g: F.unhex(c) if c in packed else F.col(c) for c, g in named.items()})
    ids = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
    grouped = wide.groupingSets([[F.col(named[c]) for c in s] for s in sets], *[F.col(g) for g in named.values()])
    counted = grouped.agg(F.grouping_id().alias("_set"), *measures).select(
        "_set", "_n", *[F.col(g).alias(c) for c, g in named.items()], *[F.col(f"f{i}").alias(f"_f{i}") for i in range(len(scalars))])
    # an empty model has no groups: its scalars come from an empty relation, which is never scanned
    nothing = df.limit(0).agg(*measures).select(
        F.lit(ids[-1]).cast("long").alias("_set"), "_n", *[F.lit(None).cast(kind(c)).alias(c) for c in columns],
        *[F.col(f"f{i}").alias(f"_f{i}") for i in range(len(scalars))])
    counted = counted.withColumn("_set", F.col("_set").cast("long"))
    counted = counted.unionByName(nothing) if scalars else counted
    # a row without a count per set, so that the sets of an empty model are there; every measure passes over it
    every = df.sparkSession.createDataFrame([(k,) for k in ids], "_set long").select(
        "_set", *[F.lit(None).cast(counted.schema[c].dataType).alias(c) for c in counted.columns if c != "_set"])
    # from here on there is a row per group; measures of all sets are taken per set, combined on the map side, so that
    # no row of a group is shuffled again, and each test picks its own
    group_tests = [(ids[k], t) for k, s in enumerate(by_set) for t in by_set[s]]
    per_set = counted.unionByName(every).groupBy("_set").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        *[F.coalesce(t.failures, F.lit(0)).cast("bigint").alias(f"g{i}") for i, (_, t) in enumerate(group_tests)],
        *[F.max_by(f"_f{i}", "_n").alias(f"_f{i}") for i in range(len(scalars))])
    results = [(ids[-1], _result(t, F.col(f"_f{i}"), F.col("_rows"))) for i, t in enumerate(scalars)]
    results += [(k, _result(t, F.col(f"g{i}"), F.col("_rows"))) for i, (k, t) in enumerate(group_tests)]
    held = [F.struct(F.lit(k).cast("long").alias("k"), r.alias("r")) for k, r in results]
    return per_set.select("_set", F.explode(F.array(*held)).alias("h")).where("h.k = _set").select("h.r.*")


def _in_place(df: DataFrame, columns: Sequence[str], tests: Sequence[Test]) -> DataFrame:
    """All tests of one column set of a model whose rows lie by one of these columns."""
    one = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), *[F.coalesce(t.failures, F.lit(0)).alias(f"g{i}") for i, t in enumerate(tests)])
    return one.select(F.inline(F.array(*[_result(t, F.col(f"g{i}"), F.col("_rows")) for i, t in enumerate(tests)])))


def run(models: Mapping[str, DataFrame], tests: Sequence[Test], lies_by: Mapping[str, str] | None = None,
        hashed: Collection[str] = ()) -> DataFrame:
    """All results as one DataFrame. ``lies_by`` names the column that the rows of a stored model are bucketed by,
    ``hashed`` the columns that hold MD5 texts and nothing else."""
    parts = [_related(models, t) for t in tests if t.kind == "relation"]
    by_model: dict[str, list[Test]] = {}
    in_place: dict[tuple[str, tuple[str, ...]], list[Test]] = {}
    for test in tests:
        if test.kind == "group" and (lies_by or {}).get(test.model) in test.columns:
            in_place.setdefault((test.model, test.columns), []).append(test)
        elif test.kind != "relation":
            by_model.setdefault(test.model, []).append(test)
    parts += [_measured(models[name], own, hashed) for name, own in by_model.items()]
    parts += [_in_place(models[name], columns, own) for (name, columns), own in in_place.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    status = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    return out.withColumn("status", status).select(*RESULT)


def failing_rows(models: Mapping[str, DataFrame], test: Test) -> DataFrame:
    """The rows a test complains about (row tests, unique tests, accepted values, relationships)."""
    df = models[test.model]
    if test.kind == "row":
        return df.where(test.broken)
    if test.name == "accepted_values":
        return df.where(F.col(test.columns[0]).isNotNull() & ~F.col(test.columns[0]).isin(list(test.values)))
    if test.kind == "relation":
        parent = models[test.parent[0]].select(F.col(test.parent[1]).alias("_parent"))
        child = df.where(F.col(test.columns[0]).isNotNull())
        return child.join(parent, F.col(test.columns[0]) == F.col("_parent"), "left_anti")
    if test.name in ("unique", "compound_unique"):
        twice = df.groupBy(*test.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        return df.join(twice, list(test.columns), "left_semi")
    raise ValueError(f"{test.name} has no failing rows")


def has_failing_rows(test: Test) -> bool:
    return test.kind in ("row", "relation") or test.name in ("unique", "compound_unique", "accepted_values")


# --- freshness --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Freshness:
    """``None`` for a limit switches that level off."""

    table: str
    loaded_at: str
    warn_after: timedelta | None = None
    error_after: timedelta | None = None


def _seconds(span: Column) -> Column:
    """The length of a day-time interval; needs no time zone, unlike a difference of instants."""
    part = lambda unit: F.extract(F.lit(unit), span)
    whole = part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60
    return (whole + part("SECOND")).cast("double")


def source_freshness(tables: Mapping[str, DataFrame], rules: Sequence[Freshness], now: Column) -> DataFrame:
    """Age of the newest row per table against its limits; tables without any limit are left out."""
    out = None
    for rule in rules:
        if rule.warn_after is None and rule.error_after is None:
            continue
        newest = tables[rule.table].agg(F.max(rule.loaded_at).alias("max_loaded_at"))
        aged = newest.select(
            F.lit(rule.table).alias("table_name"), "max_loaded_at",
            _seconds(now - F.col("max_loaded_at")).alias("age_seconds"))
        status = F.when(F.col("max_loaded_at").isNull(), "error")
        for level, limit in (("error", rule.error_after), ("warn", rule.warn_after)):
            if limit is not None:
                status = status.when(F.col("age_seconds") > limit.total_seconds(), level)
        part = aged.withColumn("status", status.otherwise("pass"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("every table's freshness check is switched off")
    return out


def freshness_gate(spark: SparkSession, table: DataFrame | None, loaded_at: str, now: Column,
                   limit: timedelta) -> DataFrame:
    """One row ``(last_load, decision)``. An empty or missing table counts as stale; nothing is
    raised, the run goes on with what there is."""
    if table is None:
        return spark.createDataFrame([(None, "proceed_stale")], "last_load timestamp_ntz, decision string")
    newest = table.agg(F.max(loaded_at).alias("last_load"))
    young = now - F.col("last_load") < F.expr(f"interval {int(limit.total_seconds())} seconds")
    return newest.withColumn("decision", F.when(young, "proceed_fresh").otherwise("proceed_stale"))
