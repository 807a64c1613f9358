"""Per-key ordering: first row, previous value, value as of a time.

One key may own a large share of all rows, so nothing here sends a whole key to one task:

* the first row of a key is a ``row_number() = 1`` filter, which Spark reduces to one row per key
  before the shuffle (``WindowGroupLimit``);
* ranks are counted per slice of the order, a range between sampled splitters, and raised by what the
  slices before hold;
* the previous value and the as-of value are found in two steps. Rows are windowed per
  (key, time slice), and only one row per slice is then windowed per key to carry the value over
  slice borders. The result is the same for every choice of slice; the slice only sets how far a
  large key is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EVERYTHING = (Window.unboundedPreceding, Window.unboundedFollowing)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def time_slice(column: str, grain: str) -> Column:
    return F.date_trunc(grain, F.col(column))


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column, value: str, out: str
) -> DataFrame:
    """Add ``out``: the non-null ``value`` of the row before this one within its key.

    ``slice_by`` must not decrease along ``order``.
    """
    sliced = df.withColumn("_slice", slice_by)
    inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = (
        sliced.withColumn(out, F.lag(value).over(inner))
        .withColumn("_pos", F.row_number().over(inner))
        .withColumn("_tail", F.last(value).over(inner.rowsBetween(*_EVERYTHING)))
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    heads = local.where("_pos = 1").withColumn(out, F.lag("_tail").over(across))
    return local.where("_pos > 1").unionByName(heads).drop("_slice", "_pos", "_tail")


def asof_join(
    left: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    left_time: str,
    version_time: str,
    payload: Sequence[str],
    tie_break: Sequence[Column] = (),
    grain: str = "month",
) -> DataFrame:
    """Each left row with the latest version at or before its time (NULLs when there is none).

    ``tie_break`` decides between versions of one key with the same time: the first one wins, by
    default in the order of the payload. ``payload`` names version columns to add and must not clash with left columns.
    """
    keyed = versions.where(F.greatest(*[F.col(k).isNull() for k in keys], F.col(version_time).isNull()) == F.lit(False))
    latest = first_per_key(keyed, [*keys, version_time], list(tie_break) or [F.col(p) for p in payload])
    found = F.struct(*[F.col(p) for p in payload])
    key_cols = [F.col(k) for k in keys]
    events = latest.select(
        *key_cols, F.col(version_time).alias("_at"), F.lit(0).alias("_side"),
        found.alias("_found"), F.lit(None).cast(left.schema).alias("_row"),
    ).unionByName(
        left.select(
            *key_cols, F.col(left_time).alias("_at"), F.lit(1).alias("_side"),
            F.lit(None).cast(versions.select(found.alias("f")).schema["f"].dataType).alias("_found"),
            F.struct(*[F.col(c) for c in left.columns]).alias("_row"),
        )
    ).withColumn("_slice", F.date_trunc(grain, "_at"))
    inner = Window.partitionBy(*keys, "_slice").orderBy("_at", "_side")
    local = (
        events.withColumn("_here", F.last("_found", ignorenulls=True).over(
            inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where("_side = 1")
    )
    # one row per key and slice: the last version of the slice, carried to later slices
    tails = events.groupBy(*keys, "_slice").agg(
        F.max_by("_found", F.when(F.col("_side") == 0, F.col("_at"))).alias("_tail")
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("_carried", F.last("_tail", ignorenulls=True).over(before))
    carried = carried.where(F.col("_carried").isNotNull()).drop("_tail")
    resolved = local.join(carried, [*keys, "_slice"], "left").withColumn(
        "_found", F.coalesce("_here", "_carried"))
    return resolved.select("_row.*", *[F.col(f"_found.{p}").alias(p) for p in payload])


def intervals(versions: DataFrame, keys: Sequence[str], time: str, grain: str = "month") -> DataFrame:
    """Add ``valid_to``: the next version's time, NULL for the newest one."""
    # "next" is "previous" along the reversed order
    return with_previous(
        versions, keys, [F.col(time).desc()],
        -F.unix_micros(F.date_trunc(grain, F.col(time).cast("timestamp"))), time, "valid_to",
    )


#: rows of the sample that splitters are taken from, and slices of the order
SAMPLE, SLICES = 20_000, 256


def _splitters(df: DataFrame, order: Column, sample: int, slices: int) -> list:
    """At most ``slices - 1`` values that part the order into ranges of about as many rows each."""
    rows = df.agg(F.count(F.lit(1))).first()[0]
    if rows <= 1:
        return []
    picked = df.select(order.alias("o")).sample(min(1.0, sample / rows), seed=7).orderBy("o").limit(2 * sample)
    found = [r[0] for r in picked.collect()]  # bounded by the sample
    step = max(1, len(found) // slices)
    return list(dict.fromkeys(found[step::step]))


def _literal(value, kind: T.DataType) -> Column:
    timed = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return F.lit(str(value) if timed and value is not None else value).cast(kind)


def ranked(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str, dense: bool = False,
    sample: int = SAMPLE, slices: int = SLICES,
) -> DataFrame:
    """Add ``name``: the row number, or the dense rank, within a partition.

    Equal keys lie in one slice, so only keys that are equal in every ordering column stay together.
    A row's rank is its rank in its slice plus the rows (or distinct keys) in the partition's slices
    before: one row per partition and slice. The splitters only decide how evenly rows are spread.
    """
    order = F.struct(*[F.col(c) for c in order_by])
    splitters = _splitters(df, order, sample, slices)
    part = F.struct(*[F.col(c) for c in partition_by])
    at = F.lit(0)
    if splitters:
        kinds = [df.schema[c].dataType for c in order_by]
        bounds = F.array(*[F.struct(*[_literal(v, k).alias(c) for v, k, c in zip(values, kinds, order_by)]) for values in splitters])
        steps, step = [], 1
        while step <= len(splitters):
            steps.insert(0, step)
            step *= 2
        # how many splitters are not above the row's key, by halving
        fits = lambda n: (n <= len(splitters)) & (F.get(bounds, n - 1) <= order)
        at = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda n, s: F.when(fits(n + s), n + s).otherwise(n))
    sliced = df.withColumns({"_slice": at, "_part": part})
    within = Window.partitionBy("_part", "_slice").orderBy(*order_by)
    local = sliced.withColumn("_local", (F.dense_rank() if dense else F.row_number()).over(within))
    size = F.max("_local").alias("_size")
    before = Window.partitionBy("_part").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = local.groupBy("_part", "_slice").agg(size).withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    offsets = offsets.select(F.col("_part").alias("_p"), F.col("_slice").alias("_s"), "_before")
    placed = local.join(offsets, F.col("_part").eqNullSafe(F.col("_p")) & (F.col("_slice") == F.col("_s")), "left")
    return placed.withColumn(name, (F.col("_local") + F.col("_before")).cast("int")).drop("_slice", "_part", "_local", "_p", "_s", "_before")


def interval_join(
    events: DataFrame, versions: DataFrame, keys: Sequence[str], time: str, begin: str, end: str, payload: Sequence[str],
    bin_seconds: int = 86_400, coarse: int = 32, most: int = 8,
) -> DataFrame:
    """Each event with every version of its key that is valid at its time; the end is exclusive, NULL means open.

    An equi-join on key and time bin instead of a range join. A version lies in each fine bin it
    touches if these are at most ``most``, else in each coarse bin (``coarse`` fine ones) if those are at
    most ``most``, else in one bin over all time. Versions of a key that do not overlap are few on the last
    level. An event looks at one bin of each level. Events of a hot key are spread over its bins; what
    meets on the last level is an ordinary skewed join, which Spark splits.
    """
    seconds = lambda c: F.unix_micros(c.cast("timestamp"))
    fine, wide = bin_seconds * 1_000_000, bin_seconds * coarse * 1_000_000
    bin_of = lambda c, width: F.floor(seconds(c) / F.lit(width)).cast("long")
    last = F.col(end) - F.expr("INTERVAL '0.000001' SECOND")
    span = lambda width: bin_of(last, width) - bin_of(F.col(begin), width)
    spread = lambda level, width: F.transform(
        F.sequence(bin_of(F.col(begin), width), bin_of(last, width)), lambda b: F.struct(F.lit(level).alias("_level"), b.alias("_bin")))
    everywhere = F.array(F.struct(F.lit(2).alias("_level"), F.lit(0).cast("long").alias("_bin")))
    bins = (
        F.when(F.col(end).isNull(), everywhere)
        .when(span(fine) < most, spread(0, fine))
        .when(span(wide) < most, spread(1, wide))
        .otherwise(everywhere))
    valid = versions.where(F.col(end).isNull() | (F.col(begin) < F.col(end)))
    laid = valid.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(begin).alias("_from"), F.col(end).alias("_to"),
                        F.struct(*payload).alias("_found"), F.inline(bins))
    looks = F.array(*[F.struct(F.lit(level).alias("_l"), value.alias("_b")) for level, value in (
        (0, bin_of(F.col(time), fine)), (1, bin_of(F.col(time), wide)), (2, F.lit(0).cast("long")))])
    asked = events.select("*", F.inline(looks))
    same = (F.col("_l") == F.col("_level")) & (F.col("_b") == F.col("_bin"))
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    met = asked.join(laid, same).where((F.col(time) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(time) < F.col("_to"))))
    return met.select(*events.columns, *[F.col(f"_found.{c}").alias(c) for c in payload])
