"""Ranks and interval joins against plain Python, with hot keys."""

import bisect
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakevault.operators import ordered

DAY = datetime(2024, 1, 1)


@pytest.mark.parametrize("dense", [False, True])
def test_ranks_against_a_window(spark, dense):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(20)]), rng.random() if not dense else rng.choice([None, 0.5, 1.5]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, x int, y double, i int").repartition(6)
    order = ["x", "y"] if dense else ["x", "y", "i"]
    window = Window.partitionBy("k").orderBy(*order)
    want = df.withColumn("r", (F.dense_rank() if dense else F.row_number()).over(window))
    got = ordered.ranked(df, ["k"], order, "r", dense, sample=500, slices=16)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_hot_partition_is_sliced(spark):
    """No (partition, slice) holds more than a few times its share of a partition with nearly all rows."""
    df = spark.range(40_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 40_009).alias("x"), F.lit(str(DAY)).cast("timestamp_ntz").alias("t"))
    found = ordered._splitters(df, F.struct("x", "t"), 4000, 32)
    assert 25 <= len(found) <= 40
    xs, edges = sorted(i * 7919 % 40_009 for i in range(40_000)), [-1, *[r.x for r in found], 10**9]
    sizes = [bisect.bisect_left(xs, b) - bisect.bisect_left(xs, a) for a, b in zip(edges, edges[1:])]
    assert sum(sizes) == 40_000 and max(sizes) < 4 * 40_000 / len(sizes)
    # a partition column that Spark cannot take for a constant
    got = ordered.ranked(df.withColumn("k", F.when(F.col("x") >= 0, "hot")), ["k"], ["x", "t"], "r", sample=4000, slices=32)
    assert got.agg(F.max("r")).first()[0] == 40_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "_slice" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_ranks_of_few_rows(spark):
    empty = spark.createDataFrame([], "k string, x int")
    assert ordered.ranked(empty, ["k"], ["x"], "r").collect() == []
    one = spark.createDataFrame([(None, None)], "k string, x int")
    assert [tuple(r) for r in ordered.ranked(one, ["k"], ["x"], "r").collect()] == [(None, None, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_intervals_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    moment = lambda: DAY + timedelta(seconds=rng.choice([rng.randrange(10**5), rng.randrange(10**7), 86_400 * rng.randrange(90)]))
    events = [(i, rng.choice([1, 1, 1, 2, None]), moment() if rng.random() < 0.95 else None) for i in range(300)]
    versions = []
    for i in range(120):
        begin = moment()
        end = rng.choice([None, begin, begin - timedelta(days=1), begin + timedelta(seconds=rng.choice([1, 3600, 10**5, 10**6, 5 * 10**6, 10**7]))])
        versions.append((rng.choice([1, 2, 2, 3]), begin, end, i))
    got = ordered.interval_join(spark.createDataFrame(events, "e int, k int, t timestamp_ntz"), spark.createDataFrame(versions, "k int, b timestamp_ntz, z timestamp_ntz, v int"),
                                ["k"], "t", "b", "z", ["v"])
    want = sorted((e, v) for e, k, t in events for k2, b, z, v in versions if k == k2 and t is not None and b <= t and (z is None or t < z))
    assert sorted((r.e, r.v) for r in got.collect()) == want and want
