"""Filters over the keys of files: which files a small delta opens, and that results stay the same."""

import numpy as np
from pyspark.sql import functions as F

from lakevault.operators.vault import HubSpec, SatSpec, key_rows, sat_rows
from lakevault.sources import keyfilter

HUB = HubSpec("hub_t", "pk", "id", "src")
SAT = SatSpec("sat_t", "pk", ("v",), "src", one_row_per_key=True)


def test_filters_never_miss_and_seldom_err():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        held = rng.integers(0, 2**63, n).astype(np.uint64)
        bits = keyfilter.made(held)
        assert keyfilter.may_hold(bits, held).all()
        strange = rng.integers(0, 2**63, 200_000).astype(np.uint64)
        wrong = keyfilter.may_hold(bits, strange).mean()
        assert wrong < 0.001
    assert wrong > 0  # about one in fifteen thousand, as twenty bits a key give


def rows(spark, low, high, day, value="a"):
    base = spark.range(low, high).select(
        F.sha2(F.col("id").cast("string"), 256).alias("pk"), "id", F.lit(value).alias("v"), F.lit(f"2024-01-{day:02d}").cast("timestamp_ntz").alias("load_datetime"))
    return base.withColumns({"effective_from": F.col("load_datetime"), "record_source": F.lit("s"), "hashdiff": F.md5("v")})


def test_a_small_delta_opens_few_files(spark, lake):
    lake.buckets = 32
    for load in range(6):
        lake.append("raw_vault", "hub_t", rows(spark, load * 800, load * 800 + 800, 1).select(*HUB.columns), bucket_by="pk")
        lake.append("raw_vault", "sat_t", rows(spark, load * 800, load * 800 + 800, 1).select(*SAT.columns), bucket_by="pk")
    # ten stored keys, of which the satellite's values change, and five new ones
    delta = rows(spark, 795, 805, 2, "b").unionByName(rows(spark, 9000, 9005, 2, "b")).cache()
    for name, rule, spec in (("hub_t", key_rows, HUB), ("sat_t", sat_rows, SAT)):
        whole = lake.read("raw_vault", name)
        files = len(whole.inputFiles())
        assert files >= 6 * 30
        few = lake.holding("raw_vault", name, "pk", delta)
        assert len(few.inputFiles()) < files / 10
        expected = sorted(map(repr, rule(delta, whole, spec).collect()))
        assert sorted(map(repr, rule(delta, few, spec).collect())) == expected and len(expected) == (5 if name == "hub_t" else 15)
    # a later load's files get their filters when they are first asked for
    lake.append("raw_vault", "hub_t", rows(spark, 9000, 9005, 2).select(*HUB.columns), bucket_by="pk")
    assert key_rows(delta, lake.holding("raw_vault", "hub_t", "pk", delta), HUB).count() == 0
    nothing = lake.holding("raw_vault", "hub_t", "pk", rows(spark, 50_000, 50_001, 2), least_files=1)
    assert nothing.count() < 200
    # many keys, or few files: the whole table
    assert len(lake.holding("raw_vault", "hub_t", "pk", delta, most_keys=3).inputFiles()) == len(lake.read("raw_vault", "hub_t").inputFiles())
    assert len(lake.holding("raw_vault", "hub_t", "pk", delta, least_files=10_000).inputFiles()) == len(lake.read("raw_vault", "hub_t").inputFiles())
