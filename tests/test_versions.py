"""Satellites, as-of joins and point-in-time tables against brute force on random histories.

Each key is a history of its own, so one Spark job checks many of them. One key holds a third of
all rows.
"""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakevault.operators.ordered import asof_join, intervals
from lakevault.operators.pit import GHOST_KEY, GHOST_TIME, build_pit
from lakevault.operators.vault import HubSpec, SatSpec, current, key_rows, sat_rows

START = datetime(2020, 1, 1)
SCHEMA = ("k string, hashdiff string, payload string, effective_from timestamp_ntz, "
          "load_datetime timestamp_ntz, record_source string")
SAT = SatSpec("sat", "k", ("payload",), "src", grain="day")
KEYED = SatSpec("sat", "k", ("payload",), "src", one_row_per_key=True)


def row(key, value, at, source="s"):
    return (key, f"h{value}", value, at, at, source)


def histories(seed, keys=60, hours=24 * 9):
    rnd = random.Random(seed)
    rows = []
    for number in range(keys):
        size = rnd.randint(1, 12) if number else 6 * keys  # the first key is the frequent one
        for _ in range(size):
            rows.append(row(f"k{number}", rnd.choice("ABC"), START + timedelta(hours=rnd.randint(0, hours))))
    return rows


def brute_sat(batches):
    """Feed the batches one after the other, each in (time, hash descending) order."""
    stored = {}
    for batch in batches:
        for key in {r[0] for r in batch}:
            have = stored.setdefault(key, [])
            newest = max((r[4] for r in have), default=None)
            fresh = {(r[4], r[1]): r for r in batch if r[0] == key and (newest is None or r[4] >= newest)}
            fresh = {k: r for k, r in fresh.items() if k not in {(h[4], h[1]) for h in have}}
            context = [h for h in have if h[4] == newest]
            chain = sorted([(r, True) for r in fresh.values()] + [(h, False) for h in context],
                           key=lambda x: (x[0][4], [-ord(c) for c in x[0][1]]))
            before = None
            for r, new in chain:
                if new and (before is None or before != r[1]):
                    have.append(r)
                before = r[1]
    return sorted((k, r[1], r[4]) for k, rows in stored.items() for r in rows)


def spark_sat(spark, batches, spec):
    stored = None
    for batch in batches:
        source = spark.createDataFrame(batch, SCHEMA)
        target = spark.createDataFrame(stored, SCHEMA) if stored is not None else None
        added = [tuple(r) for r in sat_rows(source, target, spec).collect()]
        stored = (stored or []) + added
    return sorted((r[0], r[1], r[4]) for r in stored)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_satellite_against_brute_force(spark, seed):
    rows = histories(seed)
    rnd = random.Random(seed)
    batches = [[r for r in rows if rnd.random() < 0.6], rows, [r for r in rows if rnd.random() < 0.5]]
    assert spark_sat(spark, batches, SAT) == brute_sat(batches)


@pytest.mark.parametrize("seed", [4, 5])
def test_keyed_source_gives_the_same_rows(spark, seed):
    rnd = random.Random(seed)
    batches = [
        [row(f"k{n}", rnd.choice("AB"), START + timedelta(days=day + rnd.choice([-1, 0, 0, 1])))
         for n in range(80) if rnd.random() < 0.8]
        for day in (0, 1, 1, 3)
    ]
    expected = brute_sat(batches)
    assert spark_sat(spark, batches, KEYED) == expected
    assert spark_sat(spark, batches, SAT) == expected


@pytest.mark.parametrize("spec", [SAT, KEYED])
def test_returning_value_and_reload(spark, spec):
    days = [START + timedelta(days=d) for d in range(4)]
    batches = [[row("k", v, d)] for v, d in zip("ABAA", days)]
    in_time_order = sorted(spark_sat(spark, batches, spec), key=lambda r: r[2])
    assert [h for _, h, _ in in_time_order] == ["hA", "hB", "hA"]
    assert len(spark_sat(spark, batches + batches, spec)) == 3


def test_late_rows(spark):
    first = [row("k", "A", START + timedelta(days=5))]
    late = [row("k", "B", START + timedelta(days=2)), row("k", "A", START + timedelta(days=3))]
    stored, source = spark.createDataFrame(first, SCHEMA), spark.createDataFrame(late, SCHEMA)
    assert sat_rows(source, stored, SAT).count() == 0
    assert {r.payload for r in sat_rows(source, stored, SAT, late="insert").collect()} == {"A", "B"}
    with pytest.raises(ValueError):
        sat_rows(source, stored, SAT, late="drop")


def test_no_equal_neighbours(spark):
    sat = sat_rows(spark.createDataFrame(histories(9), SCHEMA), None, SAT).collect()
    by_key = {}
    for r in sorted(sat, key=lambda r: (r.load_datetime, [-ord(c) for c in r.hashdiff])):
        by_key.setdefault(r.k, []).append(r.hashdiff)
    assert all(a != b for hashes in by_key.values() for a, b in zip(hashes, hashes[1:]))


def test_hub_takes_earliest_row_and_drops_missing_keys(spark):
    spec = HubSpec("hub", "hk", "id", "src")
    schema = "hk string, id int, load_datetime timestamp_ntz, record_source string"
    rows = [("a", 1, START + timedelta(days=1), "s"), ("a", 1, START, "s"), (None, 2, START, "s"), ("b", 3, START, "s")]
    source = spark.createDataFrame(rows, schema)
    first = key_rows(source, None, spec)
    assert {(r.hk, r.load_datetime) for r in first.collect()} == {("a", START), ("b", START)}
    assert key_rows(source, first, spec).count() == 0


def test_current_breaks_ties_by_hash(spark):
    sat = spark.createDataFrame([row("k", "B", START), row("k", "A", START), row("k", "C", START - timedelta(1))], SCHEMA)
    assert [r.payload for r in current(sat, "k").collect()] == ["A"]


@pytest.mark.parametrize("grain", ["hour", "day", "month"])
def test_asof_join_against_brute_force(spark, grain):
    rows = histories(11)
    versions = {}
    for key, _, value, _, at, _ in rows:
        versions[(key, at)] = min(value, versions.get((key, at), value))
    rnd = random.Random(12)
    left = [(n, f"k{rnd.choice([0, 0, rnd.randint(0, 65)])}", START + timedelta(hours=rnd.randint(-20, 250)))
            for n in range(400)] + [(9001, "k0", None), (9002, None, START)]
    expected = {}
    for n, key, at in left:
        fitting = [(t, v) for (k, t), v in versions.items() if k == key and at is not None and t <= at]
        expected[n] = max(fitting)[::-1] if fitting else (None, None)
    got = asof_join(
        spark.createDataFrame(left, "n int, k string, at timestamp_ntz"),
        spark.createDataFrame([(r[0], r[4], r[2]) for r in rows], "k string, since timestamp_ntz, v string"),
        ["k"], "at", "since", ["v", "since"], tie_break=[F.col("v")], grain=grain).collect()
    assert len(got) == len(left)
    assert {r.n: (r.v, r.since) for r in got} == expected


def test_intervals_do_not_overlap(spark):
    points = sorted({(r[0], r[4]) for r in histories(13)})
    got = intervals(spark.createDataFrame(points, "k string, t timestamp_ntz"), ["k"], "t", "day").collect()
    following = {}
    for key in {k for k, _ in points}:
        times = sorted(t for k, t in points if k == key)
        following |= {(key, a): b for a, b in zip(times, times[1:] + [None])}
    assert {(r.k, r.t): r.valid_to for r in got} == following


def test_pit_against_brute_force(spark):
    rows = histories(14)
    dates = [START + timedelta(days=d) for d in range(-1, 60)]  # more than one pass
    hub = sorted({r[0] for r in rows} | {"lonely"})
    pit = build_pit(spark.createDataFrame([(h,) for h in hub], "k string"), "k",
                    {"sat": spark.createDataFrame(rows, SCHEMA)}, dates)
    got = {(r.k, r.as_of_date): (r.sat_pk, r.sat_ldts) for r in pit.collect()}
    assert len(got) == len(hub) * len(dates)
    for (key, date), found in got.items():
        times = [r[4] for r in rows if r[0] == key and r[4] <= date]
        assert found == ((key, max(times)) if times else (GHOST_KEY, GHOST_TIME))
