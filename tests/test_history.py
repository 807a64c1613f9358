"""Historised staging over several stored runs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakevault.operators import history as scd
from lakevault.plans import build
from lakevault.sources.contracts import ContractError

SPEC = scd.Scd2Spec(
    key="id", types={"id": "bigint", "name": "string", "change_date": "timestamp_ntz"},
    tracked=("name",), dedup=("id", "name", "change_date"), change_col="change_date",
    source="raw.t", surrogate="t_sk")
DAY = datetime(2024, 1, 1)


def deliver(spark, lake, rows, day, deletes=True):
    source = spark.createDataFrame([(k, v, DAY) for k, v in rows], "id int, name string, change_date timestamp_ntz")
    build.psa_run(lake, SPEC, "t", source, DAY + timedelta(days=day), deletes)


def test_runs_against_brute_force(spark, lake):
    rnd = random.Random(3)
    stored, states = [], []
    for day in range(5):
        state = {k: rnd.choice(["x", "y", None]) for k in range(40) if rnd.random() < 0.7}
        states.append(state)
        now = DAY + timedelta(days=day)
        live = {r["id"]: r for r in stored if r["cur"]}
        for key, r in live.items():
            if key not in state:
                r.update(cur=0, deleted=1, to=now)
            elif (state[key] or "") != (r["name"] or ""):
                r.update(cur=0, to=now)
        for key, value in state.items():
            if key not in live or not live[key]["cur"]:
                stored.append(dict(id=key, name=value, cur=1, deleted=0, start=now, to=None))
        deliver(spark, lake, state.items(), day)
        got = sorted((r.id, r.name or "", r.ng_valid_from, str(r.ng_valid_to), r.ng_is_current, r.ng_is_deleted)
                     for r in lake.read("psa", "t").collect())
        assert got == sorted((r["id"], r["name"] or "", r["start"], str(r["to"]), r["cur"], r["deleted"]) for r in stored)
    with pytest.raises(ValueError, match="another delivery"):
        deliver(spark, lake, [(999, "late")], 4)
    deliver(spark, lake, states[4].items(), 4)  # a run that is applied already
    psa = lake.read("psa", "t")
    assert psa.where("id = 999").count() == 0
    assert psa.select("t_sk").distinct().count() == psa.count()
    assert psa.where("ng_is_current = 1").groupBy("id").count().where("count > 1").count() == 0
    for day, state in enumerate(states):
        moment = F.lit(str(DAY + timedelta(days=day, hours=1))).cast("timestamp_ntz")
        assert {r.id for r in scd.as_of(psa, moment).collect()} == set(state)


def test_without_delete_detection_keys_stay(spark, lake):
    deliver(spark, lake, [(1, "a"), (2, "b")], 0)
    deliver(spark, lake, [(1, "c")], 1, deletes=False)
    assert {(r.id, r.name) for r in scd.current_view(lake.read("psa", "t")).collect()} == {(1, "c"), (2, "b")}
    assert scd.status(lake.read("psa", "t")).first().asDict() == {
        "total": 3, "current_versions": 2, "deleted": 0, "historic": 1}


def test_two_rows_of_one_key_are_refused(spark, lake):
    with pytest.raises(ContractError):
        deliver(spark, lake, [(1, "a"), (1, "b")], 0)
    deliver(spark, lake, [(1, "a"), (1, "a")], 0)  # exact repeats are fine
    assert lake.read("psa", "t").count() == 1


def test_run_that_died_before_it_became_visible(spark, lake):
    deliver(spark, lake, [(1, "a"), (2, "b")], 0)
    view = lake.name("psa", "t")
    text = lake.spark.sql(f"SHOW CREATE TABLE {view}").first()[0]
    deliver(spark, lake, [(1, "c")], 1)
    lake.spark.sql(f"DROP VIEW {view}")
    lake.spark.sql(text)  # as if the second run had stopped before replacing the view
    assert {(r.id, r.name) for r in lake.read("psa", "t").collect()} == {(1, "a"), (2, "b")}
    deliver(spark, lake, [(1, "c")], 1)
    assert scd.status(lake.read("psa", "t")).first().asDict() == {
        "total": 3, "current_versions": 1, "deleted": 1, "historic": 1}


def test_delete_then_return(spark, lake):
    for day, rows in enumerate(([(1, "a")], [], [(1, "a")])):
        deliver(spark, lake, rows, day)
    got = [(r.ng_is_current, r.ng_is_deleted) for r in lake.read("psa", "t").orderBy("ng_valid_from").collect()]
    assert got == [(0, 1), (1, 0)]


def test_only_a_true_repeat_is_skipped(spark, lake):
    deliver(spark, lake, [(1, "a")], 1)
    deliver(spark, lake, [(1, "a")], 1)
    assert lake.read("psa", "t").count() == 1
    with pytest.raises(ValueError, match="another delivery"):
        deliver(spark, lake, [(1, "b")], 1)
    with pytest.raises(ValueError, match="older"):
        deliver(spark, lake, [(1, "a")], 0)


def test_a_run_writes_what_it_changes(spark, lake):
    """Ten changed rows of very many: ten closed and ten opened events, and no snapshot."""
    rows = {i: "x" for i in range(5000)}
    deliver(spark, lake, rows.items(), 0)
    for i in range(10):
        rows[i * 7] = "y"
    deliver(spark, lake, rows.items(), 1)
    log = spark.table(lake.name("psa", "t__log"))
    run = log.agg(F.max("ng_run")).first()[0]
    assert {r.ng_kind: r["count"] for r in log.where(F.col("ng_run") == run).groupBy("ng_kind").count().collect()} == {"opened": 10, "closed": 10}


def test_a_snapshot_ends_the_reading_of_the_log(spark, lake):
    rng = random.Random(5)
    for day in range(6):
        state = {k: rng.choice("abc") for k in range(20) if rng.random() < 0.8}
        deliver(spark, lake, state.items(), day)
        assert {(r.id, r.name) for r in scd.current_view(lake.read("psa", "t")).collect()} == set(state.items())
    kept = build.psa_state(lake, "t")
    assert kept["base_kind"] == "open" and kept["held"] == len(state)
    first = spark.table(lake.name("psa", "t__log")).agg(F.min("ng_run")).first()[0]
    assert kept["base"] > first
    open_ = build._open_versions(lake, SPEC, "t", kept)
    assert {(r.id, r.name) for r in open_.collect()} == set(state.items())


def test_what_a_dead_run_left_is_written_anew(spark, lake):
    deliver(spark, lake, [(1, "a"), (2, "b")], 0)
    text = lake.spark.sql(f"SHOW CREATE TABLE {lake.name('psa', 't')}").first()[0]
    deliver(spark, lake, [(1, "c"), (2, "b"), (3, "c")], 1)
    lake.spark.sql(f"DROP VIEW {lake.name('psa', 't')}")
    lake.spark.sql(text)
    deliver(spark, lake, [(1, "a"), (2, "b"), (4, "d")], 1)  # another delivery than the one that died
    assert {(r.id, r.name) for r in lake.read("psa", "t").collect()} == {(1, "a"), (2, "b"), (4, "d")}
