"""Stored tables: merge, replace, append, recovery; ingest on top of them."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.plans import build
from lakevault.plans.queries_time import AS_OF
from lakevault.sources import drift, tables
from lakevault.sources.contracts import ContractError
from lakevault.sources.ingest import from_config, ingest, last_cursor
from lakevault.sources.tables import ProtectedTableError, buckets_for


def frame(spark, rows, schema="id int, v string"):
    return spark.createDataFrame(rows, schema)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_spread_delta_writes_only_its_own_rows(spark, lake):
    lake.merge("raw", "t", frame(spark, [(i, "a") for i in range(4000)]), ["id"])
    files = lambda: {r[0] for r in spark.table(lake.name("raw", "t__s1")).select("_metadata.file_path").distinct().collect()}
    before = files()
    for value in "bc":
        lake.merge("raw", "t", frame(spark, [(i * 41, value) for i in range(100)]), ["id"])
    assert before < files()
    assert spark.table(lake.name("raw", "t__s1")).count() == 4200
    expected = sorted([(i, "a") for i in range(4000) if i % 41 or i >= 4100] + [(i * 41, "c") for i in range(100)])
    assert content(lake.read("raw", "t")) == expected
    in_use = lake.read("raw", "t")
    lake.fold("raw", "t")
    assert content(lake.read("raw", "t")) == expected and content(in_use) == expected
    lake.fold("raw", "t")
    lake.merge("raw", "t", frame(spark, [(5, "z")]), ["id"])
    assert lake.read("raw", "t").count() == len(expected)


def test_many_deliveries_are_folded(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "FOLD_AFTER", 3)
    for number in range(9):
        lake.merge("raw", "t", frame(spark, [(number, "new"), (number - 1, "again"), (None, str(number))]), ["id"], check=False)
    assert content_of(lake.read("raw", "t")) == content_of([(i, "again") for i in range(-1, 8)] + [(8, "new"), (None, "8")])
    state = lake._state("raw", "t")
    assert state["newest"] - state["base"] < 3
    # partitions that only older readers saw are gone
    assert spark.table(lake.name("raw", "t__s1")).select("_merge_no").distinct().count() < 9


def content_of(rows):
    return sorted((tuple(r) for r in (rows if isinstance(rows, list) else rows.collect())), key=repr)


def test_null_keys_are_keys(spark, lake):
    for delivery in ([(None, "n1"), (1, "a")], [(None, "n2")]):
        lake.merge("raw", "t", frame(spark, delivery), ["id"], check=False)
    assert content_of(lake.read("raw", "t")) == content_of([(None, "n2"), (1, "a")])
    lake.fold("raw", "t")
    lake.merge("raw", "t", frame(spark, [(None, "n3")]), ["id"], check=False)
    assert content_of(lake.read("raw", "t")) == content_of([(None, "n3"), (1, "a")])


def test_dropped_tables_leave_nothing(spark, lake):
    lake.merge("raw", "t", frame(spark, [(1, "a")]), ["id"])
    lake.merge("raw", "t", frame(spark, [(1, "b", 2.5)], "id int, v string, w double"), ["id"])
    lake.append_load("raw", "u", frame(spark, [(1, "a")]), "l1")
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(1, "a")]))
    for layer, table in (("raw", "t"), ("raw", "u"), ("mart", "m")):
        lake.drop(layer, table)
        assert not [t for t in spark.catalog.listTables(lake.db(layer)) if t.name.startswith(table)]
    lake.merge("raw", "t", frame(spark, [(7, "z")]), ["id"])
    assert content(lake.read("raw", "t")) == [(7, "z")]


def test_dropped_tables_leave_no_cells_filters_and_logs(spark, lake, monkeypatch):
    """A table that is stored again under a dropped one's name is not read by what was known of the old one."""
    monkeypatch.setattr(tables, "COMMENT_CHARS", 0)  # as with many cells: they are rows of meta.cells
    lake.refresh("mart", "other", ["id"], rows=frame(spark, [(1, "o")]))
    lake.refresh("mart", "other", ["id"], rows=frame(spark, [(1, "p")]))
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(1, "a"), (2, "a")]))
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(1, "b")]))
    lake.drop("mart", "m")
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(1, "c"), (2, "c")]))
    lake.refresh("mart", "m", ["id"], added=frame(spark, [(30, "c")]))
    assert content(lake.read("mart", "m")) == [(1, "c"), (2, "c"), (30, "c")]
    assert content(lake.read("mart", "other")) == [(1, "p")]
    for n in range(3):
        lake.append("raw_vault", "h", frame(spark, [(n, "h")]).coalesce(1))
    lake.holding("raw_vault", "h", "id", frame(spark, [(1, "h")]), least_files=1)
    assert lake.exists("meta", "raw_vault__h__filters")
    frame(spark, [(1, "l")]).write.saveAsTable(f"{lake.name('psa', 'p')}__log")
    lake.drop("raw_vault", "h")
    lake.drop("psa", "p")
    assert not lake.exists("meta", "raw_vault__h__filters") and not lake.exists("psa", "p__log")


# --- schema drift ---


def test_joins_of_types():
    kind = T.DataType.fromDDL
    for a, b, c in (("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
                    ("bigint", "double", None), ("decimal(9,2)", "decimal(12,4)", "decimal(12,4)"), ("int", "decimal(9,2)", "decimal(12,2)"),
                    ("decimal(38,2)", "decimal(38,4)", None), ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp", "timestamp_ntz", None),
                    ("string", "int", None), ("boolean", "int", None), ("array<int>", "array<bigint>", "array<bigint>"), ("void", "int", "int"),
                    ("struct<a:int,b:string>", "struct<a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"), ("struct<a:int>", "struct<a:string>", None)):
        for x, y in ((a, b), (b, a)):
            found = drift.join(kind(x), kind(y))
            if "struct" in a and c:
                assert sorted(found.names) == ["a", "b", "c"]
            else:
                assert (found.simpleString() if found else None) == c, (x, y)
    assert drift.widest(["int", "bigint", "decimal(5,2)"]) == "decimal(21,2)" and drift.widest(["int", "string"]) is None


def test_wider_types_open_a_store_and_rewrite_nothing(spark, lake):
    shapes = [("id int, v float", (1, 1.5)), ("id bigint, v double, s struct<a:int>", (2**40, 2.5, (3,))), ("id int, s struct<a:bigint,b:string>", (7, (2**50, "x")))]
    for number, (shape, row) in enumerate(shapes):
        lake.append_load("raw", "t", frame(spark, [row], shape), f"l{number}")
    got = {(r.id, r.v, r.s and r.s.asDict().get("a"), r.s and r.s.b) for r in lake.read("raw", "t").collect()}
    assert got == {(1, 1.5, None, None), (2**40, 2.5, 3, None), (7, None, 2**50, "x")}
    assert lake._state("raw", "t")["stores"] == [1, 2, 3]
    lake.append_load("raw", "t", frame(spark, [(9, 0.5)], "id int, v float"), "l3")  # narrower: the newest store takes it
    assert lake._state("raw", "t")["stores"] == [1, 2, 3] and lake.read("raw", "t").count() == 4
    assert lake.read("raw", "t").where("_load_id = 'l0'").count() == 1


def test_unrelated_types_go_to_a_variant_column(spark, lake):
    lake.merge("raw", "t", frame(spark, [(1, 5), (2, 6)], "id int, v int"), ["id"])
    lake.merge("raw", "t", frame(spark, [(2, "six"), (3, "seven")]), ["id"])
    lake.merge("raw", "t", frame(spark, [(3, 2**40)], "id bigint, v bigint"), ["id"])
    assert {tuple(r) for r in lake.read("raw", "t").select("id", "v", "v__v_string").collect()} == {(1, 5, None), (2, None, "six"), (3, 2**40, None)}
    with pytest.raises(ValueError, match="key column"):
        lake.merge("raw", "t", frame(spark, [("x", 1)], "id string, v int"), ["id"])


def test_a_cursor_that_widens_goes_on(spark, lake):
    for number, (shape, rows) in enumerate((("id int", [(1,), (2,)]), ("id bigint", [(2,), (2**40,)]), ("id bigint", [(2**40,), (2**41,)]), ("id int", [(5,)]))):
        folder = f"{lake.root}/drops/wide/{number}"
        frame(spark, rows, shape).write.parquet(folder)
        ingest(lake, _spec(folder, write_disposition="append", incremental={"cursor": "id"}), f"l{number}")
    assert sorted(r.id for r in lake.read("raw_e", "e").collect()) == [1, 2, 2**40, 2**41]
    assert last_cursor(lake, "e", "e") == str(2**41)


# --- refresh ---


def test_refresh_against_a_plain_table(spark, lake):
    rng = random.Random(1)
    lake.buckets, state = 16, {i: "0" for i in range(200)}
    lake.refresh("mart", "m", ["id"], rows=frame(spark, list(state.items())))
    for number in range(1, 5):
        changed = {i: str(number) for i in rng.sample(sorted(state), 3)}
        new = {1000 * number + i: "new" for i in range(3)} if number % 2 else {}
        in_use, before = lake.read("mart", "m"), dict(state)
        lake.refresh("mart", "m", ["id"], rows=frame(spark, list(changed.items())), added=frame(spark, list(new.items())) if new else None)
        state |= changed | new
        assert content(lake.read("mart", "m")) == sorted(state.items())
        assert content(in_use) == sorted(before.items())
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(1, "all")]), whole=True)
    lake.refresh("mart", "m", ["id"], added=frame(spark, [(2, "too")]))
    assert content(lake.read("mart", "m")) == [(1, "all"), (2, "too")]


def test_refresh_writes_only_touched_cells(spark, lake):
    lake.buckets = 32
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(i, "a") for i in range(320)]))
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(5, "b")]))
    written = spark.table(lake.name("mart", "m__r")).where("_run = 2")
    assert written.select("_bucket").distinct().count() == 1 and written.count() < 40


def test_refresh_that_died_is_repeated(spark, lake):
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(1, "a"), (2, "a")]))
    text = spark.sql(f"SHOW CREATE TABLE {lake.name('mart', 'm')}").first()[0]
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(1, "lost")]), added=frame(spark, [(9, "lost")]))
    spark.sql(f"DROP VIEW {lake.name('mart', 'm')}")
    spark.sql(text)  # as if it had stopped before replacing the view
    assert content(lake.read("mart", "m")) == [(1, "a"), (2, "a")]
    lake.refresh("mart", "m", ["id"], rows=frame(spark, [(2, "b")]))
    assert content(lake.read("mart", "m")) == [(1, "a"), (2, "b")]


def test_merge_refuses_repeated_and_missing_keys(spark, lake):
    with pytest.raises(ContractError):
        lake.merge("raw", "t", frame(spark, [(1, "a"), (1, "b")]), ["id"])
    assert not lake.exists("raw", "t")
    lake.merge("raw", "t", frame(spark, [(1, "a")]), ["id"])
    with pytest.raises(ContractError):
        lake.merge("raw", "t", frame(spark, [(None, "b")]), ["id"])
    assert content(lake.read("raw", "t")) == [(1, "a")]


def test_first_delivery_is_checked_before_it_is_visible(spark, lake):
    with pytest.raises(ContractError):
        lake.merge("raw", "t", frame(spark, [(1, "a"), (1, "b")]), ["id"])
    assert not lake.exists("raw", "t") and lake.tables("raw") == []
    lake.merge("raw", "t", frame(spark, [(1, "a"), (2, "b")]), ["id"])
    assert content(lake.read("raw", "t")) == [(1, "a"), (2, "b")] and lake.tables("raw") == ["t"]


def test_a_checked_delivery_is_made_once(spark, lake):
    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def key(n):
        made.add(1)
        return n

    rows = spark.range(40).select(key(F.col("id").cast("int")).alias("id"), F.lit("a").alias("v"))
    lake.merge("raw", "t", rows, ["id"])
    assert made.value == 40 and lake.read("raw", "t").count() == 40


def test_a_refused_delivery_leaves_the_table_as_it_was(spark, lake):
    with pytest.raises(ContractError):
        lake.merge("raw", "t", frame(spark, [(1, "a"), (1, "b")]), ["id"])
    assert not lake.exists("raw", "t")
    lake.merge("raw", "t", frame(spark, [(1, "a")]), ["id"])
    for bad in ([(2, "x"), (2, "y")], [(None, "x")]):
        with pytest.raises(ContractError):
            lake.merge("raw", "t", frame(spark, bad), ["id"])
        assert content(lake.read("raw", "t")) == [(1, "a")]
    # a delivery of another shape goes to another store
    lake.merge("raw", "t", frame(spark, [(3, "c", 1.5)], "id int, v string, w double"), ["id"])
    assert content_of(lake.read("raw", "t")) == content_of([(1, "a", None), (3, "c", 1.5)])
    lake.merge("raw", "t", frame(spark, [(3, "d")]), ["id"])
    assert content_of(lake.read("raw", "t")) == content_of([(1, "a", None), (3, "d", None)])


def test_bucket_count_grows_with_the_input():
    assert buckets_for(0) == 8 and buckets_for(100 << 30) == 256 and buckets_for(100 << 40) == 262_144


def test_merge_takes_new_columns(spark, lake):
    lake.merge("raw", "t", frame(spark, [(1, "a"), (2, "a")]), ["id"])
    lake.merge("raw", "t", frame(spark, [(2, "b", 7)], "id int, v string, w int"), ["id"])
    assert {(r.id, r.v, r.w) for r in lake.read("raw", "t").collect()} == {(1, "a", None), (2, "b", 7)}


def test_replace_keeps_the_version_in_use(spark, lake):
    lake.replace("mart", "m", frame(spark, [(1, "a")]))
    in_use = lake.read("mart", "m")
    lake.replace("mart", "m", frame(spark, [(2, "b")]))
    assert content(in_use) == [(1, "a")]
    assert content(lake.read("mart", "m")) == [(2, "b")]
    # a table may be rebuilt from itself
    lake.replace("mart", "m", lake.read("mart", "m").unionByName(frame(spark, [(3, "c")])))
    assert content(lake.read("mart", "m")) == [(2, "b"), (3, "c")]
    assert len([t for t in spark.catalog.listTables(lake.db("mart")) if "__v" in t.name]) == 2


def test_vault_is_protected_from_rebuild(spark, lake):
    with pytest.raises(ProtectedTableError):
        lake.replace("raw_vault", "hub_x", frame(spark, [(1, "a")]))


def test_append_load_is_idempotent(spark, lake):
    for load in ("1", "2", "2"):
        lake.append_load("raw", "t", frame(spark, [(int(load), "a")]), load)
    lake.append_load("raw", "t", frame(spark, [(3, 4)], "id int, w int"), "3")
    got = {(r.id, r.v, r.w) for r in lake.read("raw", "t").collect()}
    assert got == {(1, "a", None), (2, "a", None), (3, None, 4)}


def test_teardown_and_counts(spark, lake):
    lake.append("raw_vault", "hub_x", frame(spark, [(1, "a"), (2, "b")]), bucket_by="v")
    lake.replace("mart", "m", lake.read("raw_vault", "hub_x"))
    assert content(lake.counts(["raw_vault", "mart"])) == [("mart.m", 1 * 2), ("raw_vault.hub_x", 2)]
    lake.teardown()
    assert not lake.exists("raw_vault", "hub_x") and not lake.exists("mart", "m")


def _events(lake, number, rows):
    folder = f"{lake.root}/drops/{number}"
    frame(lake.spark, rows, "id int, ts timestamp_ntz, v string").write.parquet(folder)
    return folder


def _spec(folder, **more):
    return from_config({"name": "e", "type": "filesystem", "path": folder, "file_glob": "*.parquet",
                        "target": {"schema": "raw_e"}, **more})


def test_incremental_merge(spark, lake):
    t = lambda day: datetime(2024, 1, day)
    options = {"primary_key": "id", "write_disposition": "merge", "incremental": {"cursor": "ts", "initial_value": "2024-01-02"}}
    first = _events(lake, 1, [(1, t(1), "a"), (2, t(2), "a"), (3, t(3), "a")])
    assert ingest(lake, _spec(first, **options), "l1")[0]["row_count"] == 2
    second = _events(lake, 2, [(2, t(2), "x"), (3, t(3), "b"), (4, t(4), "a"), (4, t(5), "b")])
    result = ingest(lake, _spec(second, **options), "l2")
    assert result[0]["row_count"] == 3  # id 2 is older than the cursor
    assert content(lake.read("raw_e", "e").select("id", "v")) == [(2, "a"), (3, "b"), (4, "b")]
    assert last_cursor(lake, "e", "e").startswith("2024-01-05")
    assert ingest(lake, _spec(second, **options), "l2") == result  # a load that is logged already
    assert lake.read("meta", "loads").count() == 2


APPEND = {"write_disposition": "append", "incremental": {"cursor": "ts"}}


def test_append_keeps_boundary_rows_once(spark, lake):
    t = lambda day: datetime(2024, 1, day)
    drops = [[(1, t(1), "a"), (2, t(2), "b")], [(2, t(2), "b"), (3, t(2), "late"), (4, t(3), None)], [(4, t(3), None)]]
    for number, rows in enumerate(drops):
        ingest(lake, _spec(_events(lake, number, rows), **APPEND), f"l{number}")
    got = sorted(r.id for r in lake.read("raw_e", "e").collect())
    assert got == [1, 2, 3, 4]


def test_repeated_load_after_a_crash(spark, lake, monkeypatch):
    t = lambda day: datetime(2024, 1, day)
    ingest(lake, _spec(_events(lake, 1, [(1, t(1), "a")]), **APPEND), "l1")
    second = _spec(_events(lake, 2, [(1, t(1), "a"), (2, t(2), "b"), (3, t(3), "c")]), **APPEND)

    def refused(*args, **kwargs):
        raise ConnectionError("before the log row")

    with monkeypatch.context() as m:
        m.setattr(lake, "append", refused)
        with pytest.raises(ConnectionError):
            ingest(lake, second, "l2")
    assert last_cursor(lake, "e", "e").startswith("2024-01-01")
    ingest(lake, second, "l2")
    assert sorted(r.id for r in lake.read("raw_e", "e").collect()) == [1, 2, 3]


def test_cursor_is_the_highest_value_not_the_last_load_id(spark, lake):
    for load, day in (("load-9", 2), ("load-10", 14), ("load-11", 9)):
        ingest(lake, _spec(_events(lake, day, [(day, datetime(2024, 1, day), "a")]), **APPEND), load)
    assert last_cursor(lake, "e", "e").startswith("2024-01-14")


def test_full_run_delta_and_rerun(spark, lake, sf_dir):
    build.build_all(lake, spark, sf_dir, AS_OF)
    first = dict(content(lake.counts(["raw_vault"])))
    build.apply_delta(lake, spark, sf_dir, AS_OF)
    second = dict(content(lake.counts(["raw_vault", "mart"])))
    build.apply_delta(lake, spark, sf_dir, AS_OF)
    assert dict(content(lake.counts(["raw_vault", "mart"]))) == second
    results = build.run_tests(lake, datetime(2024, 1, 31), "r1", store_failures=True)
    assert results.count() == 48
    early = lake.read("dq_audit", "pair_a_not_below_b_stg_orders_shipped_date_order_date")
    assert early.count() == results.where("test = 'pair_a_not_below_b'").first()["failures"]
    build.run_freshness(lake, datetime(2024, 1, 31), "r1")
    assert build.run_freshness(lake, datetime(2024, 1, 31), "r1").count() == 5
    new = spark.read.parquet(f"{sf_dir}/supplier.parquet").count()
    changed = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal < 0").count()
    assert second["raw_vault.hub_customer"] - first["raw_vault.hub_customer"] == new
    assert second["raw_vault.sat_customer"] - first["raw_vault.sat_customer"] == new + changed
    assert second["raw_vault.pit_customer"] == second["raw_vault.hub_customer"] * len(AS_OF)


def test_a_merge_of_single_keys_does_not_shuffle_whole_rows(spark, lake, tmp_path, monkeypatch):
    plans = []
    merged = type(lake).merge

    def watched(self, layer, table, delta, *args, **kwargs):
        plans.append(delta._jdf.queryExecution().executedPlan().toString())
        return merged(self, layer, table, delta, *args, **kwargs)

    monkeypatch.setattr(type(lake), "merge", watched)
    once = [(1, None, "a"), (1, 2, "b"), (None, None, "c")]
    for number, rows in enumerate((once, [*once, (1, 2, "b")]), 1):
        spark.createDataFrame(rows, "x int, y int, v string").write.parquet(f"{tmp_path}/{number}")
        spec = from_config({"name": "t", "type": "filesystem", "path": f"{tmp_path}/{number}", "file_glob": "*.parquet",
                            "write_disposition": "merge", "primary_key": ["x", "y"], "target": {"schema": "raw"}})
        ingest(lake, spec, f"load-{number}")
        assert sorted(map(str, lake.read("raw", "t").collect())) == sorted(map(str, spark.createDataFrame(once, "x int, y int, v string").collect()))
    assert "Window" not in plans[0] and "Window" in plans[1]
