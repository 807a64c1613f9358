"""A suite's tests on one model cost one scan and one exchange of it."""

import random

from pyspark.sql import functions as F

from lakevault.operators import quality as q


def suite():
    return [
        q.not_null("m", "a"), q.unique("m", "id"), q.unique("m", "a"), q.compound_unique("m", ["a", "b"]), q.distinct_count("m", "b", 3),
        q.unique_ratio("m", "a", 0.1, 0.9), q.accepted("m", "b", ["x", "y"]), q.row_count("m", 5, 10_000), q.between("m", "id", 0, 50),
    ]


def test_grouping_sets_against_single_tests(spark):
    rng = random.Random(4)
    for size in (0, 1, 200):
        rows = [(i if rng.random() < 0.9 else None, rng.choice([None, *range(30)]), rng.choice(["x", "y", "z", None])) for i in range(size)]
        df = spark.createDataFrame(rows, "id int, a int, b string")
        got = {(r.test, r.column): (r.failures, r.checked_rows) for r in q.run({"m": df}, suite()).collect()}
        one = {}
        for test in suite():
            r = q.run({"m": df}, [test]).first()
            one[r.test, r.column] = (r.failures, r.checked_rows)
        ids = [r[0] for r in rows if r[0] is not None]
        values = [r[1] for r in rows if r[1] is not None]
        pairs = [r[1:] for r in rows]
        assert got["unique", "id"] == (len([v for v in set(ids) if ids.count(v) > 1]), size)
        assert got["unique", "a"] == (len([v for v in set(values) if values.count(v) > 1]), size)
        assert got["compound_unique", "a,b"] == (sum(pairs.count(p) > 1 for p in pairs), size)
        assert got["not_null", "a"] == (size - len(values), size)
        assert got["accepted_values", "b"] == (len({r[2] for r in rows} & {"z"}), size)
        assert got == one


def test_one_scan_and_one_exchange(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("int").alias("id"), (F.col("id") % 7).cast("int").alias("a"), F.lit("x").alias("b")).write.parquet(f"{tmp_path}/m")
    plan = q.run({"m": spark.read.parquet(f"{tmp_path}/m")}, suite())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1
    # the second exchange carries one row per grouping set and task
    assert plan.count("Exchange hashpartitioning") == 2


def test_groups_are_not_joined_or_dealt_by_set(spark, tmp_path):
    """However many groups there are, what is shuffled by set is combined first: no set is one task's rows."""
    spark.range(1000).select(F.col("id").cast("int").alias("id"), (F.col("id") % 7).cast("int").alias("a"), F.lit("x").alias("b")).write.parquet(f"{tmp_path}/m")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the groups are too large for a broadcast
    try:
        plan = q.run({"m": spark.read.parquet(f"{tmp_path}/m")}, suite())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_stored_models_are_grouped_where_they_lie(spark, lake):
    """Same results, and a test on the column that a table lies by shuffles no row."""
    rng = random.Random(5)
    md5 = lambda n: None if n is None else f"{n:032x}"
    rows = [(md5(rng.choice([None, *range(60)])), md5(rng.choice([None, *range(9)])), rng.randrange(3)) for _ in range(150)]
    suite = [q.unique("t", "a_hk"), q.unique_ratio("t", "a_hk", 0.1, 0.9), q.compound_unique("t", ["a_hk", "b_hk"]), q.unique("t", "b_hk"), q.not_null("t", "b_hk"),
             q.compound_unique("t", ["b_hk", "n"]), q.accepted("t", "b_hk", [md5(1), md5(2)]), q.distinct_count("t", "n", 3), q.row_count("t", 1), q.matches("t", "b_hk", "^0+[0-7]$")]
    for n in (0, len(rows)):
        lake.append("raw_vault", f"t{n}", spark.createDataFrame(rows[:n], "a_hk string, b_hk string, n int"), bucket_by="a_hk")
        models = {"t": lake.read("raw_vault", f"t{n}")}
        plain, placed = ({tuple(r) for r in q.run(models, suite, *more).collect()} for more in ((), ({"t": "a_hk"}, {"a_hk", "b_hk"})))
        assert len(plain) == len(suite) and plain == placed
    plan = q.run(models, [q.unique("t", "a_hk"), q.compound_unique("t", ["a_hk", "b_hk"])], {"t": "a_hk"})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    plan = q.run(models, [q.unique("t", "b_hk")], {"t": "a_hk"}, {"b_hk"})._jdf.queryExecution().executedPlan().toString()
    assert "unhex(b_hk" in plan
