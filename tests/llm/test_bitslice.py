"""Bit-sliced search against plain sorting."""

import numpy as np
from pyspark.sql import functions as F

from lakevault.llm import bitslice as op

SCHEMA = "vec_id long, embedding array<double>, block int, q string"


def _brute(rows, asked, k):
    valid = {}
    for vec_id, v, *_ in rows:
        if vec_id is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            valid[vec_id] = min(valid.get(vec_id, v), v)
    q = {i: [int(np.floor(256 * x)) for x in v] for i, v in valid.items()}
    out = []
    for a in q:
        if asked(a):
            scores = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a)[:k]
            out += [(a, r + 1, b, -s) for r, (s, b) in enumerate(scores)]
    return sorted(out)


def test_top_rows_against_sorting(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.2, 16).tolist(), 1, "x") for i in range(400)]
    rows += [(i, rows[7][1], 1, "x") for i in range(400, 470)]  # ties
    rows += [(500, None, 1, "x"), (501, [0.1, None], 1, "x"), (502, [float("nan")] * 16, 1, "x"), (550, [float("inf")] * 16, None, None), (None, rows[0][1], 1, "x")]
    rows += [(600, [0.5] * 3, 1, "x"), (601, [], 1, "x"), (650, [1e6] * 16, 1, "x"), (3, rows[3][1], 1, "x"), (4, rows[9][1], 1, "x")]
    got = op.search_table(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, k=5)
    assert sorted(map(tuple, got.collect())) == _brute(rows, lambda i: i % 50 == 0, 5)
    vectors = op.quantised(spark.createDataFrame(rows, SCHEMA)).cache()
    blocks = op.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, rows_per_block=60, queries_per_block=3)
    assert sorted(map(tuple, blocks.collect())) == _brute(rows, lambda i: i % 50 == 0, 5)


def test_few_rows_and_none(spark):
    rows = [(0, [0.5, -0.25], 1, "x"), (1, [0.1, 0.2], 1, "x")]
    assert sorted(map(tuple, op.search_table(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect())) == _brute(rows, lambda i: i == 0, 5)
    assert op.search_table(spark.createDataFrame(rows[:1], SCHEMA), F.col("vec_id") == 0).collect() == []
    assert op.search_table(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0).collect() == []
