"""Poisson mixing: counts against plain inversion, rates, the odd cases."""

from collections import Counter

import pytest
from test_pipeline import _draw

from lakevault.llm import poisson_mix as op

SCHEMA = "doc_id long, text string, source string, copy string, rate double"


def _rows():
    rows = [(i, f"t{i}", ["a", "a", "a", "b", None][i % 5], "x", 0.5) for i in range(500)]
    return rows + [(1, "t1", "a", "x", 0.5), (None, None, "b", None, None), (501, "", "c", "x", 0.5), (502, "long " * 50_000, "b", "x", 0.5)]


def test_counts_against_plain_inversion(spark):
    rows, weights = _rows(), {"a": 1.0, "b": 2.0, "c": 5.0, "d": 7.0}
    out = op.mix(spark.createDataFrame(rows, SCHEMA), weights=weights, seed=3)
    assert out.columns == ["doc_id", "text", "source", "rate", "copy", "shuffle_key"]
    sizes = Counter(r[2] for r in rows)
    mass = sum(weights.get(s, 0.0) for s in sizes)
    want = Counter()
    for r in rows:
        if r[2] in weights and r[0] is not None:
            want[r[0]] += _draw(3, r[0], weights[r[2]] / mass * len(rows) / sizes[r[2]])
    got = Counter(r.doc_id for r in out.collect())
    got.pop(None, None)
    assert got == +want and got[501] > 100


def test_totals_follow_the_target(spark):
    rows = [(i, "t", f"s{min(i % 8, 3)}", "x", 0.0) for i in range(8000)]
    got = Counter(r.source for r in op.mix(spark.createDataFrame(rows, SCHEMA), power=0.0, total=8000).select("source").collect())
    assert all(abs(n - 2000) < 300 for n in got.values()) and len(got) == 4


def test_odd_cases(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA)
    with pytest.raises(ValueError):
        op.mix(docs, weights={"a": -1.0})
    assert op.mix(docs, weights={"zzz": 1.0}).collect() == []
    assert op.mix(docs.limit(0)).collect() == []
