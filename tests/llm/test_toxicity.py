"""Ordinal toxicity: held-out accuracy, ordered grades, and the odd cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevault.llm import toxicity as op

SCHEMA = "doc_id long, text string, severity double, toxic string"


def _corpus(n, seed):
    rng = random.Random(seed)
    plain = [f"w{i}" for i in range(400)]
    bad = ["vile", "rotten", "stinkeda", "stinkedo", "stinkedu"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        toxic = rng.random() < 0.2
        for _ in range(rng.choice([2, 3, 8]) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad).upper())
        docs.append((i, " ".join(words), 0.0, "clash"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/{t}.parquet") for t in ("documents", "labels"))
    model = op.train(docs, labels.filter("doc_id % 2 = 0"))
    got = op.score(docs, model).join(labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "truth"), "doc_id")
    counts = {(r.truth, r.toxic): r["count"] for r in got.groupBy("truth", "toxic").count().collect()}
    hit, missed, wrong = counts.get((1, True), 0), counts.get((1, False), 0), counts.get((0, True), 0)
    assert hit / (hit + missed) > 0.85 and hit / (hit + wrong) > 0.97


def test_severity_follows_grades(spark):
    docs, labels = _corpus(600, 1)
    frame = spark.createDataFrame(docs, SCHEMA)
    model = op.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    new, truth = _corpus(300, 2)
    got = {r.doc_id: r for r in op.score(spark.createDataFrame(new, SCHEMA), model).collect()}
    assert sum(got[i].toxic == bool(t) for i, t in truth) >= 297
    mild, grave = model.score("vile w1 w2"), model.score("vile rotten stinkedx stinkedo w1")
    assert grave > mild
    p = model.at_least(np.array([mild, grave]))
    assert p.sum(axis=1)[0] < p.sum(axis=1)[1] and (p[:, 0] >= p[:, 1]).all()
    kept = {r.doc_id for r in op.keep_clean(spark.createDataFrame(new, SCHEMA), model).collect()}
    assert kept == {i for i, r in got.items() if not r.toxic}


def test_given_grades_are_used():
    grades = np.array([0, 1, 2, 3] * 25)
    rows = np.concatenate([np.repeat(i, g) for i, g in enumerate(grades)])
    cols = np.concatenate([np.arange(g) for g in grades])
    model = op.fit(rows, cols, np.ones(len(rows)), np.ones(100), grades, ["=a", "=b", "=c"])
    severity = [model.at_least(np.array([model.score(t)])).sum() for t in ("x", "a x", "a b", "a b c")]
    assert severity == sorted(severity) and len(model.thresholds) == 3 and severity[0] < 0.5 < 2.5 < severity[3]


def test_odd_rows_and_one_class(spark):
    docs = spark.createDataFrame([(1, None, 1.0, "x"), (1, "", 1.0, "x"), (None, "a " * 50_000, None, None), (2, "b", 0.0, "x")], SCHEMA)
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (9, 1), (2, -1)], "doc_id long, toxic int")
    with pytest.warns(UserWarning, match="0 toxic and 1 clean"):
        model = op.train(docs, labels)
    got = op.score(docs, model).collect()
    assert len(got) == 4 and all((r.severity, r.grade, r.toxic) == (None, None, None) for r in got)
    assert op.keep_clean(docs, model).count() == 4
    with pytest.warns(UserWarning):
        assert op.score(docs.filter(F.lit(False)), op.train(docs.filter(F.lit(False)), labels)).collect() == []


def test_labels_without_a_document_take_no_place_in_the_sample(spark):
    docs, labels = _corpus(60, 4)
    strangers = [(10_000 + i, i % 2) for i in range(2000)]
    model = op.train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels + strangers + [(0, -3), (1, -1)], "doc_id long, toxic int"), limit=60)
    assert model.thresholds and "=vile" in model.weights


def test_more_features_than_room_share_weights():
    assert op._places(["a", "b"], 2) == {"a": 0, "b": 1}
    shared = op._places([f"f{i}" for i in range(50)], 8)
    assert set(shared.values()) <= set(range(8)) and shared == op._places([f"f{i}" for i in range(50)], 8)


def test_fit_against_a_plain_optimiser():
    """The same loss, minimised with numerical gradients and nothing else in common."""
    rng = np.random.default_rng(3)
    n, m = 120, 3
    x = rng.poisson(0.7, (n, m)).astype(float)
    grades = np.clip((x @ np.array([1.0, 0.6, 0.0]) + rng.normal(0, 0.8, n)).round(), 0, 2).astype(int)
    lengths = rng.normal(3, 1, n)
    rows, cols = np.nonzero(x)
    model = op.fit(rows, cols, x[rows, cols], lengths, grades, ["=a", "=b", "=c"])
    scaled = (lengths - lengths.mean()) / lengths.std()

    def loss(p):
        score = x @ p[:m] + p[m] * scaled
        t = np.array([p[m + 1], p[m + 1] + np.exp(p[m + 2])])
        over = 1 / (1 + np.exp(t[None, :] - score[:, None]))  # P(grade >= k)
        edges = np.concatenate([np.ones((n, 1)), over, np.zeros((n, 1))], axis=1)
        return -np.log(edges[np.arange(n), grades] - edges[np.arange(n), grades + 1]).mean() + op.L2 / 2 * (p[:m] ** 2).sum()

    p, step = np.zeros(m + 3), 0.5
    while step > 1e-6:  # coordinate search, weights not below zero
        tries = [np.concatenate([np.maximum(q[:m], 0), q[m:]]) for k in range(m + 3) for q in (p + step * np.eye(m + 3)[k], p - step * np.eye(m + 3)[k])]
        best = min(tries, key=loss)
        if loss(best) < loss(p) - 1e-12:
            p = best
        else:
            step /= 2
    found = np.array([*[model.weights.get(f, 0.0) for f in ("=a", "=b", "=c")], model.length[0], model.thresholds[0], np.log(model.thresholds[1] - model.thresholds[0])])
    assert loss(found) < loss(p) + 1e-3
    assert np.abs(found - p).max() < 0.1
