"""Runs of words against brute force."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from lakevault.llm import periodic_runs as pr
from lakevault.llm.queries import QUERIES


def brute(words, least=12):
    """Every maximal stretch of each period, kept if no smaller period holds."""
    numbers: dict = {}
    a, out = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), []
    n = len(words)
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], a[q:] == a[:-q], [False]]).astype(np.int8)
        edge = np.flatnonzero(np.diff(same))
        for s, stop in zip(edge[::2].tolist(), edge[1::2].tolist()):
            length = stop - s + q
            if length >= max(least, 2 * q) and not any((a[s + p : s + length] == a[s : s + length - p]).all() for p in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, k, n):
    words = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // (3 + rng.randrange(8))
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return [b"w%d" % w for w in words]


@pytest.mark.parametrize("k", [1, 2, 3, 6, 400])
def test_runs_against_brute_force(k):
    rng = random.Random(k)
    texts = [periodic(rng, k, rng.randint(0, 70)) for _ in range(150)]
    assert pr.runs_of(texts) == [brute(t) for t in texts]
    assert pr.runs_of(texts, 2) == [brute(t, 2) for t in texts]


@pytest.mark.parametrize("k", [1, 2, 4])
def test_all_squares_are_found_once(k):
    rng = random.Random(k + 10)
    for _ in range(120):
        words = periodic(rng, k, rng.randint(0, 50))
        found = [(s, e - s, q) for s, e, q in pr.squares(words)]
        assert len(found) == len(set(found)) and sorted(found) == sorted(brute(words, 1))


def test_deep_trees_stay_cheap():
    """One word over and over, and a Fibonacci word: paths of n states, yet about n log n work."""
    a, b = [1], [1, 2]
    while len(b) < 40_000:
        a, b = b, b + a
    began = time.process_time()
    assert pr.squares([7] * 40_000) == [(0, 40_000, 1)]
    assert len(pr.squares(b)) < len(b)
    assert time.process_time() - began < 60


def rows_of(df):
    return [(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in df.collect()]


def test_rows(spark):
    line = "one two three four five six seven "
    rows = [(2**60 + 1, line * 3), (2**60 + 1, line * 3), (None, "a " * 30), (None, None), (3, ""), (4, " \t\x0b\x0c\r\n "), (5, "a b " * 12),
            (-6, "x y " * 5), (7, "x y " * 6), (8, " ".join("ab") + " q"), (9, "ä ö " * 4000 + "end")]
    df = spark.createDataFrame([(t, i, 1, "x") for i, t in rows], "text string, doc_id long, runs int, collapsed string")
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        runs = brute(words) if len(words) < 100 else [(0, 8000, 2)]
        gone = {x for s, n, q in runs for x in range(s + q, s + n)}
        want.append((i, len(words), runs, b" ".join(w for x, w in enumerate(words) if x not in gone).decode()))
    assert sorted(map(repr, rows_of(pr.periodic_runs(df)))) == sorted(map(repr, want))
    assert pr.periodic_runs(spark.createDataFrame([], df.schema)).collect() == []


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue  # too long for brute force
        runs, r = brute(words), got[doc_id]
        some += bool(runs)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        gone = {x for s, n, q in runs for x in range(s + q, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for x, w in enumerate(words) if x not in gone)).hexdigest()
    assert some > 10
