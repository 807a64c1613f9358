"""Repeats across documents: the index and the operator against brute force."""

import random

import numpy as np
import pytest

from lakevault.llm import run_index as ri
from lakevault.llm.queries import QUERIES


def brute(rows, width):
    """``{row number: (n_bytes, spans, kept)}`` from the definition."""
    texts = [(t or "").encode() for _, t in rows]
    order = [ri.NULL_ID if i is None else i for i, _ in rows]
    first = {}
    for o, t in zip(order, texts):
        for p in range(len(t) - width + 1):
            w = t[p : p + width]
            first[w] = min(first.get(w, o), o)
    out = []
    for (i, _), o, t in zip(rows, order, texts):
        gone = [False] * len(t)
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < o:
                gone[p : p + width] = [True] * width
        spans, at = [], 0
        while at < len(t):
            if gone[at]:
                stop = at
                while stop < len(t) and gone[stop]:
                    stop += 1
                spans.append((at, stop))
                at = stop
            else:
                at += 1
        out.append((i, len(t), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def found(df):
    return [(r.doc_id, r.n_bytes, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], r[2]))


def corpus(seed, n, alphabet="abcd ", passages=6):
    rng = random.Random(seed)
    common = ["".join(rng.choices(alphabet, k=rng.randint(40, 120))) for _ in range(passages)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choice(common) if rng.random() < 0.5 else "".join(rng.choices(alphabet, k=rng.randint(1, 150)))
            cut = rng.randint(0, len(part) // 3)
            parts.append(part[cut:])
        rows.append((i * 3 - 20, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcdefgh"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 60))).encode() for _ in range(25)] + [b"\x00\x00ab\xff"]
    asked = ["".join(rng.choices(alphabet + "z", k=rng.randint(1, 60))).encode() for _ in range(25)] + [b"\xff\x00\x00a", texts[3]]
    statistics, offsets = ri.RunLengthIndex(texts).matching_statistics(asked)
    for text, at in zip(asked, offsets):
        for p in range(len(text)):
            longest = max(k for k in range(len(text) - p + 1) if k == 0 or any(text[p : p + k] in t for t in texts))
            assert statistics[at + p] == longest


def test_runs_are_fewer_than_rows_where_texts_repeat():
    text = "".join(random.Random(1).choices("abcdefgh", k=200)).encode()
    index = ri.RunLengthIndex([text[:150], text[20:], text[40:180]] * 20)
    assert len(index.heads) < index.n / 20


def test_like_windows():
    texts = [b"abcabcabcabcabcabc", b"cabcabcabcab"]
    like, offsets = ri.like_windows(texts, 10)
    known = {}
    for text, at in zip(texts, offsets):
        for p in range(len(text) - 9):
            assert known.setdefault(text[p : p + 10], like[at + p]) == like[at + p]
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rest_bytes", [ri.REST_BYTES, 100])
def test_against_brute_force(spark, seed, rest_bytes):
    rows = corpus(seed, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ri.repeats(df, block_bytes=4000, names_bytes=9000, segments_bytes=9000, rest_bytes=rest_bytes)
    assert ordered(found(got)) == ordered(brute(rows, 50))


def test_other_widths(spark):
    rows = corpus(9, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ri.repeats(df, width=21, anchor=10, block_bytes=3000, names_bytes=5000, segments_bytes=5000)
    assert ordered(found(got)) == ordered(brute(rows, 21))


def test_odd_rows(spark):
    big = 2**60
    long = "abcdefghijklmnopqrstuvwxyz0123456789" * 900
    line = "a line of the licence that every document repeats, word for word; "
    rows = [(big + 1, line + "ä" * 60), (big + 3, "x" + line), (None, line), (None, line), (big + 5, None), (-4, ""), (7, "z" * 5000), (8, "z" * 300),
            (9, long), (10, "#" + long[5:20000]), (big + 3, line), (11, "ä" * 49), (11, "short"), (12, "\0" * 70), (13, "\0" * 55 + "\U0001f600")]
    df = spark.createDataFrame([(t, i, "x", 1, 2) for i, t in rows], "text string, doc_id long, block string, row int, part int")
    got = ri.repeats(df.select("text", "doc_id", "block", "row", "part"), block_bytes=3000)
    assert ordered(found(got)) == ordered(brute(rows, 50))


def test_empty_table(spark):
    assert ri.repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_texts_stay_where_they_are(spark, sf_dir):
    """Only names, segments and answers are shuffled: no exchange above the scan of the texts."""
    got = ri.repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "repeat_blocks" in line]
    assert scans and all("Bucketed: true" in line for line in scans), plan


def test_query(spark, sf_dir):
    import hashlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {i: (n, n - len(k), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in brute([tuple(r) for r in docs], 50)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op11_run_index"](spark, sf_dir).collect()}
    assert got == want and any(v[1] for v in got.values())
    assert np.mean([v[1] == 0 for v in got.values()]) > 0.3
