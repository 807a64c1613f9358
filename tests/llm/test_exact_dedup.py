"""Exact dedup: the hash itself, and whole results against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from lakevault.llm import exact_dedup as op

SCHEMA = "doc_id long, text string, digest string, kept int"


def _brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append(doc_id)
    out = []
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        free = True
        for i in ids:
            kept = i == keep and free
            free = free and not kept
            out.append((i, keep, len(ids), kept, digest))
    return sorted(out, key=repr)


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 256, (5000, 32)).astype(np.uint8)
    sizes, bitmap, slot = op.build_shard(keys)
    assert sorted(slot) == list(range(5000))
    assert (op.probe_shard(sizes, bitmap, keys) == slot).all()
    strange = rng.integers(0, 256, (5000, 32)).astype(np.uint8)
    found = op.probe_shard(sizes, bitmap, strange)
    table = np.empty_like(keys)
    table[slot] = keys
    assert not ((found >= 0) & (table[np.maximum(found, 0)] == strange).all(axis=1)).any()


def test_perfect_hash_refuses_equal_keys():
    with pytest.raises(ValueError):
        op.build_shard(np.zeros((2, 32), np.uint8))


def test_rows_against_brute_force(spark):
    rows = [(i, ["a b", "a  b", "a\t\nb", "c", None, "", " ", "x" * 200_000][i % 8], "clash", 1) for i in range(60)]
    rows += [(3, "c", "clash", 1), (None, "c", None, None), (None, "only null", None, None), (None, "only null", None, None), (5, "other text", "z", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = op.dedup_documents(docs).collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got), key=repr)
    assert got == _brute(rows)


def test_kept_rows_keep_their_columns(spark):
    rows = [(1, "a", "d1", 1), (2, "a", "d2", 2), (1, "a", "d1", 1), (1, "b", "d3", 3), (None, "n", "d4", 4), (7, None, "d5", 5)]
    out = op.keep_first(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "digest", "kept"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "a", "d1", 1), (1, "b", "d3", 3), (None, "n", "d4", 4), (7, None, "d5", 5)], key=repr)


def test_empty_tables_and_empty_history(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert op.dedup_documents(docs).collect() == []
    assert op.keep_first(docs).collect() == []
    new = op.digests(spark.createDataFrame([(4, "a", "", 0), (2, "a", "", 0)], SCHEMA))
    got = op.dedup_rows(op.digests(docs), new).select("doc_id", "keep_id", "kept").collect()
    assert sorted(map(tuple, got)) == [(2, 2, True), (4, 2, False)]


def test_history_wins_over_smaller_new_id(spark):
    old = op.digests(spark.createDataFrame([(9, "a", "", 0)], SCHEMA))
    new = op.digests(spark.createDataFrame([(1, "a", "", 0), (2, "b", "", 0)], SCHEMA))
    got = op.dedup_rows(old, new).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got)) == [(1, 9, 2, False), (2, 2, 1, True), (9, 9, 2, True)]
