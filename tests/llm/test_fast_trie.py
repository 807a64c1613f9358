"""The trie of conversations against a plain dictionary of prefixes."""

import hashlib
import random
from collections import defaultdict

import pytest

from lakevault.llm import fast_trie as ft
from lakevault.llm.common import stored
from lakevault.llm.queries import QUERIES, rebuilt

TURNS = "conv_id long, turn long, role string, text string"


def brute(convs):
    """``{(conv_id, depth): the other columns}`` for ``{conv_id: [(role, text)]}``."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        parent = members[node[:-1]][0] if node else None
        out[members[node][0], len(node)] = (parent, len(members[node]), len(kids[node]), leaves[node], saved[node], digest)
    return out


def found(df):
    rows = [((r.conv_id, r.depth), (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def spread(convs, rng):
    rows = [(c, t, role, text) for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def test_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)] + [(1, 2**30), (2**20, 2**20 + 5)]
    for a, b in pairs:
        if b < 50:
            assert ft.fattest(a, b) == max(range(a + 1, b + 1), key=lambda x: x & -x)
    rows = spark.createDataFrame(pairs, "a int, b int").select("a", "b", ft._fattest("a", "b").alias("f")).collect()
    assert all(r.f == ft.fattest(r.a, r.b) for r in rows)


@pytest.mark.parametrize("seed,first,growth", [(0, 4096, 16), (1, 4, 4), (2, 30, 16)])
def test_against_brute_force(spark, seed, first, growth):
    """Small first batches and slow growth split edges again and again."""
    rng = random.Random(seed)
    convs = {}
    for c in range(-5, 150):
        if convs and rng.random() < 0.6:
            turns = list(rng.choice(list(convs.values())))
            turns = turns[: rng.randint(0, len(turns))]
        else:
            turns = []
        turns += [(rng.choice("ab"), rng.choice(["", "x", "yy", "ä"])) for _ in range(rng.randint(0, 30 if rng.random() < 0.1 else 4))]
        convs[c * 7] = turns
    df = spark.createDataFrame(spread(convs, rng), TURNS).repartition(4)
    ids = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    assert found(ft.trie(df, ids, first, growth)) == brute(convs)


def test_long_chain_and_common_first_turn(spark):
    rng = random.Random(4)
    long = [("u", f"turn {i}") for i in range(700)]
    convs = {2**60 + 1: long, 2**60 + 3: long[:650] + [("u", "other")], 5: long, 6: long[:1], -8: [("x", "y" * 20_000)]}
    convs |= {100 + i: [long[0], ("u", f"own {i}")] for i in range(300)}
    convs |= {1000 + i: [long[0], ("u", "same")] for i in range(300)}
    assert found(ft.trie(spark.createDataFrame(spread(convs, rng), TURNS), None, 60, 16)) == brute(convs)


def test_probes_find_the_exit(spark):
    """``locate`` meets every path at the deepest node it begins with."""
    rng = random.Random(5)
    convs = {c: [("r", rng.choice("ab")) for _ in range(rng.randint(1, 40))] for c in range(120)}
    paths = ft.paths(spark.createDataFrame(spread(convs, rng), TURNS)).withColumn("end", ft._name_at(ft.F.size("names")))
    paths = stored(paths, "test-paths").dropDuplicates(["end"])
    half = paths.filter("conv_id % 2 = 0").select("end", "names", "chars")
    nodes = ft.build(half, 10, 16)
    ends = {r.node: r.length for r in nodes.collect()}
    for row in ft.locate(paths.select("end", "names", "chars"), nodes).collect():
        assert row.exit == max([0] + [d for d, n in enumerate(row.names, 1) if ends.get(bytes(n)) == d])


def test_odd_rows(spark):
    rows = [(1, None, "u", "first"), (1, 0, None, None), (1, 0, "", ""), (2, None, "u", "first"), (2, 5, "", ""), (2, 9, None, ""), (None, 0, "u", "lost"),
            (3, 1, "b", "z"), (3, 1, "a", "z"), (4, 7, "a", "z"), (4, 8, "b", "z"), (4, 8, "b", "z")]
    convs = {1: [("u", "first"), ("", ""), ("", "")], 2: [("u", "first"), ("", ""), ("", "")], 3: [("a", "z"), ("b", "z")], 4: [("a", "z"), ("b", "z"), ("b", "z")]}
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", depth long, names string")
    assert found(ft.trie(df)) == brute(convs)
    assert ft.trie(df.limit(0)).collect() == []


def test_names_tell_role_from_text(spark):
    df = spark.createDataFrame([(1, 0, "ab", "c"), (2, 0, "a", "bc")], TURNS)
    assert found(ft.trie(df)) == brute({1: [("ab", "c")], 2: [("a", "bc")]})


def test_rebuilt(spark):
    rng = random.Random(6)
    convs = {c: [("u", f"{c} {t}") for t in range(rng.randint(1, 7))] for c in [*range(0, 130), 230, -7, -100]}
    import zlib

    want = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        want[c] = convs.get(base, [])[:h] + turns[h:]
    turns, ids = rebuilt(spark.createDataFrame(spread(convs, rng), TURNS))
    assert found(ft.trie(turns, ids)) == brute(want)


def test_query_runs(spark, sf_dir):
    rows = QUERIES["op12_fast_trie"](spark, sf_dir).collect()
    root = [r for r in rows if r.depth == 0]
    assert len(root) == 1 and root[0].parent_conv_id is None and root[0].n_convs == spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
