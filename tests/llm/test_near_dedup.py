"""Near dedup: unbiased samples, components, and classes against all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from lakevault.llm import near_dedup as op
from lakevault.llm.components import components

SCHEMA = "doc_id long, text string, row string, digest int, n int"


def _bag(text):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return Counter()
    words = words + [""] * (5 - len(words))
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def _jaccard(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common) if a or b else 1.0


def _roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def _brute(rows):
    bags = [_bag(r[1]) for r in rows]
    where = defaultdict(list)
    for i, bag in enumerate(bags):
        for s in bag or [()]:
            where[s].append(i)
    pairs = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    roots = _roots(len(rows), [p for p in pairs if _jaccard(bags[p[0]], bags[p[1]]) >= 0.8])
    members = defaultdict(list)
    for i, r in enumerate(roots):
        members[r].append(rows[i][0])
    out = []
    for i, r in enumerate(roots):
        known = [x for x in members[r] if x is not None]
        out.append((rows[i][0], min(known) if known else None, len(members[r])))
    return out


def _corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(40, 300))] for _ in range(60)]
    rows, i = [], 0
    for words in base:
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = "edited"
            rows.append((i, " ".join(copy), "x", 1, 2))
            i += 1
    hot = [rng.choice(vocabulary) for _ in range(400)]
    for k in range(150):
        copy = list(hot)
        copy[k] = f"only{k}"
        rows.append((i, " ".join(copy), "x", 1, 2))
        i += 1
    rows += [(i, None, "x", 1, 2), (i + 1, "", "x", 1, 2), (i + 2, " -- ", "x", 1, 2), (i + 3, "two words", "x", 1, 2), (i + 4, "Two, words!", None, None, None), (None, "two words", "x", 1, 2), (i + 5, "two other", "x", 1, 2), (5, rows[5][1], "x", 1, 2), (i + 6, "long " * 60_000, "x", 1, 2)]
    return rows


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    for n, common in ((300, 270), (5, 3), (1, 1)):
        estimates, truths = [], []
        for _ in range(30):
            a = {int(x): int(rng.choice([1, 1, 2, 5])) for x in rng.integers(0, 2**63, n)}
            b = dict([*a.items()][:common]) | {int(x): 1 for x in rng.integers(0, 2**63, n - common)}
            b[next(iter(b))] += 2
            owner = np.repeat([0, 1], [len(a), len(b)])
            element = np.array([*a, *b], np.uint64)
            s = op.dart_signatures(owner, element, np.array([*a.values(), *b.values()], float), 2, 126)
            estimates.append((s[0] == s[1]).mean())
            truths.append(_jaccard(Counter(a), Counter(b)))
        assert abs(np.mean(estimates) - np.mean(truths)) < 0.03


def test_signature_does_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    element, weight = rng.integers(0, 2**63, 60).astype(np.uint64), rng.integers(1, 4, 60).astype(float)
    owner = np.repeat([0, 1, 2], [1, 9, 50])
    together = op.dart_signatures(owner, element, weight, 3, 126)
    for i in range(3):
        own = owner == i
        assert (op.dart_signatures(np.zeros(own.sum(), int), element[own], weight[own], 1, 126)[0] == together[i]).all()


def test_components_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(300 + i, 301 + i) for i in range(60)] + [(400, 400 + i) for i in range(1, 80)]
    roots = _roots(500, links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {v: roots[v] for v in {x for link in links if link[0] != link[1] for x in link}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_classes_against_all_pairs(spark):
    rows = _corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = op.classes(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=repr) == sorted(_brute(rows), key=repr)
    out = op.keep_one(docs)
    assert out.columns == ["doc_id", "text", "row", "digest", "n"]
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted({x[1] for x in _brute(rows)}, key=repr)


def test_members_outside_the_main_component_are_compared():
    """A chain in which the leader is far from a pair of near nodes still links that pair (see node_links)."""
    a = _bag(" ".join(f"w{i}" for i in range(100)))
    b = _bag(" ".join(f"w{i}" for i in range(10, 110)))
    c = _bag(" ".join(f"w{i}" for i in range(20, 120)))
    assert _jaccard(a, b) >= 0.8 and _jaccard(b, c) >= 0.8 > _jaccard(a, c)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert op.classes(docs).collect() == [] and op.keep_one(docs).collect() == []


def test_large_weights_are_sampled_by_their_weighted_jaccard():
    weights = np.array([100_000.0, 81_000.0])
    signed = op.dart_signatures(np.arange(2), np.full(2, 77, np.uint64), weights, 2, 2000)
    assert abs((signed[0] == signed[1]).mean() - 0.81) < 0.04
