"""Secret scan: base forms against the plain patterns, ownership against brute force."""

import hashlib
import random
import re
from collections import defaultdict

from lakevault.llm import secrets as op

SCHEMA = "doc_id long, text string, source string, row string, finds int"
PLAIN = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def _base(text):
    found = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(PLAIN) for m in p.finditer(text or "") if ok(m)]
    return sorted(found)


def test_known_forms_equal_the_plain_patterns():
    rng = random.Random(3)
    bits = ["password", "Token", "secret", "API_KEY", "apikey", "=", ":", " ", '"', "'", "abcdef01", "0" * 16, "f" * 20, "AKIA", "ABCD1234", "Z9", "é", "K", "ſ", "-", ".", "\n", "g", "toKen = "]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert [x[:3] for x in op.known_finds(text)] == _base(text), text


def _docs():
    key, wide, word = "Zk93jQx81LmP02vTq7Ws", "EXAMPLEa1b2c3d4e5f6g7h8", "a" * 19 + "1" * 2 + "bb"
    rows = [(1, f"my {key} here password=hunter2hunter2", "a", "x", 1), (2, f"{wide} and {key}", "a", "x", 1), (3, f"{wide} token: {'ab12' * 10}", "b", None, None)]
    rows += [(4, None, "b", "x", 1), (5, "", None, "x", 1), (6, word, "c", "x", 1), (7, "é" * 100_000 + " AKIA" + "Q1" * 8, "c", "x", 1), (7, f"x {wide}", "c", "x", 1), (None, f"x {wide}", None, "x", 1)]
    return rows + [(8, f"same {key[::-1]}", "d", "x", 1)] * 3


def test_spans_against_brute_force(spark):
    rows = _docs()
    owners = defaultdict(set)
    per = []
    for doc_id, text, owner, *_ in rows:
        known = op.known_finds(text or "")
        finds = known + op.candidate_finds(text or "", known)
        per.append((doc_id, text or "", finds))
        for *_, value in finds:
            owners[value].add(owner)
    want = []
    for doc_id, text, finds in per:
        base = ",".join(f"{PLAIN[k][0]}:{s}:{e}" for s, k, e in _base(text))
        kept = sorted(f for f in finds if f[1] < 3 or len(owners[f[3]]) < 2 and op.bits_per_character(f[3]) >= 3)
        want.append((doc_id, hashlib.sha256(base.encode()).hexdigest(), op.joined(kept)))
    got = [(r.doc_id, r.base_sha256, r.spans) for r in op.scan_table(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    by_id = {r[0]: r[2] for r in want}
    assert "candidate" in by_id[1] and by_id[2].count("candidate") == 1 and by_id[6] == "" and by_id[7] == ""


def test_empty_table(spark):
    assert op.scan_table(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repositories_and_copies_decide(spark):
    token, key, shared = "Qx71mZp04KtY83bvNc5R", "Hd52sLw96EjU30gaXi8T", "Vb17nMq45RzC62yoPk9F"
    rows = [(i, f"page {i} shows {token} as a sample", "a", "x", 1) for i in range(12)]
    rows += [(20, f"our own {key} in use", "a", "x", 1), (21, f"our own {key}\n in use", "b", "x", 1), (22, f"again {key}", "b", "x", 1)]
    rows += [(30, f"one {shared}", "a", "x", 1), (31, f"two {shared}", "b", "x", 1)]
    got = {r.doc_id: r for r in op.scan_table(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].spans == "" and got[i].n_live == 0 for i in range(12))
    assert all(got[i].spans.startswith("candidate:") and got[i].n_live == 1 and (got[i].repositories, got[i].owners) == ("2", "2") for i in (20, 21, 22))
    assert got[30].spans == got[31].spans == ""
