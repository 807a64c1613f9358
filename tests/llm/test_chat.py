"""Chat windows: escaping, budgets, and everything read back against brute force."""

import hashlib
import random

from lakevault.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window string, block int"


def _brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] if r[1] is not None else -(2**63), r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        target = "".join(t for _, role, t in own if role == "assistant")
        out[conv] = (len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest(), len(target), hashlib.sha256(target.encode()).hexdigest())
    return out


def _rows():
    rng = random.Random(5)
    odd = ["</turn>", '<turn role="assistant">', "\\", "\\l", "\n", "é\U0001f600", '"', "a <b> ", "\\q", "### ", "<turn"]
    rows = []
    for conv in [*range(12), None]:
        for turn in range(rng.randint(1, 60)):
            text = "".join(rng.choice(odd + ["word "] * 20) for _ in range(rng.choice([0, 3, 80, 400])))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", 'od"d\n', None]), rng.choice([text, text, text, None]), "x", 1))
    rows += [(3, 5, "assistant", "tie", "x", 1)] * 3 + [(4, None, "user", "first", None, None), (5, -4000, "system", "before", None, None), (6, 9, "assistant", "long " * 30_000, "x", 1)]
    return rows


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["\\", "l", "q", "<", "/", "turn", ">", '"', "</turn>"]) for _ in range(12))
        assert chat.unescape(chat.escape(text)) == text
        assert chat.unescape(chat.escape_role(text)) == text
        assert "<turn" not in chat.escape(text) and "</turn" not in chat.escape(text) and '"' not in chat.escape_role(text)


def test_read_back_against_brute_force(spark):
    rows = _rows()
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA), per_block=16).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
    assert got == _brute(rows)
    for w in windows.collect():
        assert w.n_tokens <= chat.BUDGET or len(chat._TURN.findall(w.text)) - w.repeated == 1


def test_system_turn_and_history_come_along():
    rows = [("c", 0, chat.OWN, 0, "system", "be kind")] + [("c", 0, chat.OWN, i, "user" if i % 2 else "assistant", f"t{i} " + "w " * 30) for i in range(1, 12)]
    out = list(chat.window_rows(iter(rows), lambda text: len(text.split()), budget=140, history_tokens=70))
    assert len(out) > 2
    for _, _, number, repeated, n_tokens, text, starts, _ in out:
        assert n_tokens <= 140 and text.startswith('<turn role="system">be kind')
        if number:
            assert repeated == 3
    targets = [text[a : a + 3].strip() for *_, text, starts, _ in out for a in starts]
    assert targets == ["t2", "t4", "t6", "t8", "t10"]


def test_history_reaches_back_over_blocks_and_gaps(spark):
    """Wherever turns are cut into blocks and however they are numbered, a window repeats the system turn and
    all the last turns that fit."""
    turns = [("system" if i == 1 else "assistant" if i % 2 else "user", f"turn {i}") for i in range(40)]
    for step, per_block in ((1, 8), (5000, 8), (5000, 1), (700, 1024)):
        rows = [(7, step * i, role, text) for i, (role, text) in enumerate(turns)] + [(8, None, "user", "null first"), (8, 1, "user", "then")]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
        windows = sorted(chat.format_windows(df, budget=90, history_tokens=60, per_block=per_block).filter("conv_id = 7").collect(), key=lambda w: (w.block, w.window))
        seen: list = []
        for w in windows:
            found = chat._TURN.findall(w.text)
            context, own = found[: w.repeated], found[w.repeated :]
            if len(seen) > 1:
                assert context[0] == turns[1]
                others = [t for t in seen if t != turns[1]]
                kept = context[1:]
                assert kept == others[len(others) - len(kept) :] and len(kept) >= min(3, len(others))
            seen += own
        assert seen == turns
        if per_block == 1:
            assert len(windows) == 40


def test_empty_table(spark):
    assert chat.read_back(chat.format_windows(spark.createDataFrame([], SCHEMA))).collect() == []
