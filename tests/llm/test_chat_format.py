import hashlib
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from sparkloom.llm import chat_format as op
from sparkloom.llm._util import table


@given(st.lists(st.tuples(st.text("\\#:</turn> \nab", max_size=25), st.text("\\#:</turn> \nab", max_size=40)), max_size=5))
def test_template_is_reversible(turns):
    formatted = "".join(op.render(*t)[0] for t in turns)
    assert op.parse(formatted) == turns
    for role, text in turns:
        line, a, b = op.render(role, text)
        assert op.unescape(line[a:b]) == text and "###" not in line[a:b] and "</turn>" not in line[a:b]


@given(st.lists(st.integers(1, 50), min_size=1, max_size=40), st.integers(0, 30), st.integers(10, 120), st.integers(0, 60))
def test_plan(tokens, fixed, budget, history):
    windows = op.plan_windows(np.array(tokens), fixed, 0, budget, history)
    assert [i for _, b, e in windows for i in range(b, e)] == list(range(len(tokens)))
    for old, begin, end in windows:
        assert old <= begin < end and sum(tokens[old:begin]) <= history
        size = fixed + sum(tokens[old:end])
        assert size <= budget or (end == begin + 1 and old == begin)
        if end < len(tokens):
            assert size + tokens[end] > budget


def brute(rows):
    out = {}
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("sizes", [{}, {"budget": 30, "history": 8, "block_turns": 32}, {"budget": 5, "history": 0}])
def test_round_trip(spark, sizes):
    rng = random.Random(4)
    piece = lambda: rng.choice(["ab", "\\", "###", "</turn>", "\n", "é:", " ", "### user: x </turn>\n"])
    rows = []
    for conv in range(30):
        n = rng.choice([1, 2, 7, 90])
        for t in range(n):
            role = rng.choice(["user", "assistant", None, "tool:\\x", "system"]) if t or conv % 2 else "system"
            rows.append((conv if conv else None, t if conv % 5 or t else None, role, rng.choice([None, "", "".join(piece() for _ in range(rng.randrange(20)))])))
    rows += [rows[3], rows[40], (50, 0, "assistant", "x" * 100_000), (51, 0, "system", "only")]
    frame = spark.createDataFrame([(*r, 9, "z") for r in rows], "conv_id long, turn long, role string, text string, block int, loss string")
    windows = op.format_chats(frame, **sizes)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op.read_back(windows).collect()}
    assert got == brute(rows)
    budget = sizes.get("budget", op.BUDGET)
    for w in windows.collect():
        assert w.n_tokens == op.count_tokens(w.text)
        alone = w.n_turns - w.n_repeated - (w.n_repeated == 0 and w.text.startswith("### system:"))
        assert w.n_tokens <= budget or alone <= 1  # only a turn that no window can hold goes over
    assert op.format_chats(frame.limit(0)).count() == 0


def test_query(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    tricky = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op.op3_chat_windows(spark, sf).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("turn", [lambda t: t, lambda t: None, lambda t: 7, lambda t: 1000 * t])
def test_history_goes_by_tokens_across_blocks(spark, turn):
    """Whatever the turn numbers: a window repeats as many turns as the history has tokens for, at a block's begin as anywhere."""
    rng = random.Random(6)
    rows = [("c", turn(t) if t else (None if turn(1) is None else 0), "system" if t == 0 else rng.choice(["assistant", "user"]), "" if t == 0 else "ab " * rng.randrange(9) + f"{t:05d}") for t in range(900)]
    rows += [("c", turn(9), "user", "alike")] * 90 + [(None, turn(t), "user", f"n{t}") for t in range(400)] + [("short", 1, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(4)
    windows = op.format_chats(frame, budget=160, history=70, block_turns=100)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op.read_back(windows).collect()}
    assert got == brute(rows)
    of = {}
    for w in windows.collect():
        of.setdefault(w.conv_id, []).append(w)
    assert len({w.block for w in of["c"]}) == 10 and len({w.block for w in of[None]}) == 4
    for held in of.values():
        held.sort(key=lambda w: (w.block, w.window))
        sizes, seen, system = [], 0, held[0].text.startswith("### system")
        for w in held:
            lines = [op.count_tokens(op.render(*t)[0]) for t in op.parse(w.text)]
            if sizes or not system:
                lines = lines[system:]
            repeated = w.n_repeated - (system and bool(sizes))
            old = sizes[len(sizes) - repeated :] if repeated else []
            assert lines[:repeated] == old and sum(old) <= 70
            if len(sizes) > repeated + system:
                more = sum(old) + sizes[len(sizes) - repeated - 1]
                fixed = sizes[0] if system else 0
                assert more > 70 or fixed + more + lines[repeated] > 160
            sizes += lines[repeated:]
            seen += 1
        assert len(sizes) == sum(r[0] == w.conv_id for r in rows)
