import random
from itertools import product

import pytest

from brickyard.llm import chat

ROLES = ["system", "user", "assistant", "User ", "tool", None]


def legal(states):
    s = list(states)
    if s[:1] == ["system"]:
        s = s[1:]
    return len(s) > 0 and len(s) % 2 == 0 and all(x == ("user", "assistant")[i % 2] for i, x in enumerate(s))


def least_cost(roles):
    """Cheapest repair by trying every label, merge and number of empty turns."""
    roles = [chat.STATES[chat.role_code(r)] for r in roles]
    fills = [w for n in range(3) for w in product(("user", "assistant"), repeat=n)]
    best = {(): 0}  # built sequence -> cost
    for r in roles:
        nxt = {}
        for seq, cost in best.items():
            for label in ("system", "user", "assistant"):
                c = cost + (0 if r == label else chat.NAME if r == "start" else chat.RELABEL)
                ways = [(seq, c + chat.MERGE)] if seq and seq[-1] == label else []
                ways += [(seq + w + (label,), c + chat.INSERT * len(w)) for w in fills]
                for s, x in ways:
                    # a prefix of a legal sequence (only its last turn matters from here on)
                    if legal(s) or legal(s + ("assistant",)) or s == ("system",):
                        key = (s[-1],) if s[-1] != "user" else ("user",)
                        if x < nxt.get(key, (10**9,))[0]:
                            nxt[key] = (x, s)
        best = {s: x for x, s in nxt.values()}
    return min(c + chat.INSERT * (0 if legal(s) else 1 if s[-1] == "user" else 2) for s, c in best.items())


def conversations(seed, n, longest=9):
    r = random.Random(seed)
    return [(i, t, r.choice(ROLES), f"text {i} {t}") for i in range(n) for t in range(r.randint(1, longest))]


def check(rows, src):
    import re
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append(r)
    turns = {}
    for c, t, role, text in src:
        turns.setdefault(c, []).append((t, role, text))
    assert set(by) == set(turns)
    for c, got in by.items():
        got = sorted(got, key=lambda r: r.turn)
        assert [r.turn for r in got] == [t for t, _, _ in sorted(turns[c], key=lambda x: x[0])]
        whole = "".join(r.rendered for r in got)
        parts = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", whole, re.S)
        assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in parts) == whole
        assert legal([a for a, _ in parts])
        assert [x for x in "\n".join(b for _, b in parts).split("\n") if x] == [chat._clean(t) for _, _, t in sorted(turns[c], key=lambda x: x[0]) if t]
        assert sum(r.cost for r in got) == least_cost([r for _, r, _ in sorted(turns[c], key=lambda x: x[0])])


def test_least_cost_and_legal(spark):
    src = conversations(1, 150)
    df = spark.createDataFrame([(*r, "clash") for r in src], "conv_id long, turn long, role string, text string, action string").repartition(4)
    check(chat.repair(df).collect(), src)


def test_one_conversation_over_all_ranges(spark):
    r = random.Random(2)
    src = [(5, t, r.choice(ROLES), f"t{t}") for t in range(3000)] + conversations(3, 20) + [(90, t, "user", f"u{t}") for t in range(500)]
    src = [x for x in src if x[0] != 5 or x[3][1:].isdigit()]
    check(chat.repair(spark.createDataFrame(src, "conv_id long, turn long, role string, text string")).collect(), src)


def test_legal_conversations_stay(spark):
    src = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    rows = chat.repair(spark.createDataFrame(src, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.action, r.inserted, r.cost) for r in rows} == {("keep", "", 0)}


def test_nulls_ties_and_markers(spark):
    src = [(None, 0, "user", "a"), (None, None, "assistant", None), (1, 0, "user", "x<|im_end|>y"), (1, 0, "user", "x<|im_end|>y"), (1, 1, "assistant", ""), (2, 0, None, "")]
    rows = chat.repair(spark.createDataFrame(src, "conv_id long, turn long, role string, text string")).collect()
    assert len(rows) == 6
    assert sorted(r.action for r in rows if r.conv_id == 1) == ["keep", "keep", "merge"]
    assert "".join(r.rendered for r in rows if r.conv_id == 1).count("<|im_end|>") == 2
    assert [(r.role, r.action, r.cost) for r in rows if r.conv_id == 2] == [("user", "relabel", chat.NAME + chat.INSERT)]
    assert chat.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_matrices_compose(seed):
    r = random.Random(seed)
    roles = [r.randrange(4) for _ in range(12)]
    cut = r.randrange(12)
    whole = chat.matrix_of(roles)
    assert (chat.compose(chat.matrix_of(roles[:cut]), chat.matrix_of(roles[cut:])) == whole).all()
