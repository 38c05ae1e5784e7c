from __future__ import annotations

import itertools

import pytest
from conftest_rows import rows_by

from wattsift.llm.chat import ENDS, LEGAL, START, Automaton, Costs, Template, chain, repair_conversations


def cheapest(roles: list[int]) -> int:
    """The least cost, by trying every label and up to two empty messages before each turn."""
    best = None

    def go(i: int, state: int, cost: int) -> None:
        nonlocal best
        if best is not None and cost >= best:
            return
        if i == len(roles):
            best = cost + (0 if state in (*ENDS, START) else 2) if best is None else min(best, cost + (0 if state in (*ENDS, START) else 2))
            return
        for x in (1, 2, 3):
            named = 0 if x == roles[i] else 3 if roles[i] else 1
            if x in LEGAL[state]:
                go(i + 1, x, cost + named)
            if x == state:
                go(i + 1, x, cost + named + 1)
            for k in (1, 2):
                for path in itertools.product((1, 2, 3), repeat=k):
                    at, legal = state, True
                    for p in path:
                        legal, at = legal and p in LEGAL[at], p
                    if legal and x in LEGAL[at]:
                        go(i + 1, x, cost + named + 2 * k)

    go(0, START, 0)
    return best


def test_stretches_chain_to_the_least_cost(rng):
    automaton = Automaton()
    for _ in range(150):
        roles = [rng.randrange(4) for _ in range(rng.randint(1, 5))]
        size = rng.randint(1, 3)
        parts = [roles[i : i + size] for i in range(0, len(roles), size)]
        states = chain([automaton.matrix(p) for p in parts], automaton)
        cost = sum(m[0] for p, (a, b, _) in zip(parts, states, strict=True) for _, m in automaton.path(p, a, b))
        assert cost + 2 * automaton.closing[states[-1][1]] == cheapest(roles), roles


ROWS = [
    (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "system", "s"), (1, 3, None, "x"), (2, 0, "assistant", "hi"), (None, 0, "system", "only"),
    (None, 1, "User ", None), (3, None, "user", "n"), (3, 5, "bot", "z <|im_end|>"), (4, 0, "user", "r"), (4, 0, "user", "r"), (4, 0, "tool", "t"),
]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, stretch string").repartition(3)


def rendered(rows) -> str:
    return "".join(r.rendered for r in sorted(rows, key=lambda r: (r.turn is not None, r.turn, r.role or "", r.message)))


def messages(text: str) -> list[str]:
    return [m.partition("\n")[0] for m in text.split("<|im_start|>")[1:]]


def test_rendered_conversations_are_legal(turns):
    rows = rows_by(repair_conversations(turns), "conv_id")
    assert sum(map(len, rows.values())) == len(ROWS)
    assert rendered(rows[1]) == "<|im_start|>user\na\nb<|im_end|>\n<|im_start|>assistant\ns<|im_end|>\n<|im_start|>user\nx<|im_end|>\n"
    assert rendered(rows[2]) == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
    assert rendered(rows[3]).count("<|im_end|>") == 2
    assert sorted(r.rendered for r in rows[None]) == ["<|im_start|>system\nonly<|im_end|>\n<|im_start|>user\n<|im_end|>\n", "<|im_start|>user\n<|im_end|>\n"]
    for key in (1, 2, 3, 4):
        state = START
        for role in messages(rendered(rows[key])):
            assert role in ("system", "user", "assistant")
            name = ("", "system", "user", "assistant").index(role)
            assert name in LEGAL[state]
            state = name
        assert state in ENDS


@pytest.mark.parametrize("stretch", [1, 2, 3])
def test_stretches_do_not_change_the_result(spark, rng, stretch):
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd"]), f"{c}.{t}") for c in range(25) for t in range(rng.randint(1, 9))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole, cut = (sorted(map(str, repair_conversations(frame, stretch=s).collect())) for s in (512, stretch))
    costs = [sum(r.cost for r in rows_by(repair_conversations(frame, stretch=s), "conv_id")[c]) for s in (512, stretch) for c in range(25)]
    assert len(whole) == len(cut) == len(rows) and costs[:25] == costs[25:]


def test_legal_conversations_stay(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = repair_conversations(frame).collect()
    assert len(rows) == frame.count()
    assert all(r.action == "keep" and r.cost == 0 and r.inserted == 0 and r.message == r.turn for r in rows)


def test_no_turns_and_other_settings(spark, turns):
    assert repair_conversations(turns.where("false")).count() == 0
    dear = rows_by(repair_conversations(turns, Costs(merge=50, insert=60, relabel=1), Template("[{role}]", "", " ", ("[",))), "conv_id")
    assert {r.action for r in dear[1]} == {"keep", "relabel"} and not any("<|" in r.rendered for r in dear[2])
