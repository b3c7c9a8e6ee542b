"""Role repair against enumeration of all repairs, block sizes, legality, and odd inputs."""

import itertools
import random
import re

import pytest

from spotweave.llm import role_repair as m


def brute_cost(roles):
    """Least cost over all label sequences, with the cheapest way to make each legal."""
    best = None
    for labels in itertools.product(m.ROLES, repeat=len(roles)):
        cost, last = sum(2 for a, b in zip(roles, labels) if a != b), None
        for x in labels:
            if x == last:
                cost += 1
            elif x == "system" and last is not None:
                cost = None
                break
            elif x == "assistant" and last in (None, "system"):
                cost += 3
            last = x
        if cost is None or last == "system":
            continue
        cost += 3 * (last == "user")
        best = cost if best is None else min(best, cost)
    return best


def legal(chat):
    return re.fullmatch(r"(<\|system\|>\n.*?<\|end\|>\n)?(<\|user\|>\n.*?<\|end\|>\n<\|assistant\|>\n.*?<\|end\|>\n)+", chat, re.S) and \
        re.findall(r"<\|(system|user|assistant)\|>", chat)


@pytest.mark.parametrize("block", (1024, 3))
def test_least_cost_and_legal_chats(spark, block):
    rng = random.Random(7)
    convs = [[rng.choice(["system", "user", "assistant", "tool", None]) for _ in range(rng.randrange(1, 8))] for _ in range(60)]
    rows = [(c, t, r, f"text {c} {t}") for c, roles in enumerate(convs) for t, r in enumerate(roles)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    fixed = m.repair(df, block).collect()
    by = {}
    for r in sorted(fixed, key=lambda r: r["idx"]):
        by.setdefault(r["conv_id"], []).append(r)
    for c, roles in enumerate(convs):
        assert sum(r["cost"] for r in by[c]) == brute_cost(roles), roles
        chat = "".join(r["rendered"] for r in by[c])
        marks = legal(chat)
        assert marks, chat
        body = marks[1:] if marks[0] == "system" else marks
        assert body == ["user", "assistant"] * (len(body) // 2)
        assert [f"text {c} {t}" in chat for t in range(len(roles))] == [True] * len(roles)


def test_legal_conversations_cost_nothing_and_totals_do_not_depend_on_blocks(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    a = sorted(map(tuple, m.summary(m.repair(df)).select("conv_id", "n_turns", "cost").collect()))
    b = sorted(map(tuple, m.summary(m.repair(df, 2)).select("conv_id", "n_turns", "cost").collect()))
    assert a == b and any(x[2] == 0 for x in a) and any(x[2] > 0 for x in a)


def test_one_very_long_conversation(spark):
    df = spark.range(5000).selectExpr("1L as conv_id", "id as turn", "if(id % 5 = 0, 'assistant', 'user') as role", "'x' as text")
    want = m.summary(m.repair(df, 7)).collect()[0]
    assert (want["n_turns"], want["cost"]) == (5000, m.summary(m.repair(df)).collect()[0]["cost"])


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (2, None, "assistant", None), (2, 0, "user", ""), (3, 0, "user", "q"), (3, 0, "user", "q"), (0, 0, None, "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as cost", "2 as TEXT", "3 as idx")
    got = {r["conv_id"]: (r["n_turns"], r["cost"], r["n_merges"], r["n_relabels"], r["n_inserts"], r["n_messages"])
           for r in m.summary(m.repair(df)).collect()}
    assert got == {None: (1, 3, 0, 0, 1, 2), 2: (2, 0, 0, 0, 0, 2), 3: (2, 2, 0, 1, 0, 2), 0: (1, 5, 0, 1, 1, 2)}
    assert m.summary(m.repair(df.limit(0))).collect() == []
