"""Conversation repair against brute force over all edits, in pieces and whole, and against SQL."""

import functools
import hashlib
import random

import pytest

from tests.compare import connect, differences
from tidegrid.llm import dialogues
from tidegrid.llm.dialogues import Node, States, before, damaged, repair, repairs

COST = {"K": 0, "R": 2, "D": 3, "I": 2}
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen
                   else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, lines): the least of all sequences of edits, by plain tuples."""
    bad = faults(rows)

    @functools.cache
    def best(i, state):
        found = []
        if i == len(rows) and state in "-a":
            found.append((0, "", ()))
        for roles in ((), ("user",), ("assistant",), ("user", "assistant")):
            at, ok = state, True
            for r in roles:
                ok &= (r == "assistant") == (at == "u")
                at = r[0]
            if not ok:
                continue
            cost, ops, lines = 2 * len(roles), "I" * len(roles), tuple(r + ":" for r in roles)
            if i == len(rows):
                if roles and at == "a":
                    found.append((cost, ops, lines))
                continue
            role, text = rows[i]
            steps = [("D", at, None)]
            if bad[i] not in ("blank", "duplicate"):
                follows = {"-": "su", "s": "u", "u": "a", "a": "u"}[at]
                if role[:1] and role[0] in follows:
                    steps.append(("K", role[0], role))
                steps += [("R", r[0], r) for r in ("user", "assistant") if r[0] in follows]
            for op, to, name in steps:
                more = COST[op] + (op != "D" and bad[i] == "truncated")
                c, a, rest = best(i + 1, to) or (None,) * 3
                if c is not None:
                    kept = () if name is None else (f"{name}:{text}",)
                    found.append((cost + more + c, ops + op + a, lines + kept + rest))
        return min(found) if found else None
    cost, audit, lines = best(0, "-")
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def talk(dice, n):
    roles = ["user", "assistant", "system", "tool", "u", "", " "]
    texts = ["", " \n", "so it is.", "and then", "why?", "no!", "x", "end. "]
    return [(dice.choice(roles[:2] if dice.random() < .7 else roles), dice.choice(texts)
             + ("" if dice.random() < .4 else f" {dice.randrange(5)}.")) for _ in range(n)]


def expected(rows):
    bad = faults(rows)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    return (bad.count("blank"), bad.count("duplicate"), bad.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), *brute(rows))


def got_of(row):
    return (row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit,
            row.repaired_sha256)


@pytest.mark.parametrize("piece,many", [(4096, 64), (3, 2)])
def test_random_talks(spark, monkeypatch, piece, many):
    monkeypatch.setattr(dialogues, "PIECE", piece)
    monkeypatch.setattr(dialogues, "MANY", many)
    dice = random.Random(piece)
    talks = {c: talk(dice, dice.randrange(1, 14)) for c in range(150)}
    talks[None] = talk(dice, 6)
    talks[1000] = [("user", "again and again.")] * 40 + [("assistant", "yes.")]
    rows = [(c, t, *r) for c, rs in talks.items() for t, r in enumerate(rs)]
    dice.shuffle(rows)
    got = {r.conv_id: r for r in repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == set(talks)
    for c, rs in talks.items():
        assert got_of(got[c]) == expected(rs), (c, rs)
        assert got[c].gaps == 0


def test_equal_rows_and_turns(spark):
    """Rows that are the same in every column are copies; a third of the table may be one of them."""
    rows = [(7, None, "user", "hm.")] + [(7, 3, "user", "ho.")] * 300 + [(7, 9, "assistant", "he.")] \
        + [(7, 9, "assistant", "he.")] + [(8, None, None, None), (9, 1, "user", "x")]
    got = {r.conv_id: r for r in repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    seven = [("user", "hm.")] + [("user", "ho.")] * 300 + [("assistant", "he.")] * 2
    assert got_of(got[7]) == expected(seven) and got[7].gaps == 5
    assert got_of(got[8]) == expected([(" ", " ")]) and got[8].gaps == 0
    assert got_of(got[9]) == expected([("user", "x")])


def test_long_talk_in_many_partitions(spark):
    dice = random.Random(9)
    rs = talk(dice, 700)
    rows = [(5, t, *r) for t, r in enumerate(rs)] + [(t, 0, "user", "a.") for t in range(5)] \
        + [(t, 0, "user", "a.") for t in range(6, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: r for r in repair(df).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    import sys
    sys.setrecursionlimit(10_000)
    assert got_of(got[5]) == expected(rs)
    assert all(got[c].audit == "KI" for c in (0, 4, 6, 8))


def test_damage(spark):
    import zlib
    rows = [(c, t, r, x) for c in [1, 2, None] for t in [*range(40), None]
            for r, x in [("assistant", "a. b! c?"), (None, None)][:1 + (t == 3)]]
    got = damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for c, t, r, x in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20
        r, x = r or " ", x or " "
        if kind:
            want.append((c, t, "user" if kind == 4 else r,
                         "" if kind == 1 else x.translate({46: None, 33: None, 63: None})
                         if kind == 2 else x, 2 if kind == 3 else 1))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_order_of_audits_and_collisions(monkeypatch):
    dice = random.Random(2)
    for mod in ((1 << 61) - 1, 3):  # the second makes most hashes collide
        monkeypatch.setattr(dialogues, "_MOD", mod)
        root = Node(None, "")
        nodes = [root]
        for _ in range(400):
            nodes.append(Node(dice.choice(nodes[-12:]), dice.choice("DIKR")))
        for _ in range(2000):
            x, y = dice.choice(nodes), dice.choice(nodes)
            assert before(x, y) == (x.text() < y.text())


def test_states_alone():
    states = States()
    assert states.end() == (0, "")
    states.row("a", False, 0)
    assert states.end() == (2, "IK")  # not the deletion, which costs 3


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, 1, "user", "w. " * 400_000, 5, "x")],
                               SCHEMA + ", copies long, audit string")
    row = repair(df).first()
    assert (row.cost, row.audit) == (2, "KI")
    assert repair(df.limit(0), damage=True).count() == 0
    assert repairs(damaged(df.limit(0))).count() == 0


def test_query_against_sql(spark, sf_dir):
    from tidegrid.llm.queries import ORACLES, QUERIES
    name = "op11_conversation_repair"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []
