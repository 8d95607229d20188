import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from roamsight.llm import conversations
from roamsight.llm.common import table
from roamsight.llm.queries import op13_path_ranking

SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        out += [(conv, turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    return out


def cheapest(roles, faults):
    """(cost, audit, final rows) by trying all edits from the end, states being the role last given."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    after = {q: (0, "", ()) for q in ("", "a")}
    after["u"] = (3, "I", (("a", None),))
    after["s"] = (6, "II", (("u", None), ("a", None)))
    for at in reversed(range(len(roles))):
        role, fault = roles[at][:1], faults[at]
        base = {}
        for q in due:
            options = [(after[q][0] + 4, "D" + after[q][1], after[q][2])]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role == due[q] or role == "s" and q == "":
                    c, a, r = after[role]
                    options.append((c + extra, "K" + a, ((None, at), *r)))
                c, a, r = after[due[q]]
                options.append((c + 3 + extra, "R" + a, ((due[q], at), *r)))
            base[q] = min(options, key=lambda o: o[:2])
        after = {}
        for q in due:
            one, two = base[due[q]], base[due[due[q]]]
            first, second = (due[q], None), (due[due[q]], None)
            options = [base[q], (one[0] + 3, "I" + one[1], (first, *one[2])), (two[0] + 6, "II" + two[1], (first, second, *two[2]))]
            after[q] = min(options, key=lambda o: o[:2])
    return after[""]


def brute(rows, conversation_ids):
    groups = {c: [] for c in conversation_ids}
    for row in rows:
        groups.setdefault(row[0], []).append(row[1:])
    names, out = {"u": "user", "a": "assistant"}, {}
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            left = text.rstrip(SPACE)
            faults.append("blank" if not left else "duplicate" if (role, text) in seen else None if left[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[1][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, kept = cheapest([r[1] for r in mine], faults)
        lines = [f"{mine[at][1] if new is None else names[new]}:{'' if at is None else mine[at][2]}" for new, at in kept]
        turns = {r[0] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_registered_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = reported(op13_path_ranking(spark, sf_dir))
    assert found == brute(damaged(rows), [r[0] for r in rows])
    assert all(sum(f[i] for f in found.values()) for i in range(6))


def make(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def drawn_rows(rng, n_conversations, longest):
    rows = []
    for conv in range(n_conversations):
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = rng.choice(["Yes.", "No!", "Why?", "cut off", " ", "", f"Text {rng.randrange(6)}.", f"Text {rng.randrange(30)}"])
            rows.append((conv, turn + rng.choice([0, 0, 0, 1]), role, text))
    return rows


@pytest.mark.parametrize("rows_a_block", [1, 3, 512])
def test_blocks_of_any_size_give_the_same(spark, monkeypatch, rows_a_block):
    """Also with conversations that lie over several partitions and many blocks."""
    rng = random.Random(rows_a_block)
    rows = drawn_rows(rng, 60, 14) + [(1000, t, *r[2:]) for t, r in enumerate(drawn_rows(rng, 40, 12))]
    monkeypatch.setattr(conversations, "ROWS", rows_a_block)
    df = make(spark, rows).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert reported(conversations.report(df)) == brute(rows, {r[0] for r in rows})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_rows_follow_the_pattern(spark):
    rows = drawn_rows(random.Random(9), 40, 10)
    blocks = conversations.audited(conversations.blocks_of(make(spark, rows)))
    by = {}
    for r in sorted(conversations.repaired_rows(blocks).collect(), key=lambda r: (r.key, r.part, r.seq, r.place)):
        by.setdefault(r.key, []).append(r)
    expected = brute(rows, [])
    for key, mine in by.items():
        left = [r for r in mine if r.edit != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in left))
        assert "".join(r.edit for r in mine) == expected[int(key[1:])][-2]
        text = "\n".join(f"{r.role}:{r.text}" for r in left)
        assert hashlib.sha256(text.encode()).hexdigest() == expected[int(key[1:])][-1]


def test_dirty_rows(spark, clashing):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hello."), (None, 1, "user", "Hello."), (7, None, "user", "Hi."), (7, None, "user", "Hi."),
        (7, None, "assistant", "Yes."), (8, -(2**63), "user", "A."), (8, 2**63 - 1, "assistant", "B."), (9, 1, "user", "x" * 2_000_000 + "."), (10, 3, "", "\x00."),
    ]
    df = clashing(make(spark, rows), "key", "audit", "codes", "seq", "drawn")
    expected = brute([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], [])
    expected[8] = (None, *expected[8][1:])  # the gap is beyond 64 bits
    assert reported(conversations.report(df)) == expected
    assert reported(conversations.report(conversations.damage(df), df)).keys() == {None, 7, 8, 9, 10}
    assert conversations.report(conversations.damage(df.limit(0))).collect() == []
    nothing = reported(conversations.report(df.limit(0), df))
    assert set(nothing.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_ranks_choose_the_least_of_equal_costs():
    """Every state before a block, against all audits of the least cost."""
    rng = random.Random(2)
    codes = ["".join(rng.choice("suaoSUAObd") for _ in range(rng.randrange(9))) for _ in range(200)]
    blocks = conversations.Blocks.of(codes)
    last = np.ones(len(codes), bool)
    after = np.tile(conversations.AT_END, (len(codes), 1))
    found, states = blocks.audits(after, last, np.zeros((len(codes), 1), np.int64))
    costs = blocks.backwards(after)
    roles = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for i, code in enumerate(codes):
        faults = [{"b": "blank", "d": "duplicate"}.get(c, "truncated" if c.isupper() else None) for c in code]
        cost, audit, _ = cheapest([roles.get(c.lower(), "user") for c in code], faults)
        assert (costs[i, 0], found[i].decode()) == (cost, audit)
    assert set(states.ravel().tolist()) <= {0, 3}
