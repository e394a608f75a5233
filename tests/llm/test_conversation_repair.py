import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from marlstone.llm import edit_lattice as lattice
from marlstone.llm.conversation_repair import damaged, repaired_conversations
from marlstone.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, at string, kind int, `a.b` string"
BLANKS = " \t\n\x0b\x0c\r"
AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


@lru_cache(None)
def plain(turns: tuple) -> tuple[int, str]:
    """Cheapest edits of (initial, fault) pairs, by trying every edit at every place."""

    @lru_cache(None)
    def go(at, state, inserts):
        options = [(0, "")] if at == len(turns) and state in (0, 3) else []
        if inserts < 2:
            options.append(add(2, "I", go(at, 3 if state == 2 else 2, inserts + 1)))
        if at < len(turns):
            initial, fault = turns[at]
            options.append(add(3, "D", go(at + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if (initial, state) in AFTER:
                    options.append(add(more, "K", go(at + 1, AFTER[initial, state], 0)))
                options.append(add(2 + more, "R", go(at + 1, 3 if state == 2 else 2, 0)))
        return min(options, default=(10**9, ""))

    return go(0, 0, 0)


def add(cost, edit, rest):
    return cost + rest[0], edit + rest[1]


def expected(rows):
    """One conversation's result from its (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, turns = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        turns.append((role[:1], fault))
    cost, audit = plain(tuple(turns))
    state, left, lines = 0, iter(rows), []
    for edit in audit:
        _, role, text = next(left) if edit != "I" else (None, "", "")
        if edit == "D":
            continue
        if edit in "IR":
            role = "assistant" if state == 2 else "user"
        state = AFTER[role[0], state]
        lines.append(f"{role}:{text}")
    numbers = {r[0] for r in rows} - {None}
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *(sum(f == fault for _, f in turns) for fault in ("blank", "duplicate", "truncated")),
        sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def by_conversation(rows):
    found = {}
    for conv, turn, role, text, *_ in rows:
        found.setdefault(conv, []).append(
            (turn, " " if role is None else role, " " if text is None else text)
        )
    return {conv: expected(some) for conv, some in found.items()}


def results(df, **options):
    return {r[0]: tuple(r)[1:] for r in repaired_conversations(df, **options)[0].collect()}


def conversations(seed, how_many, longest):
    pick = random.Random(seed)
    rows = []
    for conv in [None, *range(how_many)]:
        for turn in range(pick.randint(1, longest)):
            role = pick.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = pick.choice(["Yes.", "No", "", " \n", None, "é?", f"Turn {turn}!", "x" * 3000 + "."])
            rows.append((conv, pick.choice([turn, turn, turn, None, 7]), role, text))
    return [(*r, "at", 5, "x") for r in [*rows, rows[0], rows[-1], rows[-1]]]


def test_lattice_equals_trying_everything():
    pick = random.Random(3)
    names = {0: "", 1: "blank", 2: "duplicate", 3: "truncated"}
    for _ in range(3000):
        turns = [
            (pick.choice(["system", "user", "assistant", "tool", ""]), pick.choice([0, 0, 0, 1, 2, 3]))
            for _ in range(pick.randint(0, 9))
        ]
        letters = "".join(lattice.sign(*t) for t in turns)
        wanted = plain(tuple((role[:1], names[fault]) for role, fault in turns))
        found = lattice.repair(letters)
        assert (found.cost, found.audit) == wanted
        cuts = [0, *sorted(pick.randint(0, len(letters)) for _ in range(2)), len(letters)]
        pieces = [letters[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
        assert tuple(lattice.joined([lattice.stretch(p) for p in pieces])) == wanted


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_equals_brute_force(spark, parts):
    rows = conversations(1, 12, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert results(df) == by_conversation(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_conversations_are_handed_on_and_cut(spark):
    rows = conversations(2, 3, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    assert results(df, held_chars=2000, stretch_bits=2) == by_conversation(rows)


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_repaired_turns_give_the_digest(spark, held):
    rows = conversations(4, 8, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    summary, turns = repaired_conversations(df, with_turns=True, held_chars=held)
    lines = {}
    for r in sorted(turns.collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in summary.collect():
        text = "\n".join(lines.get(r.conv_id, [])).encode()
        assert r.repaired_sha256 == hashlib.sha256(text).hexdigest()


def test_no_rows_left_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (None, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = results(df.selectExpr("*", "false AS present"), present=df.conv_id < 0)
    assert found == {1: nothing, None: nothing}
    assert results(df.limit(0)) == {}


def test_the_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    wanted = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    wanted |= by_conversation(damage(rows))
    found = QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.01")
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == wanted


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        told = [" " if x is None else x for x in (conv, turn, role, text)]
        case = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        body = {1: "", 2: re.sub("[.!?]", "", told[3])}.get(case, told[3])
        out += [(conv, turn, "user" if case == 4 else told[2], body)] * {0: 0, 3: 2}.get(case, 1)
    return out


def test_damage(spark):
    rows = [(c, t, r, x) for c in (1, None) for t in [*range(60), None]
            for r, x in [("assistant", "A. b? c!"), (None, None)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = damaged(df).where("present").drop("present").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, damage(rows)))
