"""Conversation repair against every edit script, and against a plain dynamic programme that carries whole scripts."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyframe.llm import conversations

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id long, turn long, role string, text string"


def valid(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def faults(rows):
    """A fault or None for each (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_script(rows, most=3):
    """Least (cost, audit, lines) over all scripts with at most so many insertions before each row; slow."""
    found, n = faults(rows), len(rows)
    inserts = ["".join(x) for k in range(most) for x in itertools.product("ua", repeat=k)]
    options = []
    for (_, role, text), fault in zip(rows, found):
        extra = 3 * (fault == "truncated")
        edits = [(4, "D", None)]
        if fault not in ("blank", "duplicate"):
            edits += [(extra, "K", (role, text)), (3 + extra, "R", ("user", text)), (3 + extra, "R", ("assistant", text))]
        options.append(edits)
    best = None
    names = {"u": "user", "a": "assistant"}
    for edits in itertools.product(*options):
        for added in itertools.product(inserts, repeat=n + 1):
            turns, audit, cost = [], "", 0
            for k in range(n + 1):
                turns += [(names[i], "") for i in added[k]]
                audit, cost = audit + "I" * len(added[k]), cost + 3 * len(added[k])
                if k < n:
                    cost, audit = cost + edits[k][0], audit + edits[k][1]
                    turns += [edits[k][2]] if edits[k][2] else []
            if valid("".join(r[:1] for r, _ in turns)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, [f"{r}:{t}" for r, t in turns])
    return best


def carried(rows):
    """The same by a forward dynamic programme over states, each with its least (cost, audit, lines)."""
    follows = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def inserted(states):
        for _ in range(4):
            for s, (cost, audit, lines) in list(states.items()):
                role, t = follows[s]
                new = (cost + 3, audit + "I", [*lines, f"{role}:"])
                if t not in states or new[:2] < states[t][:2]:
                    states[t] = new
        return states

    states = {0: (0, "", [])}
    for (_, role, text), fault in zip(rows, faults(rows)):
        extra, after = 3 * (fault == "truncated"), {}

        def offer(s, new):
            if s not in after or new[:2] < after[s][:2]:
                after[s] = new

        for s, (cost, audit, lines) in inserted(states).items():
            offer(s, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            name, t = follows[s]
            offer(t, (cost + 3 + extra, audit + "R", [*lines, f"{name}:{text}"]))
            if s == 0 and role[:1] == "s":
                offer(1, (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
            elif role[:1] == name[:1]:
                offer(t, (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
        states = after
    states = inserted(states)
    return min((states[s] for s in (0, 3) if s in states), key=lambda x: x[:2])


def expected(table, damage=True):
    """conv_id to the contract's row, for (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            of, role, text = zlib.crc32(key.encode()) % 20 if damage else 9, " " if role is None else role, " " if text is None else text
            if of == 0:
                continue
            text = "" if of == 1 else re.sub("[.!?]", "", text) if of == 2 else text
            rows += [(turn, "user" if of == 4 else role, text)] * (2 if of == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        known = [r[0] for r in rows if r[0] is not None]
        kinds, firsts = faults(rows), [r[1][:1] for r in rows]
        cost, audit, lines = carried(rows)
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def invented(seed, conversations=40, most=12):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and then", "", " \t", "Yes.", "ü. ", "a.b", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    out = []
    for conv in range(conversations):
        for k in range(rng.randrange(1, most)):
            turn = None if rng.random() < 0.05 else k if rng.random() < 0.8 else rng.randrange(most + 4)
            plain = ["user", "assistant"][k % 2] if rng.random() < 0.6 else rng.choice(roles)
            out.append((conv if conv else None, turn, plain, rng.choice(texts) if rng.random() < 0.6 else f"Turn {rng.randrange(50)}."))
    return out


def as_dict(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_the_plain_programme_equals_all_scripts():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(k, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", "no", "", f"{k}."])) for k in range(rng.randrange(0, 4))]
        assert carried(rows) == every_script(rows), rows


def test_hirschberg_equals_the_plain_programme():
    rng = random.Random(11)
    for n in [0, 1, 2, 3, 5, 8, 13, 40] * 25:
        rows = [(k, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", "no", "", f"{k}.", f"{k}.", f"{k}"])) for k in range(n)]
        every = conversations.Rows()
        for row in rows:
            every.add(*row, 1, None)
        items = every.items()
        cost, state = conversations.ending(items)
        audit, turns = every.repaired(conversations.crossings(items, 0, state), 0)
        lines = [f"{t['role']}:{t['text']}" for t in turns + conversations.tail(state)]
        assert (cost, audit + conversations.TAILS[state], lines) == carried(rows), rows


def test_summaries_go_together():
    """A row of blocks leads to the same states as the rows themselves, wherever it is cut."""
    rng = random.Random(2)
    kinds = list(itertools.product(["s", "u", "a", ""], [False, True], [False, True]))
    for _ in range(200):
        items = [conversations.of_row(rng.choice(kinds)) for _ in range(rng.randrange(2, 30))]
        cuts = sorted({0, len(items), *(rng.randrange(len(items)) for _ in range(4))})
        blocks = [conversations.summed(items[a:b]) for a, b in zip(cuts, cuts[1:])]
        cost, state = conversations.ending(items)
        assert conversations.ending(blocks) == (cost, state)
        states = conversations.crossings(items, 0, state)
        assert conversations.crossings(blocks, 0, state) == [states[b - 1] for b in cuts[1:]]


@pytest.mark.parametrize("long_rows", [10_000, 4])
def test_repair_of_any_table(spark, long_rows):
    """Nulls everywhere, ties, repeated rows, unknown roles; long conversations in blocks give the same."""
    table = invented(long_rows)
    table += [(100, 5, "user", "Same.")] * 30 + [(101, k, "user", "Same.") for k in range(30)] + [(102, -(2**62), "user", "A."), (102, 2**62, "assistant", "B.")]
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    clashing = frame.withColumn("copies", F.lit("x")).withColumn("block", F.lit(1)).withColumn("audit", F.lit(None).cast("string"))
    assert as_dict(conversations.report(spark, clashing, long_rows=long_rows)) == expected(table, damage=False)
    rows = conversations.damaged(clashing)
    found = conversations.repair(spark, rows, copies="copies", long_rows=long_rows)
    assert as_dict(conversations.report(spark, rows, copies="copies", long_rows=long_rows)) == expected(table)
    if long_rows == 4:
        assert found.where("block > 1").count() > 0
    # the turns themselves follow the pattern
    for r in found.where("block = 0").collect():
        assert valid("".join(t.role[:1] for t in r.turns))


def test_long_bytes_make_a_conversation_long(spark):
    table = [(1, k, ["user", "assistant"][k % 2], f"{k} " + "word " * 20_000 + ".") for k in range(6)] + [(2, 0, "user", "Hi.")]
    frame = spark.createDataFrame(table, SCHEMA)
    found = conversations.repair(spark, frame, long_bytes=100_000)
    assert {(r.conv_id, r.block > 0) for r in found.collect()} == {(1, True), (2, False)}
    assert as_dict(conversations.report(spark, frame, long_bytes=100_000)) == expected(table, damage=False)


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.report(spark, empty).collect() == []
    assert conversations.report(spark, conversations.damaged(empty), copies="copies").collect() == []
    # all rows dropped: zeros, no audit, the hash of nothing
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = conversations.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))
    assert as_dict(conversations.report(spark, rows, copies="copies")) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(entry.queries()["op13_conversations"](spark, sf)) == expected(table)
