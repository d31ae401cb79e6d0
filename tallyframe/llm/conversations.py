"""Repair of conversations to the role pattern system? (user assistant)+ at the least cost, by Hirschberg's method.

A conversation is read by turn through four states: nothing yet, after the
system's turn, after a user's, after an assistant's. Each row is kept, given the
role that the state asks for, or deleted, and empty turns of that role may be
inserted before it. An edit script is its string of initials (D, I, K, R), which
decides the states it goes through; of the cheapest scripts the ASCII-least is taken.

Hirschberg: a forward vector holds for each state the least cost to reach it and
the rank of its least script among the four (no such script is the beginning of
another, as each ends in a row's letter); a backward vector the least cost from
each state to the end. Both meet in the middle: of the states with the least sum
the one with the least rank is crossed, and both halves go on alone. Vectors are
kept less their least cost, so they are few, and each step is looked up.

A row, or a block of rows, is a summary: from each state to each state the least
cost, and the rank of the script among those from the same state. Summaries of
neighbours go together as vectors go through them, so a conversation too long for
one task is cut into blocks: their summaries meet at the top, which gives each
block its states, and blocks are solved alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: By state: what follows it (its role initial and the state after it). A system's turn may only come first.
EXPECTED = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
ROLES = {"u": "user", "a": "assistant"}
STATES = range(4)
_FAR = 1 << 60
#: Insertions that end a conversation in each state.
TAILS = ("", "II", "I", "")
#: Conversations of more rows or bytes of text are cut into blocks.
LONG_ROWS, LONG_BYTES = 10_000, 64 << 20
#: So many ids of long conversations are sent to all tasks at most; more are joined by shuffle.
BROADCAST_IDS = 100_000


# --- edits of one row, summaries and vectors ---------------------------------


class Summary(NamedTuple):
    """From each state to each: least cost, and rank of the least script among those of the same first state."""

    costs: tuple[tuple[int, ...], ...]
    ranks: tuple[tuple[int, ...], ...]


@lru_cache(maxsize=None)
def scripts(kind: tuple[str, bool, bool]) -> tuple[dict[int, tuple[int, str]], ...]:
    """By state before a row, and by state after it: cost and letters of the cheapest, ASCII-least edits of the row and insertions before it.

    kind: role initial (s, u, a or another text), whether the row must go, and whether it is truncated.
    """
    initial, must_go, truncated = kind
    out = []
    for first in STATES:
        found: dict[int, tuple[int, str]] = {}
        state, before, spent = first, "", 0
        for _ in range(3):  # more insertions would come back to the same state
            edits = [(state, DELETE, "D")]
            if not must_go:
                own = 1 if initial == "s" and state == 0 else EXPECTED[state][1] if initial == EXPECTED[state][0] else None
                if own is not None:
                    edits.append((own, TRUNCATED * truncated, "K"))
                edits.append((EXPECTED[state][1], REROLE + TRUNCATED * truncated, "R"))
            for after, cost, letter in edits:
                found[after] = min(found.get(after, (_FAR, "")), (spent + cost, before + letter))
            state, before, spent = EXPECTED[state][1], before + "I", spent + INSERT
        out.append(found)
    return tuple(out)


@lru_cache(maxsize=None)
def of_row(kind: tuple[str, bool, bool]) -> Summary:
    """The summary of one row."""
    costs, ranks = [], []
    for found in scripts(kind):
        order = sorted(found, key=lambda t: found[t][1])
        costs.append(tuple(found[t][0] if t in found else _FAR for t in STATES))
        ranks.append(tuple(order.index(t) if t in found else 9 for t in STATES))
    return Summary(tuple(costs), tuple(ranks))


Vector = tuple[tuple[int, ...], tuple[int, ...]]


def at(state: int) -> Vector:
    """The vector of a path that begins in a state."""
    return tuple(0 if s == state else _FAR for s in STATES), tuple(0 if s == state else 9 for s in STATES)


@lru_cache(maxsize=1 << 16)
def forward(vector: Vector, item: Summary) -> tuple[int, Vector]:
    """The vector behind an item, less its least cost, and that cost."""
    costs, ranks = vector
    best = [min(((costs[s] + item.costs[s][t], ranks[s], item.ranks[s][t]) for s in STATES if max(costs[s], item.costs[s][t]) < _FAR), default=(_FAR, 9, 9)) for t in STATES]
    order = sorted(b[1:] for b in best if b[0] < _FAR)
    least = min(b[0] for b in best)
    return least, (tuple(b[0] - least if b[0] < _FAR else _FAR for b in best), tuple(order.index(b[1:]) if b[0] < _FAR else 9 for b in best))


@lru_cache(maxsize=1 << 16)
def backward(costs: tuple[int, ...], item: Summary) -> tuple[int, ...]:
    """Costs to the end from before an item, less the least of them."""
    best = [min((min(item.costs[s][t] + costs[t], _FAR) for t in STATES)) for s in STATES]
    least = min(best)
    return tuple(b - least if b < _FAR else _FAR for b in best)


def through(vector: Vector, items: Sequence[Summary]) -> tuple[int, Vector]:
    total = 0
    for item in items:
        cost, vector = forward(vector, item)
        total += cost
    return total, vector


def summed(items: Sequence[Summary]) -> Summary:
    """The summary of items in a row."""
    rows = [through(at(s), items) for s in STATES]
    return Summary(
        tuple(tuple(total + c if c < _FAR else _FAR for c in costs) for total, (costs, _) in rows),
        tuple(ranks for _, (_, ranks) in rows),
    )


def crossings(items: Sequence[Summary], first: int, last: int) -> list[int]:
    """States after each item on the cheapest, audit-least way from a state to another."""
    out = [last] * len(items)

    def solve(lo: int, hi: int, p: int, q: int) -> None:
        if hi - lo < 2:
            return
        middle = (lo + hi) // 2
        vector = at(p)
        for k in range(lo, middle):
            vector = forward(vector, items[k])[1]
        costs = at(q)[0]
        for k in range(hi - 1, middle - 1, -1):
            costs = backward(costs, items[k])
        met = min((vector[0][s] + costs[s], vector[1][s], s) for s in STATES)[2]
        out[middle - 1] = met
        solve(lo, middle, p, met)
        solve(middle, hi, met, q)

    solve(0, len(items), first, last)
    return out


def ending(items: Sequence[Summary]) -> tuple[int, int]:
    """Cost of the cheapest whole script, and the state in which the audit-least of those leaves the last item."""
    total, (costs, ranks) = through(at(0), items)
    cost, _, state = min((costs[s] + INSERT * len(TAILS[s]), ranks[s], s) for s in STATES)
    return total + cost, state


# --- rows of a conversation, or of a block of one ----------------------------


class Rows:
    """Rows in order, copies spelt out: roles, texts, kinds, and counts of their faults."""

    def __init__(self):
        self.roles, self.texts, self.kinds, self.turns = [], [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self._seen: set[tuple[str, bytes]] = set()

    def add(self, turn: int | None, role: str | None, text: str | None, copies: int, later: bool | None) -> None:
        """later: whether an earlier turn has the same role and text; None if the rows added before are all there are."""
        role, text = " " if role is None else role, " " if text is None else text
        body = text.rstrip(BLANKS)
        if later is None:
            known = (role, hashlib.blake2b(text.encode(), digest_size=16).digest())
            later = known in self._seen
            self._seen.add(known)
        cut = bool(body) and body[-1] not in ".!?"
        for n in range(copies):
            again = later or n > 0
            self.blank += not body
            self.duplicate += bool(body) and again
            self.truncated += cut and not again
            pair = self.roles[-1][:1] + role[:1] if self.roles else None
            self.illegal += pair not in (None, "su", "ua", "au")
            self.roles.append(role)
            self.texts.append(text)
            self.turns.append(turn)
            self.kinds.append((role[:1] if role[:1] in ("s", "u", "a") else "", again or not body, cut))

    def items(self) -> list[Summary]:
        return [of_row(k) for k in self.kinds]

    def repaired(self, states: list[int], first: int) -> tuple[str, list[dict[str, str]]]:
        """The script of the states, and the turns it leaves."""
        letters, turns = [], []
        for role, text, kind, after in zip(self.roles, self.texts, self.kinds, states):
            script = scripts(kind)[first][after][1]
            letters.append(script)
            state = first
            for letter in script:
                if letter in "IR":
                    turns.append({"role": ROLES[EXPECTED[state][0]], "text": text if letter == "R" else ""})
                    state = EXPECTED[state][1]
                elif letter == "K":
                    turns.append({"role": role, "text": text})
            first = after
        return "".join(letters), turns

    def gaps(self) -> int:
        known = [t for t in self.turns if t is not None]
        return min(max(known) - min(known) + 1 - len(set(known)), (1 << 63) - 1) if known else 0


def tail(state: int) -> list[dict[str, str]]:
    turns = []
    for _ in TAILS[state]:
        turns.append({"role": ROLES[EXPECTED[state][0]], "text": ""})
        state = EXPECTED[state][1]
    return turns


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("turns", pa.list_(_TURN)),
])
PIECES = "conv_id long, block long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, turns array<struct<role: string, text: string>>"


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with the same first keys columns, as (key, rows)."""
    key, held = None, []
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            for row in zip(*(c.to_pylist() for c in batch.slice(lo, 1024).columns)):
                if held and row[:keys] != key:
                    yield key, held
                    held = []
                key = row[:keys]
                held.append(row[keys:])
    if held:
        yield key, held


def _emitted(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _whole(batches):
    """Conversations that are in one task with all their rows."""

    def solved():
        for (conv,), rows in _groups(batches, 1):
            every = Rows()
            for turn, role, text, copies in rows:
                every.add(turn, role, text, copies, None)
            items = every.items()
            cost, state = ending(items)
            audit, turns = every.repaired(crossings(items, 0, state), 0)
            yield conv, 0, every.gaps(), every.blank, every.duplicate, every.truncated, every.illegal, cost, audit + TAILS[state], turns + tail(state)

    yield from _emitted(solved(), _PIECE)


_BLOCK = "conv_id long, block long, costs array<long>, ranks array<long>, blank long, duplicate long, truncated long, illegal long, head string, foot string, low long, high long, known long, first_turn long"


def _block_rows(rows) -> Rows:
    every = Rows()
    for turn, role, text, copies, later in rows:
        every.add(turn, role, text, copies, later)
    return every


def _summaries(batches):
    def solved():
        for (conv, block), rows in _groups(batches, 2):
            every = _block_rows(rows)
            item = summed(every.items())
            known = [t for t in every.turns if t is not None]
            yield (
                conv, block, [c for row in item.costs for c in row], [r for row in item.ranks for r in row], every.blank, every.duplicate, every.truncated,
                every.illegal, every.roles[0][:1], every.roles[-1][:1], min(known, default=None), max(known, default=None), len(set(known)), min(known, default=None),
            )

    types = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    yield from _emitted(solved(), pa.schema([(n, types[t]) for n, t in (c.split(" ") for c in _BLOCK.split(", "))]))


_WAY = "conv_id long, block long, first long, last long, final boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _top(blocks: pd.DataFrame) -> pd.DataFrame:
    """States between the blocks of one conversation; it has a row for each task of the sort at most."""
    blocks = blocks.sort_values("block")
    items = [Summary(tuple(tuple(int(c) for c in x[4 * s : 4 * s + 4]) for s in STATES), tuple(tuple(int(r) for r in y[4 * s : 4 * s + 4]) for s in STATES)) for x, y in zip(blocks["costs"], blocks["ranks"])]
    cost, state = ending(items)
    states = crossings(items, 0, state)
    illegal = int(blocks["illegal"].sum()) + sum(a + b not in ("su", "ua", "au") for a, b in zip(blocks["foot"][:-1], blocks["head"][1:]))
    some = blocks[blocks["known"] > 0]
    turns = list(zip(some["low"].astype(int), some["high"].astype(int), some["known"].astype(int)))
    distinct = sum(n for _, _, n in turns) - sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
    gaps = min(turns[-1][1] - turns[0][0] + 1 - distinct, (1 << 63) - 1) if turns else 0
    totals = {c: int(blocks[c].sum()) for c in ("blank", "duplicate", "truncated")}
    out = pd.DataFrame({"conv_id": blocks["conv_id"], "block": blocks["block"], "first": [0, *states[:-1]], "last": states, "final": [False] * (len(states) - 1) + [True]})
    return out.assign(gaps=gaps, **totals, illegal=illegal, cost=cost)


def _rejoined(batches):
    def solved():
        for (conv, block, first, last, final, *totals), rows in _groups(batches, 11):
            every = _block_rows(rows)
            audit, turns = every.repaired(crossings(every.items(), first, last), first)
            yield (conv, block, *totals, audit + TAILS[last] * final, turns + (tail(last) if final else []))

    yield from _emitted(solved(), _PIECE, 1)


# --- Spark -------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows with faults, chosen by the CRC of ``conv_id:turn`` (null: a space) modulo 20.

    0 drops the row (copies 0), 1 empties its text, 2 takes its ``.!?`` away, 3
    doubles it (copies 2), 4 makes it a user's. A null role or text is a space.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    of = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn",
        F.when(of == 4, "user").when(of != 0, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(of == 1, "").when(of == 2, F.translate(text, ".!?", "")).when(of != 0, text).alias("text"),
        F.when(of == 0, 0).when(of == 3, 2).otherwise(1).alias("copies"),
    )


def _long_pieces(spark: SparkSession, rows: DataFrame, blocks_wanted: int, scratch: Scratch) -> DataFrame:
    """Pieces of conversations that no task can hold: blocks of a range-partitioned sort."""
    equal = rows.where("copies > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    equal = scratch.keep(equal.withColumn("digest", F.sha2("text", 256)).withColumn("place", F.struct(F.col("turn").isNotNull(), "turn")))
    repeated = equal.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("g")).agg(F.min("place").alias("begun"), F.count("*").alias("n")).where("n > 1")
    marked = equal.join(repeated, F.expr("conv_id <=> c AND role = r AND digest = g"), "left")
    later = F.coalesce(F.col("place") > F.col("begun"), F.lit(False))
    order = ("conv_id", "turn", "role", "text")
    ranged = marked.select(*order, "copies", later.alias("later")).repartitionByRange(blocks_wanted, *order).select("conv_id", (F.spark_partition_id() + 1).cast("long").alias("block"), "turn", "role", "text", "copies", "later")
    blocks = scratch.keep(ranged)

    def in_order(frame: DataFrame, keys: list[str]) -> DataFrame:
        return frame.repartition("conv_id", "block").sortWithinPartitions(*keys, "turn", "role", "text").select(*keys, "turn", "role", "text", "copies", "later")

    met = scratch.keep(in_order(blocks, ["conv_id", "block"]).mapInArrow(_summaries, _BLOCK))
    ways = scratch.keep(met.groupBy("conv_id").applyInPandas(_top, _WAY))
    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ways = ways.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "first", "last", "final", *totals)
    given = blocks.join(ways, F.expr("conv_id <=> c AND block = b"))
    return in_order(given, ["conv_id", "block", "first", "last", "final", *totals]).mapInArrow(_rejoined, PIECES)


def _pieces(spark: SparkSession, conversations: DataFrame, copies: str | None, long_rows: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Pieces of conversations that are whole in a task, and those of long ones if there are any."""
    scratch = Scratch(spark, "conversations")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("copies"),
    )
    rows = rows.select("conv_id", "turn", *[F.when(F.col("copies") > 0, F.col(c)).alias(c) for c in ("role", "text")], "copies")
    sizes = rows.groupBy(F.col("conv_id").alias("c")).agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text") * F.col("copies")).alias("bytes"))
    long = scratch.keep(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)))
    n_long, wanted = long.agg(F.count("*"), F.coalesce(F.ceil(F.sum("n") / long_rows + F.sum("bytes") / long_bytes), F.lit(0))).first()

    def solved(short: DataFrame) -> DataFrame:
        return short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_whole, PIECES)

    if not n_long:
        return solved(rows), None
    long = long.select("c")
    known, same = F.broadcast(long) if n_long <= BROADCAST_IDS else long, F.expr("conv_id <=> c")
    return solved(rows.join(known, same, "left_anti")), _long_pieces(spark, rows.join(known, same, "left_semi"), max(1, int(wanted)), scratch)


def repair(spark: SparkSession, conversations: DataFrame, copies: str | None = None, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """conv_id, block, gaps, blank, duplicate, truncated, illegal, cost, audit, turns: the repaired conversations.

    conversations needs conv_id, turn, role and text; ``copies`` names a column that
    says how often a row stands there in a row (0: it only names its conversation).
    Other columns are not read. turns has the role and text of each turn left;
    audit the edits. A conversation has one row, of block 0; one of more than
    long_rows rows or long_bytes bytes has a row for each block from 1 on, in order, with the
    counts of the whole, and audit and turns of the block.

    Rows are read by turn, those without one first, and rows of one turn by role and
    text. A null role or text is a space; rows without conv_id are one
    conversation. Of a row's faults the first counts: blank, duplicate, truncated. An
    empty conversation (all copies 0) has zeros and no audit. No rows give none.
    """
    whole, several = _pieces(spark, conversations, copies, long_rows, long_bytes)
    return whole if several is None else whole.unionAll(several)


def _line(turn):
    return F.concat(turn["role"], F.lit(":"), turn["text"])


def _streamed(batches):
    """One row for each conversation in several blocks; the hash takes a block at a time."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    key, head, audit, digest, empty = None, None, [], None, True

    def ended():
        return pa.RecordBatch.from_pylist([dict(zip(names, [*head, "".join(audit), digest.hexdigest()]))], schema=pa.schema([(n, pa.int64()) for n in names[:-2]] + [(n, pa.string()) for n in names[-2:]]))

    for batch in batches:
        for k in range(batch.num_rows):
            conv, _, *counts, letters, body, n = (c[k].as_py() for c in batch.columns)
            if head is None or conv != key:
                if head is not None:
                    yield ended()
                key, head, audit, digest, empty = conv, [conv, *counts], [], hashlib.sha256(), True
            audit.append(letters)
            if n:
                digest.update(body.encode() if empty else b"\n" + body.encode())
                empty = False
    if head is not None:
        yield ended()


def report(spark: SparkSession, conversations: DataFrame, copies: str | None = None, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: repair(), a row for each conversation.

    The hash is of the repaired ``role:text`` lines. A conversation in several blocks
    is read by one task, a block at a time.
    """
    body = F.array_join(F.transform("turns", _line), "\n")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole, several = _pieces(spark, conversations, copies, long_rows, long_bytes)
    one = whole.select("conv_id", *counts, "audit", F.sha2(body, 256).alias("repaired_sha256"))
    if several is None:
        return one
    several = several.select("conv_id", "block", *counts, "audit", body.alias("body"), F.size("turns").alias("n"))
    schema = "conv_id long, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string"
    return one.unionAll(several.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_streamed, schema))
