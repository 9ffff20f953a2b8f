"""Conversation structure repair by bidirectional Dijkstra over the edit lattice (operator 11).

A conversation is right if the initials of its roles read `(s?(ua)+)?`. A node of the lattice is
(rows used, state of that pattern); edges keep, rerole, delete or insert a turn at a cost. A
forward and a reverse heap meet; all crossings of the least cost are finished, and of the
audits (the initials of the edits) that they join, the ASCII-least is taken. Two equally dear
audits of the same rows between the same states are never a prefix of each other, for the
longer one has more insertions; so the least part of an audit is part of the least audit.

A conversation of any length is cut into blocks of rows, side by side over the tasks. A block
that is a whole conversation is searched once; other blocks are searched between every pair of
states, and a walk along the blocks joins these results, which is the same as one search.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import product
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import fold, ship, stored

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
UNFINISHED = 5
# States of the pattern: nothing yet, after the system turn, after a user, after an assistant.
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
ENDS = (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
# Rows and characters of a block; one row may be longer.
BLOCK_ROWS, BLOCK_CHARS = 256, 1 << 21
# A row as the search sees it: initial of its role, must go, unfinished.
Row = tuple[str, bool, bool]
Path = tuple[int, str]


def onward(row: Row, state: int) -> list[tuple[int, int, str]]:
    """Edges that use a row up: (state after, cost, initial of the edit)."""
    initial, gone, unfinished = row
    edges = [(state, DELETE, "D")]
    if not gone:
        more = UNFINISHED if unfinished else 0
        after = NEXT[state]
        kept = SYSTEM if initial == "s" and state == START else after if initial == ROLES[after][0] else None
        if kept is not None:
            edges.append((kept, KEEP + more, "K"))
        edges.append((after, REROLE + more, "R"))
    return edges


def cheapest(rows: list[Row], start: int, ends: tuple[int, ...]) -> Path | None:
    """Least cost and, of the audits of that cost, the ASCII-least; None if no path is there.

    A heap's key has the rows used after the cost, so that a node is settled after every node
    from which an edge of no cost reaches it.
    """
    n = len(rows)
    back: dict[tuple[int, int], list] = {}
    for i, state in product(range(n + 1), STATES):
        for node, cost, edit in _edges(rows, (i, state)):
            back.setdefault(node, []).append(((i, state), cost, edit))
    best = [{(0, start): (0, "")}, {(n, state): (0, "") for state in ends}]
    heaps = [[(0, 0, start)], [(0, -n, state) for state in ends]]
    heaps[1].sort()
    settled: list[dict] = [{}, {}]
    least, found = None, None
    while heaps[0] and heaps[1] and (least is None or heaps[0][0][0] + heaps[1][0][0] <= least):
        side = 0 if heaps[0][0] <= heaps[1][0] else 1
        cost, i, state = heapq.heappop(heaps[side])
        node = (abs(i), state)
        if node in settled[side]:
            continue
        own = settled[side][node] = best[side][node]
        meets = [(node, 0, "")] + (_edges(rows, node) if side == 0 else back.get(node, []))
        for other, price, edit in meets:
            if other in settled[1 - side]:
                across = settled[1 - side][other]
                halves = (own, across) if side == 0 else (across, own)
                path = (own[0] + price + across[0], halves[0][1] + edit + halves[1][1])
                if found is None or path < found:
                    least, found = path[0], path
            if other != node and other not in settled[side]:
                path = (own[0] + price, own[1] + edit if side == 0 else edit + own[1])
                if other not in best[side] or path < best[side][other]:
                    best[side][other] = path
                    heapq.heappush(heaps[side], (path[0], other[0] if side == 0 else -other[0], other[1]))
    return found


def _edges(rows: list[Row], node: tuple[int, int]) -> list:
    i, state = node
    edges = [((i, NEXT[state]), INSERT, "I")]
    if i < len(rows):
        edges += [((i + 1, after), cost, edit) for after, cost, edit in onward(rows[i], state)]
    return edges


def edited(turns: list[tuple[str, str]], audit: str, state: int) -> list[tuple[str, str]]:
    """The turns that an audit makes, from a state on."""
    left, made = iter(turns), []
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[state]
        made.append((role if edit == "K" else ROLES[state], text))
    return made


def damage(conversations: DataFrame) -> DataFrame:
    """Damaged rows with their number of `copies`, by the checksum of `conv_id:turn` modulo 20.

    0 drops the row (no copies), 1 empties its text, 2 takes `[.!?]` out of it, 3 repeats the
    row, 4 makes it a user's. A null role or text, and a null id or turn in the checksum's text,
    is one space.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fold(key, 20).alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Distinct rows with `copies` and `first`, by conversation and turn over the tasks.

    Equal rows are counted before they move. A row is first if no earlier one of its
    conversation has its role and text; that is found by a minimum, not in one task for each text.
    """
    keys = ["conv_id", "turn", "role", "text"]
    gone = F.col("copies") == 0
    # Rows of no copies only keep the conversation; they become one.
    marked = rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        *[F.when(gone, F.lit(" ")).otherwise(F.col(c)).alias(c) for c in ("role", "text")],
        "copies",
    )
    counted = stored(marked.groupBy(*keys).agg(F.sum("copies").cast("long").alias("copies")))
    firsts = (
        counted.filter("copies > 0")
        .groupBy("conv_id", "role", "text")
        .agg(F.bool_or(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("turn"))
        .select(F.col("conv_id").alias("_conv"), F.when(~F.col("_null"), F.col("turn")).alias("_turn"), F.col("role").alias("_role"), F.col("text").alias("_text"))
    )
    # Each side has a combination at most once, so no key of the join is hot.
    same = (
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & F.col("turn").eqNullSafe(F.col("_turn"))
        & (F.col("role") == F.col("_role"))
        & (F.col("text") == F.col("_text"))
    )
    joined = counted.join(firsts, same, "left").select(*keys, "copies", F.col("_role").isNotNull().alias("first"))
    # The range is drawn on the driver from a sample of keys, so these are short.
    ranged = joined.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 256))
    return ranged.sortWithinPartitions("conv_id", "turn", "role", "text")


class Block:
    """Some rows of a conversation, in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns: list[tuple[str, str]] = []
        self.rows: list[Row] = []
        self.numbers: list[int] = []
        self.chars = 0
        self.faults = [0, 0, 0]

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        bare = text.strip(SPACE)
        blank, repeated = not bare, not first
        unfinished = not (blank or repeated) and bare[-1] not in ".!?"
        for i, fault in enumerate((blank, repeated and not blank, unfinished)):
            self.faults[i] += fault
        self.rows.append((role[:1], blank or repeated, unfinished))
        self.turns.append((role, text))
        self.chars += len(role) + len(text)
        if turn is not None:
            self.numbers.append(turn)

    def facts(self, part: int, whole: bool) -> dict:
        initials = [r[0] for r in self.rows]
        paths = [None] * len(STATES) ** 2
        if not whole:
            paths = [cheapest(self.rows, a, (b,)) for a, b in product(STATES, STATES)]
        only = cheapest(self.rows, START, ENDS) if whole else None
        turns = edited(self.turns, only[1], START) if whole else self.turns
        return {
            "conv_id": self.conv_id,
            "part": part,
            "whole": whole,
            "rows": len(self.rows),
            "initials": [initials[0], initials[-1]] if initials else [],
            "span": [min(self.numbers), max(self.numbers), len(set(self.numbers))] if self.numbers else [],
            "blank": self.faults[0],
            "duplicate": self.faults[1],
            "truncated": self.faults[2],
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "cost": only[0] if whole else None,
            "audit": only[1] if whole else None,
            "costs": [p and p[0] for p in paths] if not whole else None,
            "audits": [p and p[1] for p in paths] if not whole else None,
            "roles": [t[0] for t in turns],
            "texts": [t[1] for t in turns],
        }


LONG, TEXT = T.LongType(), T.StringType()
PARTS = T.StructType(
    [
        T.StructField("conv_id", LONG),
        T.StructField("part", LONG),
        T.StructField("whole", T.BooleanType()),
        T.StructField("rows", LONG),
        T.StructField("initials", T.ArrayType(TEXT)),
        T.StructField("span", T.ArrayType(LONG)),
        *[T.StructField(c, LONG) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", TEXT),
        T.StructField("costs", T.ArrayType(LONG)),
        T.StructField("audits", T.ArrayType(TEXT)),
        T.StructField("roles", T.ArrayType(TEXT)),
        T.StructField("texts", T.ArrayType(TEXT)),
    ]
)
STEPS = T.StructType([T.StructField("part", LONG), T.StructField("enter", LONG), T.StructField("leave", LONG)])
REPORT = T.StructType(
    [
        T.StructField("conv_id", LONG),
        *[T.StructField(c, LONG) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", TEXT),
        T.StructField("repaired_sha256", TEXT),
    ]
)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dictionaries, some at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            yield from batch.slice(at, 64).to_pylist()


def _batches(records: Iterator[dict], schema: T.StructType, weigh=lambda r: 1, most: int = 1000) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, weight = to_arrow_schema(schema), [], 0
    for record in records:
        held.append(record)
        weight += weigh(record)
        if weight >= most:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


def blocks(ordered: DataFrame, rows: int = BLOCK_ROWS, chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of rows, each within one conversation; `part` grows along all of them.

    A block is whole if it begins and ends with its conversation. The first and the last
    conversation of a task may go on in another, so their blocks count as parts.
    """

    def cut(records: Iterator[dict]) -> Iterator[dict]:
        part = TaskContext.get().partitionId() << 33
        block, inner, cut_off = None, False, False
        for r in records:
            fresh = block is None or block.conv_id != r["conv_id"]
            if fresh:
                if block is not None:
                    yield block.facts(part, inner and not cut_off)
                    part += 1
                inner, cut_off, block = block is not None, False, Block(r["conv_id"])
            for copy in range(r["copies"]):
                if len(block.rows) >= rows or block.chars >= chars:
                    yield block.facts(part, False)
                    part, cut_off, block = part + 1, True, Block(r["conv_id"])
                block.add(r["turn"], r["role"], r["text"], r["first"] and copy == 0)
        if block is not None:
            yield block.facts(part, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(cut(_records(batches)), PARTS, lambda f: 1 + sum(map(len, f["texts"])) // 1000, 2000)

    ship(ordered.sparkSession)
    return ordered.mapInArrow(run, PARTS)


def walk(records: Iterator[dict]) -> Iterator[dict]:
    """States in which the cheapest path enters and leaves each block of the conversations.

    Of the audits so far only what the states do not have in common is held, and for each
    block one byte a state.
    """

    def steps(trace: list[tuple[int, bytes]], labels: dict[int, Path]) -> Iterator[dict]:
        state = min((labels[s], s) for s in ENDS if s in labels)[1]
        for part, came in reversed(trace):
            yield {"part": part, "enter": came[state], "leave": state}
            state = came[state]

    conv, labels, trace = None, None, []
    for r in records:
        if labels is None or r["conv_id"] != conv:
            if labels is not None:
                yield from steps(trace, labels)
            conv, labels, trace = r["conv_id"], {START: (0, "")}, []
        reached, came = {}, bytearray(len(STATES))
        for a, b in product(labels, STATES):
            at = a * len(STATES) + b
            if r["costs"][at] is not None:
                path = (labels[a][0] + r["costs"][at], labels[a][1] + r["audits"][at])
                if b not in reached or path < reached[b]:
                    reached[b], came[b] = path, a
        shared = len(commonprefix([audit for _, audit in reached.values()]))
        labels = {state: (cost, audit[shared:]) for state, (cost, audit) in reached.items()}
        trace.append((r["part"], bytes(came)))
    if labels is not None:
        yield from steps(trace, labels)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of the repaired conversations: their facts, the cheapest audit, roles and texts.

    `rows` has conv_id, turn, role, text and `copies` (0: only the conversation stays known);
    further columns are left out. A conversation's rows come by turn, nulls first, then by role
    and text. A row's first fault counts: blank, duplicate (an earlier row has its role and
    text), truncated (its last character that is not white space is none of `.!?`). Keeping a row
    is free, another role costs 1, a deletion 2, which blank and duplicate rows need, an insertion
    5, and a truncated row that stays 5 more. A null id is a conversation of its own; roles and
    texts must not be null. Joined by `part`, the blocks of a conversation are its repaired turns.
    Without rows there are no blocks. A very long text is held by one task, once.
    """
    ship(rows.sparkSession)
    cut = stored(blocks(in_order(rows), block_rows, block_chars))
    parts = cut.filter(~F.col("whole")).select("conv_id", "part", "costs", "audits")
    sorted_parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    steps = stored(sorted_parts.mapInArrow(lambda b: _batches(walk(_records(b)), STEPS), STEPS))
    chosen = cut.filter(~F.col("whole")).join(steps, "part")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(r: dict) -> dict:
            at = r["enter"] * len(STATES) + r["leave"]
            turns = edited(list(zip(r["roles"], r["texts"])), r["audits"][at], r["enter"])
            found = {"cost": r["costs"][at], "audit": r["audits"][at], "roles": [t[0] for t in turns], "texts": [t[1] for t in turns]}
            return {f.name: (r | found)[f.name] for f in PARTS.fields} | {"costs": None, "audits": None}

        return _batches(map(one, _records(batches)), PARTS, lambda f: 1 + sum(map(len, f["texts"])) // 1000, 2000)

    repaired = cut.filter("whole").unionByName(chosen.mapInArrow(apply, PARTS))
    return repaired.drop("costs", "audits")


def total(records: Iterator[dict]) -> Iterator[dict]:
    """One report for each conversation from its blocks in order."""
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")
    conv, held, audit, hashed, span, last, began = None, None, [], None, None, "", False

    def report() -> dict:
        gaps = span[1] - span[0] + 1 - span[2] if span else 0
        return {"conv_id": conv, "gaps": gaps, **held, "audit": "".join(audit), "repaired_sha256": hashed.hexdigest()}

    for r in records:
        if held is None or r["conv_id"] != conv:
            if held is not None:
                yield report()
            conv, held, audit, hashed = r["conv_id"], dict.fromkeys(sums, 0), [], hashlib.sha256()
            span, last, began = None, None, False
        for name in sums:
            held[name] += r[name]
        if r["initials"]:
            if last is not None and last + r["initials"][0] not in LEGAL:
                held["illegal"] += 1
            last = r["initials"][1]
        if r["span"]:
            low, high, distinct = r["span"]
            span = [span[0], high, span[2] + distinct - (low == span[1])] if span else [low, high, distinct]
        audit.append(r["audit"])
        for role, text in zip(r["roles"], r["texts"]):
            hashed.update(f"{chr(10) if began else ''}{role}:{text}".encode())
            began = True
    if held is not None:
        yield report()


def reports(repaired: DataFrame) -> DataFrame:
    """conv_id, gaps, counts of faults, cost, audit, repaired_sha256 of each conversation.

    The digest is that of `role:text` of the repaired turns, joined by newlines. Conversations
    of one block need no shuffle. A digest is made from front to back, so the blocks of a longer
    one pass one task after another, of which it holds one at a time.
    """
    ship(repaired.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(total(_records(batches)), REPORT)

    parts = repaired.filter(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return repaired.filter("whole").mapInArrow(run, REPORT).unionByName(parts.mapInArrow(run, REPORT))
