from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from storelens.llm import turns

PATTERN = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def all_repairs(rows):
    """Every way to edit rows (role, text, gone, cut) with up to two insertions beside each: (cost, audit, turns)."""
    added = [[("I", r, "", 5)] for r in ("user", "assistant")]
    gaps = [[], *added, *[a + b for a in added for b in added]]

    def of_row(role, text, gone, cut):
        ways = [("D", None, None, 2)]
        if not gone:
            more = 5 if cut else 0
            ways += [("K", role, text, more), ("R", "user", text, 1 + more), ("R", "assistant", text, 1 + more)]
        return ways

    for choice in product(gaps, *[x for row in rows for x in ([*of_row(*row)], gaps)]):
        edits = [e for c in choice for e in (c if isinstance(c, list) else [c])]
        kept = [(role, text) for edit, role, text, _ in edits if edit != "D"]
        if PATTERN.fullmatch("".join(role[:1] or "-" for role, _ in kept)):
            yield sum(e[3] for e in edits), "".join(e[0] for e in edits), kept


def label(rows):
    return [(role[:1], gone, cut) for role, _, gone, cut in rows]


ROW = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.just("t"), st.booleans(), st.booleans())


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_cheapest_against_all_repairs(rows):
    cost, audit, kept = min(all_repairs(rows))
    assert turns.cheapest(label(rows), turns.START, turns.ENDS) == (cost, audit)
    assert turns.edited([(r[0], r[1]) for r in rows], audit, turns.START) == kept


def one_sided(rows, start, ends):
    """Least label by dynamic programming, row by row."""
    labels = {start: (0, "")}

    def better(into, state, path):
        if state not in into or path < into[state]:
            into[state] = path

    for i in range(len(rows) + 1):
        for _ in range(3):
            for state, (cost, audit) in list(labels.items()):
                better(labels, turns.NEXT[state], (cost + 5, audit + "I"))
        if i < len(rows):
            after = {}
            for state, (cost, audit) in labels.items():
                for target, price, edit in turns.onward(rows[i], state):
                    better(after, target, (cost + price, audit + edit))
            labels = after
    return min((labels[e] for e in ends if e in labels), default=None)


@settings(max_examples=150, deadline=None)
@given(st.lists(ROW, max_size=14), st.sampled_from(list(turns.STATES)), st.sampled_from(list(turns.STATES)))
def test_blocks_between_any_states(rows, start, end):
    assert turns.cheapest(label(rows), start, (end,)) == one_sided(label(rows), start, (end,))


def expected(data):
    damaged = []
    for at, (conv, turn, role, text) in enumerate(data):
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in {row[0] for row in data}:
        own = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, rows, faults = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            bare = re.findall("[^\x20\x09-\x0d]", text)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            rows.append((role, text, fault in (0, 1), fault == 2))
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = one_sided(label(rows), turns.START, turns.ENDS)
        fixed = turns.edited([(r[0], r[1]) for r in rows], audit, turns.START)
        whole = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, *faults, illegal, cost, audit, whole)
    return out


def sample(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "", None, "  ", "Why?\n", "É!", "a b c", "x" * 3000 + ".", "Yes."]
    data = []
    for conv in [*range(conversations), None]:
        for _ in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            data.append((conv, rng.choice([None, *range(12)]), role, rng.choice(texts)))
    return data


@pytest.mark.parametrize("block_rows", [1, 2, 5, 256])
def test_conversations_against_brute_force(rows, block_rows):
    """Ties in turn, nulls everywhere, repeated rows, blocks that end within a conversation."""
    data = sample(3, 60, 9)
    df = rows(SCHEMA + ", audit string, part int", *[(*r, "old", 1) for r in data])
    repaired = turns.repair(turns.damage(df), block_rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in turns.reports(repaired).collect()}
    assert got == expected(data)


def test_one_conversation_holds_most_rows(rows, spark):
    """Its blocks are spread over tasks, and joined to what one search finds."""
    rng = random.Random(5)
    data = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"No {t}.", f"hm {t}"])) for t in range(3000)]
    data += sample(6, 20, 4)
    repaired = turns.repair(turns.damage(rows(SCHEMA, *data).repartition(4)), 100)
    got = {r["conv_id"]: tuple(r)[1:] for r in turns.reports(repaired).collect()}
    assert got == expected(data)
    assert repaired.filter("conv_id = 7").count() > 10


def test_repaired_turns_are_returned(rows):
    df = rows(SCHEMA + ", copies int", (1, 0, "user", "Hi.", 1), (1, 1, "user", "Well", 1), (1, 2, "assistant", "Yes.", 1), (2, 0, "a", "x.", 0))
    got = {r["conv_id"]: r for r in turns.repair(df).collect()}
    assert got[1]["audit"] == "KDK" and got[1]["roles"] == ["user", "assistant"] and got[1]["texts"] == ["Hi.", "Yes."]
    assert got[2]["rows"] == 0 and got[2]["cost"] == 0


def test_a_very_long_text_and_an_empty_table(rows):
    df = rows(SCHEMA + ", copies int", (1, 0, "user", "long " * 1_000_000 + ".", 1), (1, 1, "assistant", "Yes.", 1))
    (report,) = turns.reports(turns.repair(df)).collect()
    assert report["audit"] == "KK" and report["cost"] == 0
    assert turns.reports(turns.repair(turns.damage(rows(SCHEMA)))).count() == 0
