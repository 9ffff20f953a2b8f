from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from storelens.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """The root, and for each leaf its siblings on the way, as (left ones, right ones)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for k, i in enumerate(at):
            run, slot = runs[i // 3], i % 3
            steps[k].append((run[:slot], run[slot + 1 :]))
            at[k] = i // 3
        nodes = [digest(*run) for run in runs]
    return nodes[0], steps


def expected(data, tamper):
    groups = defaultdict(list)
    for row in data:
        groups[row[1]].append((row, leaf(row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, found = {}, []
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[name] = tree([h for _, h in groups[name]])
    root, over = tree([trees[n][0] for n in names])
    for name, above in zip(names, over):
        subroot, steps = trees[name]
        for (row, h), own in zip(groups[name], steps):
            now, siblings = leaf((*row[:4], tamper(row))), ""
            for left, right in own + above:
                now = digest(*left, now, *right)
                siblings += "".join(left + right)
            found.append((row[0], h, subroot, root, siblings, now, now == root))
    return sorted(found, key=str)


def tampered(row):
    return row[4].replace("\n", "") if row[4] is not None and row[0] is not None and row[0] % 2 == 0 else row[4]


def tampered_text():
    return F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))


def sample(seed, sizes):
    rng = random.Random(seed)
    data = []
    for source, n in sizes.items():
        for i in range(n):
            text = rng.choice([None, "", "É\nb", "a\n\nb" * 3, "plain", "-", "1:x"])
            data.append((rng.choice([None, i, i, i]), source, rng.choice([None, "en", ""]), rng.choice([None, -5, 10**12]), text))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize(("levels", "sizes"), [
    (1, {None: 4, "": 1, "a": 28, "É": 9, "Z": 3, "z": 2, "\U0001f600": 10}),
    (2, {"hot": 250, "b": 9, "c": 10, None: 82}),
    (6, {"one": 1}),
    (6, {"hot": 800, **{f"s{i}": 1 + i % 3 for i in range(40)}}),
])
def test_against_a_plain_tree(rows, levels, sizes):
    """Lone leaves, runs of one, nulls, repeated rows; bands that end below, at and above the root."""
    data = sample(levels, sizes)
    df = rows(SCHEMA + ", leaf string, place int", *[(*r, "old", 0) for r in data])
    got = sorted((tuple(r) for r in manifest.manifest(df, tampered_text(), levels).collect()), key=str)
    assert got == expected(data, tampered)


def test_untampered_rows_verify_and_a_changed_one_does_not(rows):
    data = sample(9, {"a": 40, "b": 5})
    df = rows(SCHEMA, *data)
    assert manifest.manifest(df).filter("not verified").count() == 0
    one = next(r[0] for r in data if r[0] is not None)
    changed = F.when(F.col("doc_id") == one, F.lit("other")).otherwise(F.col("text"))
    bad = manifest.manifest(df, changed).filter("not verified")
    assert {r["doc_id"] for r in bad.collect()} == {one}


def test_a_parent_resumes_the_state_of_the_slot():
    children = [digest(str(i)) for i in range(3)]
    parent = manifest.Parent(children)
    for slot in range(3):
        assert parent.fold(slot, children[slot]) == parent.digest == digest(*children)
        other = [*children[:slot], digest("x"), *children[slot + 1 :]]
        assert parent.fold(slot, digest("x")) == digest(*other)


def test_a_very_long_text_and_an_empty_table(rows):
    data = [(1, "a", "en", 5, "long \n" * 800_000), (2, "a", "en", 5, "b")]
    got = sorted(tuple(r) for r in manifest.manifest(rows(SCHEMA, *data), tampered_text()).collect())
    assert got == sorted(expected(data, tampered))
    assert manifest.manifest(rows(SCHEMA)).count() == 0
