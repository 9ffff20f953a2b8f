from __future__ import annotations

import random

import pytest
from brute import components, shingles

from storelens.llm import near


def texts():
    rng = random.Random(9)
    out = [None, "", " ", "one", "One", "two words", "three little words"]
    for _ in range(6):
        base = [f"w{rng.randint(0, 900)}" for _ in range(120)]
        out.append(" ".join(base))
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 9)}"
            out.append(" ".join(copy))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("size, percent, small", [(3, 85, 64), (5, 80, 64), (5, 80, 1), (1, 60, 2)])
def test_against_brute_force(rows, monkeypatch, size, percent, small):
    monkeypatch.setattr(near, "SMALL", small)
    data = texts()
    df = rows("doc_id bigint, text string, kept string", *[(i, t, "old") for i, t in enumerate(data)])
    got = {r["doc_id"]: r for r in near.mark_near_copies(df, size, percent).collect()}
    want = components(data, size, percent)
    assert [got[i]["component_id"] for i in range(len(data))] == want
    assert [got[i]["kept"] for i in range(len(data))] == [w == i for i, w in enumerate(want)]
    assert [got[i]["n_shingles"] for i in range(len(data))] == [len(shingles(t, size)) for t in data]


def test_shingles_that_others_outside_the_large_bucket_share_still_count(rows, monkeypatch):
    """A set of a large bucket may be near to one that shares a small bucket with it only."""
    monkeypatch.setattr(near, "SMALL", 3)
    base = [f"w{i}" for i in range(100)]
    data = [" ".join(base[: 100 - 2 * k] + [f"x{k}_{i}" for i in range(2 * k)]) for k in range(9)]
    data += [" ".join(f"x{k}_{i}" if i < 2 * k else f"y{k}_{i}" for i in range(2 * k + 3)) for k in range(9)]
    data += [d + " end" for d in data]
    got = near.mark_near_copies(rows("doc_id bigint, text string", *enumerate(data)), 1, 85).collect()
    assert [r["component_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == components(data, 1, 85)


def test_null_and_repeated_ids(rows):
    text = " ".join(f"t{i}" for i in range(30))
    df = rows("doc_id bigint, text string", (None, text), (7, text), (7, text), (3, "a b c d e f"), (3, text + " u"))
    got = near.mark_near_copies(df).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in got) == [
        ("3", 3, True),
        ("3", 3, True),
        ("7", 3, False),
        ("7", 3, False),
        ("None", 3, False),
    ]


def test_long_chain_is_one_component(spark):
    links = spark.range(200).selectExpr("cast(lpad(string(id), 4, '0') as binary) a", "cast(lpad(string(id + 1), 4, '0') as binary) b")
    got = near.components(links).collect()
    assert len(got) == 200 and {bytes(r["_group"]) for r in got} == {b"0000"}


def test_empty(rows):
    assert near.mark_near_copies(rows("doc_id bigint, text string")).count() == 0


def test_signatures_are_circular():
    import numpy as np

    values = np.arange(50, dtype=np.uint64)
    whole = near.signatures(values, np.array([50]), 8)
    assert whole.shape == (1, 8) and len(set(whole[0].tolist())) > 4
    assert (near.signatures(values, np.array([20, 0, 30]), 8).min(axis=0) == whole[0]).all()


@pytest.mark.parametrize("pivots", [1, 2])
def test_texts_of_one_long_passage_are_hardly_compared(rows, monkeypatch, pivots):
    """A passage brings them into one bucket, though no two are near but for a few planted ones."""
    rng, compared, linked = random.Random(3), [], near.linked

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return linked(pairs, sets, percent)

    monkeypatch.setattr(near, "linked", counted)
    monkeypatch.setattr(near, "PIVOTS", pivots)
    passage = [f"p{i}" for i in range(80)]
    data = [" ".join(passage + [f"r{rng.randint(0, 400)}" for _ in range(60)]) for _ in range(150)]
    data += [f"{data[3]} end", f"{data[90]} end", f"{data[90]} other end"]
    df = rows("doc_id bigint, text string", *enumerate(data))
    got = near.mark_near_copies(df, 3, 85, bands=12, rows=1).collect()
    assert [r["component_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == components(data, 3, 85)
    assert sum(compared) < 5 * len(data)


def test_sets_too_small_to_be_similar_to_others(rows):
    data = ["a b c d", "a b f e", "a b c d", "a b c d e"]
    got = near.mark_near_copies(rows("doc_id bigint, text string", *enumerate(data)), 1, 80, rows=1).collect()
    assert [r["component_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == components(data, 1, 80) == [0, 1, 0, 0]
