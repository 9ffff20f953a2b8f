from __future__ import annotations

import random

import pytest
from brute import kept_words, words

from storelens.llm import passages


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ß-x", " ", "\x1c"]
    shared = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(4)]
    out = [None, "", "one", "a b c", " \t lead and  trail \n"]
    for _ in range(40):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 25)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), "\n".join(rng.choices(vocabulary, k=rng.randint(0, 9)))]
        out.append("  ".join(parts))
    out += ["the same " * 200, "x " * 300, out[-1]]
    return out


@pytest.mark.parametrize("width, hot", [(7, 1000), (7, 2), (3, 1), (1, 3), (50, 1)])
def test_against_brute_force(rows, width, hot):
    data = texts()
    df = rows("doc_id bigint, text string, n_words string", *[(i % 30, t, "old") for i, t in enumerate(data)])
    got = passages.remove_repeats(df, width, hot).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    kept = kept_words(data, width)
    want = [(i % 30, len(words(t)), len(words(t)) - len(k), " ".join(k)) for i, (t, k) in enumerate(zip(data, kept))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_repeated_rows_and_null_ids_repeat_each_other(rows):
    text = " ".join(f"t{i}" for i in range(40))
    got = passages.remove_repeats(rows("doc_id bigint, text string", (None, text), (None, text), (3, "t1 t2"))).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in got) == [(2, 0), (40, 40), (40, 40)]


def test_empty(rows):
    assert passages.remove_repeats(rows("doc_id bigint, text string")).count() == 0


def test_text_of_a_super_kmer_moves_only_where_others_differ(rows, monkeypatch):
    """Copies need no text to be known as repeated; super-k-mers that only share a minimiser do."""
    rng = random.Random(9)
    copy = " ".join(f"c{rng.randint(0, 10**6)}" for _ in range(120))
    mixed = [f"m{rng.randint(0, 10**6)}" for _ in range(60)]
    data = [copy, copy, copy, " ".join(mixed), " ".join(["other", *mixed, "end"]), " ".join(f"a{i}" for i in range(60))]
    df = rows("doc_id bigint, text string", *enumerate(data)).coalesce(1)
    shuffled = []
    add = passages.stored
    monkeypatch.setattr(passages, "stored", lambda df: shuffled.append(add(df)) or shuffled[-1])
    spans = passages.repeated_spans(df)
    assert {r["_k1"] for r in spans.collect()} == {0, 1, 2, 3, 4}
    (chosen,) = shuffled
    found = {r["_k1"]: r for r in chosen.collect()}
    assert set(found) == {0, 1, 2, 3, 4}
    assert all(not found[i]["lows"] and found[i]["spans"] for i in (0, 1, 2)) and all(found[i]["lows"] for i in (3, 4))
    kept = kept_words(data, passages.WIDTH)
    got = {r["doc_id"]: r["kept_text"] for r in passages.remove_repeats(df).collect()}
    assert got == {i: " ".join(k) for i, k in enumerate(kept)}
