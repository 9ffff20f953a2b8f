from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import lm
from storelens.llm.common import fold, table


def small_model():
    rng = np.random.default_rng(3)
    counts = np.r_[50.0, rng.integers(1, 90, 200)]
    return lm.Model({k: w.astype(np.float64) for k, w in lm.start_weights(counts, 30.0).items()})


def test_gradients(monkeypatch):
    model = small_model()
    rng = np.random.default_rng(4)
    inputs = rng.integers(0, 200, (5, 3))
    target = np.where(rng.random((5, 3)) < 0.2, lm.COMMON + 3, rng.integers(0, 200, (5, 3)))
    target[4, 2] = -1
    keep = np.ones((5, 3, 1))
    keep[0] = keep[3, 1] = 0
    state = rng.normal(size=(3, lm.HIDDEN)) * keep[0]
    monkeypatch.setattr(np, "empty", lambda shape, dtype=float: np.zeros(shape))
    grads, _ = model.gradients(inputs, target, keep, state)

    def value():
        return model.outputs(model.run(inputs, keep, state)[0], target, False)[0].sum()

    for name in lm.NAMES:
        flat, gradient = model.w[name].reshape(-1), grads[name].reshape(-1)
        for i in [*np.argsort(-np.abs(gradient))[:3], rng.integers(len(flat))]:
            old = flat[i]
            flat[i] = old + 1e-5
            up = value()
            flat[i] = old - 1e-5
            down = value()
            flat[i] = old
            assert abs((up - down) / 2e-5 - gradient[i]) < 1e-4 * max(1, abs(gradient[i])), (name, i)


def test_probabilities_sum_to_one():
    model = small_model()
    state = np.random.default_rng(1).normal(size=(1, 1, lm.HIDDEN))
    every = np.arange(lm.COMMON + 1)[:, None]
    logp, _, _ = model.outputs(np.repeat(state, len(every), axis=0), every, False)
    assert abs(np.exp(logp).sum() - 1) < 1e-6


def test_streams_hold_each_document_once_and_state_crosses_windows():
    rng = np.random.default_rng(5)
    documents = [rng.integers(1, 100, n).astype(np.int32) for n in (1, 70, 3, 16, 200, 5)]
    found = {d: [] for d in range(6)}
    for inputs, target, document, keep in lm.Streams(documents).windows():
        for t, s in zip(*np.nonzero(target >= 0)):
            found[document[t, s]].append(target[t, s])
    assert all(found[d] == documents[d].tolist() for d in found)
    model = small_model()
    together = model.score(documents)
    alone = np.concatenate([model.score([d]) for d in documents])
    assert np.allclose(together, alone, rtol=1e-4)


def test_step_touches_only_what_a_window_has():
    model, dense = small_model(), small_model()
    rng = np.random.default_rng(6)
    inputs, target = rng.integers(0, 9, (6, 4)), rng.integers(0, lm.CLASS_WORDS, (6, 4))
    target[5, 3] = -1
    keep, state = np.ones((6, 4, 1)), np.zeros((4, lm.HIDDEN))
    parts, _ = model.parts(inputs, target, keep, state, 1.0)
    places = {(name, str(place)) for name, place, _ in parts if name == "word"}
    assert len(places) == 1 and sum(part.size for _, _, part in parts) < model.joint["word"].size / 10
    grads, _ = dense.gradients(inputs, target, keep, state)
    model.learn(inputs, target, keep, state)
    for name in lm.NAMES:
        step = np.clip(grads[name] / 23, -1, 1)
        want = dense.w[name] + lm.RATE * step / np.sqrt(1e-6 + step * step)
        assert np.allclose(model.w[name], want, rtol=1e-4, atol=1e-6), name
    assert np.array_equal(model.w["word_w"][:, lm.CLASS_WORDS :], dense.w["word_w"][:, lm.CLASS_WORDS :])


def test_probabilities_of_logits_whose_exponentials_overflow():
    model = lm.Model({k: w.astype(np.float32) for k, w in small_model().w.items()})
    target = np.array([[1, 70, lm.COMMON + 3]])
    states = np.random.default_rng(8).normal(size=(1, 3, lm.HIDDEN)).astype(np.float32)
    want, _, _ = model.outputs(states, target, 0)
    for shift in (300, -300):
        model.w["word_b"][:] += shift
        model.w["class_b"][:] -= shift
        got, parts, back = model.outputs(states, target, 1.0)
        assert np.allclose(got, want, atol=1e-3)
        assert np.isfinite(back).all() and all(np.isfinite(part).all() for _, _, part in parts)
        model.w["word_b"][:] -= shift
        model.w["class_b"][:] += shift


@pytest.fixture(scope="module")
def scored(spark):
    documents = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    held_out = fold("doc_id", 7) == 2
    return documents.collect(), lm.score_documents(documents, ~held_out).collect()


def test_base_scores_by_brute_force(scored):
    documents, got = scored
    split = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), b""] for r in documents}
    learnt = [w for i, own in split.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in own]
    counts, n = Counter(learnt), len(learnt)
    assert len(got) == len(split)
    for row in got:
        own = split[row["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in own)
        assert row["n_tokens"] == len(own) and row["n_known"] == sum(w in counts for w in own)
        assert row["train_tokens"] == n and abs(row["base_score"] - base) < 1e-6 * abs(base)


def test_held_out_documents_are_likelier_than_by_counts(scored):
    _, got = scored
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
    tokens = sum(r["n_tokens"] for r in held)
    assert sum(r["score"] for r in held) / tokens > sum(r["base_score"] for r in held) / tokens + 0.05
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_defined_cases(rows):
    df = rows("doc_id bigint, text string, score string", (1, "A b", "x"), (1, "A b", "x"), (2, None, "x"), (None, "zz b", "x"))
    got = lm.score_documents(df, F.coalesce(F.col("doc_id") == 1, F.lit(False))).collect()
    base = {"b": 3, "a": 3, "": 3, "zz": 1}
    want = sorted(sum(math.log10(base[w] / 10) for w in own) for own in (["a", "b", ""], ["a", "b", ""], [""], ["zz", "b", ""]))
    assert np.allclose(sorted(r["base_score"] for r in got), want)
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == [(1, 1, 6), (3, 2, 6), (3, 3, 6), (3, 3, 6)]
    nothing = lm.score_documents(df, F.lit(False)).collect()
    assert len(nothing) == 4 and all(r["n_known"] == 0 and r["base_score"] == 0 for r in nothing)
    assert lm.score_documents(df.limit(0), F.lit(True)).count() == 0


def test_vocabulary_and_classes_follow_the_training_words(rows):
    often, rare = [f"w{i}" for i in range(3000)], [f"é{i}" for i in range(9000)]
    counts = rows("word string, n bigint", ("", 5), *((w, 12 + i % 50) for i, w in enumerate(often)), *((w, 1) for w in rare))
    top = lm.common_words(counts, 100_000)
    assert {w for w, _ in top} == set(often) and [n for _, n in top] == sorted((n for _, n in top), reverse=True)
    tokens, kinds = lm.rare_sums(counts, top, 12_001)
    want = Counter(zlib.crc32(w.encode()[-3:]) % len(kinds) for w in rare)
    assert len(kinds) == 128 and kinds.tolist() == tokens.tolist() == [want[k] for k in range(128)]
    model = lm.Model(lm.start_weights(np.array([5, *(n for _, n in top)]), tokens), 3001)
    words = lm.Vocabulary([w.encode() for w, _ in top], 3001, 128)
    assert len({words[w.encode()] for w in often}) == 3000 and len({words[w.encode()] for w in rare}) == len(want)
    every = np.arange(3001 + 128)[:, None]
    state = np.random.default_rng(1).normal(size=(1, 1, lm.HIDDEN)).repeat(len(every), axis=0)
    logp, _, _ = model.outputs(state, every, False)
    assert abs(np.exp(logp).sum() - 1) < 1e-5 and len(model.bounds) > 31
    again = lm.unpack_weights(lm.pack_weights(model.w), 3001, 128)
    assert all(np.array_equal(again[name], model.w[name]) for name in lm.NAMES)
    few = lm.common_words(counts.filter("n < 20"), 100_000)
    assert len(few) == lm.COMMON - 1
