from __future__ import annotations

import zlib

import numpy as np

from storelens.llm import quality
from storelens.llm.common import table


def test_dual_descent_reaches_the_optimum():
    """Primal value by subgradient descent on a tiny problem is not below the dual solution's."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 8, 4)) for _ in range(30)]
    values = [np.ones(len(r)) for r in rows]
    sign = np.array([1.0 if 0 in r else -1.0 for r in rows])

    def primal(w, b):
        hinge = sum(max(0, 1 - s * (w[r] @ v + b)) for r, v, s in zip(rows, values, sign))
        return (w @ w + b * b) / 2 + hinge

    w, b = quality._descend(rows, values, sign, 1.0, 500)
    best = primal(w, b)
    for _ in range(300):
        assert primal(w + rng.normal(0, 0.02, len(w)) * (np.arange(len(w)) < 8), b + rng.normal(0, 0.02)) >= best - 1e-6


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    scored = quality.quality_scores(table(spark, folder, "documents"), labels)
    rows = scored.drop("quality").join(labels, "doc_id").select("doc_id", "score", "predicted", "quality").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    good = [r["predicted"] for r in held if r["quality"] == 1]
    bad = [r["predicted"] for r in held if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_defined_cases(rows):
    labels = rows("doc_id bigint, quality int, toxic int", (1, 1, 0), (3, 0, 0), (3, 1, 0), (4, None, 0), (None, 1, 0), (1, 1, 1))
    df = rows("doc_id bigint, text string, score string", (1, "good", "old"), (3, None, "old"), (None, "", "old"), (1, "good", "x"))
    got = quality.quality_scores(df, labels).collect()
    assert len(got) == 4 and all(r["score"] > 0.99 for r in got)
    assert quality.quality_scores(df, labels.limit(0)).agg({"score": "max"}).first()[0] == 0.5
    assert quality.quality_scores(df.limit(0), labels).count() == 0
