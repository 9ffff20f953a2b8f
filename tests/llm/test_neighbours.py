from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from storelens.llm import neighbours
from storelens.llm.common import table


def brute(ids, vectors, every, k):
    out = {}
    for i, own in zip(ids, vectors):
        if i % every == 0:
            far = sorted((float(np.sqrt(((v - own) ** 2).sum())), j) for j, v in zip(ids, vectors) if j != i)
            out[i] = far[:k]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def test_recall_on_the_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    data = df.orderBy("vec_id").collect()
    want = brute([r["vec_id"] for r in data], np.array([r["embedding"] for r in data], dtype=np.float64), 100, 10)
    for shard_rows in (neighbours.SHARD_ROWS, 300):
        got = grouped(neighbours.nearest(df, shard_rows=shard_rows).collect())
        assert got.keys() == want.keys()
        hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
        assert hits >= 0.95 * 10 * len(want)
        assert all(own == sorted(own) for own in got.values())


def test_copies_ties_and_unusable_vectors(rows):
    nan, inf = float("nan"), float("inf")
    data = [(i, [1.0, float(i % 3)]) for i in range(40)]
    data += [(100, None), (200, [0.0, 0.0]), (300, [nan, 1.0]), (400, [inf, 1.0]), (500, [None, 1.0]), (600, [])]
    data += [(None, [1.0, 1.0]), (40, [1.0, 0.0]), (40, [1.0, 0.0]), (700, [1.0, 2.0, 3.0])]
    df = rows("vec_id bigint, embedding array<float>, rank string", *[(*x, "old") for x in data])
    got = grouped(neighbours.nearest(df, every=10, shard_rows=8).collect())
    ids = [*range(41)]
    vectors = np.array([[1.0, float(i % 3) if i < 40 else 0.0] for i in ids])
    assert got == brute(ids, vectors, 10, 10)


def test_fewer_candidates_and_empty(rows):
    df = rows("vec_id bigint, embedding array<float>", (0, [1.0]), (7, [3.0]))
    assert [tuple(r) for r in neighbours.nearest(df).collect()] == [(0, 1, 7, 2.0)]
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.filter(F.col("vec_id") == 0)).count() == 0


def test_stored_graph_is_the_built_one():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(400, 8))
    graph = neighbours.Graph(vectors, neighbours.node_levels(np.arange(400)))
    for k in range(400):
        graph.insert(k)
    again = neighbours.Graph.from_flat(vectors, graph.level, *graph.flat())
    assert again.near == graph.near and again.enter == graph.enter
    reached, ahead = {graph.enter}, [graph.enter]
    while ahead:
        new = [x for x in graph.near[ahead.pop()][0] if x not in reached]
        reached.update(new)
        ahead += new
    assert len(reached) > 390
