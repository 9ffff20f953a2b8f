"""Approximate nearest neighbours by hierarchical navigable small-world graphs (operator 3).

Rows are dealt into shards by a hash of their id. Each shard builds its own graph and is stored
as one row of flat arrays: vectors, node levels, neighbour lists and where they begin. Blocks
of queries meet every shard, and the shards' nearest are merged.

Within a shard, rows with equal vectors are one node, so that many copies do not crowd out the
paths to the rest; the node lists all of its ids.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush, heapreplace
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.common import mix, ship, stored

NEAREST = 10
SHARD_ROWS = 4096
QUERY_BLOCK = 1024
# Neighbours of a node on upper levels (twice as many on the lowest), and nodes that a search keeps.
LINKS = 12
BUILD_WIDTH, SEARCH_WIDTH = 64, 192
SHARD = (
    "shard int, dim int, vectors binary, node_ids array<array<bigint>>, level array<int>, "
    "first array<bigint>, neighbours array<int>"
)
FOUND = "query_id bigint, vec_id bigint, score double"


class Graph:
    """Levels of a navigable graph over the rows of a matrix; level 0 has all nodes."""

    def __init__(self, vectors: np.ndarray, level: np.ndarray, links: int = LINKS) -> None:
        self.vectors = vectors
        self.square = np.einsum("ij,ij->i", vectors, vectors)
        self.level = level
        self.links = links
        self.near: list[list[list[int]]] = [[[] for _ in range(top + 1)] for top in level.tolist()]
        self.enter = -1

    def distances(self, query: np.ndarray, nodes: list[int]) -> list[float]:
        """Squared distances, but for the query's own square."""
        return (self.square[nodes] - 2.0 * (self.vectors[nodes] @ query)).tolist()

    def search(self, query: np.ndarray, start: list[tuple[float, int]], level: int, width: int) -> list[tuple[float, int]]:
        """The nearest nodes found from some start, at most `width`, in no order."""
        seen = {node for _, node in start}
        ahead = list(start)
        heapify(ahead)
        best = [(-d, node) for d, node in start]
        heapify(best)
        while ahead:
            distance, node = heappop(ahead)
            if len(best) >= width and distance > -best[0][0]:
                break
            new = [x for x in self.near[node][level] if x not in seen]
            if not new:
                continue
            seen.update(new)
            for d, x in zip(self.distances(query, new), new):
                if len(best) < width:
                    heappush(best, (-d, x))
                    heappush(ahead, (d, x))
                elif d < -best[0][0]:
                    heapreplace(best, (-d, x))
                    heappush(ahead, (d, x))
        return [(-d, x) for d, x in best]

    def choose(self, node: int, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in several directions: one that is nearer to a chosen one waits for room."""
        order = [x for _, x in sorted(found)]
        if len(order) <= most:
            return order
        own = self.vectors[order]
        between = self.square[order][:, None] + self.square[order][None, :] - 2.0 * (own @ own.T)
        away = self.square[order] - 2.0 * (own @ self.vectors[node]) + self.square[node]
        chosen: list[int] = []
        nearest = np.full(len(order), np.inf)
        for i in range(len(order)):
            if nearest[i] >= away[i]:
                chosen.append(i)
                np.minimum(nearest, between[i], out=nearest)
                if len(chosen) == most:
                    break
        taken = set(chosen)
        chosen += [i for i in range(len(order)) if i not in taken][: most - len(chosen)]
        return [order[i] for i in chosen]

    def descend(self, query: np.ndarray, level: int) -> list[tuple[float, int]]:
        """Where a greedy walk from the top arrives above a level."""
        at = [(self.distances(query, [self.enter])[0], self.enter)]
        for upper in range(int(self.level[self.enter]), level, -1):
            at = [min(self.search(query, at, upper, 1))]
        return at

    def insert(self, node: int, width: int = BUILD_WIDTH) -> None:
        if self.enter < 0:
            self.enter = node
            return
        query, top = self.vectors[node], int(self.level[self.enter])
        at = self.descend(query, min(int(self.level[node]), top))
        for level in range(min(int(self.level[node]), top), -1, -1):
            at = self.search(query, at, level, width)
            most = self.links * 2 if level == 0 else self.links
            self.near[node][level] = self.choose(node, at, self.links)
            for other in self.near[node][level]:
                own = self.near[other][level]
                own.append(node)
                if len(own) > most:
                    self.near[other][level] = self.choose(
                        other, list(zip(self.distances(self.vectors[other], own), own)), most
                    )
        if self.level[node] > top:
            self.enter = node

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """All neighbour lists, one after another, by node and level; and where each begins."""
        lists = [own for node in self.near for own in node]
        first = np.cumsum([0, *map(len, lists)])
        return first, np.array([x for own in lists for x in own], dtype=np.int32)

    @classmethod
    def from_flat(cls, vectors: np.ndarray, level: np.ndarray, first: np.ndarray, neighbours: np.ndarray) -> Graph:
        graph = cls(vectors, level)
        bounds, values, at = first.tolist(), neighbours.tolist(), 0
        for node in graph.near:
            for k in range(len(node)):
                node[k] = values[bounds[at] : bounds[at + 1]]
                at += 1
        graph.enter = int(level.argmax()) if len(level) else -1
        return graph


def node_levels(ids: np.ndarray, links: int = LINKS) -> np.ndarray:
    """Geometrically rarer levels, from a hash of the id."""
    share = (mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64)
    return np.floor(-np.log((share + 1.0) / 2.0**53) / np.log(links)).astype(np.int32)


def build_shard(rows: pa.Table) -> pa.Table:
    """The stored form of one shard, whose rows have _shard, vec_id and _vector."""
    rows = rows.sort_by("vec_id")
    ids = rows["vec_id"].to_numpy()
    width = len(rows["_vector"][0])
    matrix = rows["_vector"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    _, head, node = np.unique(matrix, axis=0, return_index=True, return_inverse=True)
    order = np.argsort(head)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    head, node = head[order], rank[node.ravel()]
    level = node_levels(ids[head])
    vectors = matrix[head].astype(np.float64)
    graph = Graph(vectors, level)
    for k in range(len(head)):
        graph.insert(k)
    # The search enters at the first node of the highest level, as the build did.
    first, neighbours = graph.flat()
    held: list[list[int]] = [[] for _ in head]
    for row, own in zip(ids.tolist(), node.tolist()):
        held[own].append(row)
    return pa.table(
        {
            "shard": pa.array([rows["_shard"][0].as_py()], pa.int32()),
            "dim": pa.array([width], pa.int32()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "node_ids": pa.array([held], pa.list_(pa.list_(pa.int64()))),
            "level": pa.array([level.tolist()], pa.list_(pa.int32())),
            "first": pa.array([first.tolist()], pa.list_(pa.int64())),
            "neighbours": pa.array([neighbours.tolist()], pa.list_(pa.int32())),
        }
    )


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard of the vectors (vec_id, _vector); written to shared files."""
    ship(vectors.sparkSession)
    shards = max(ceil(vectors.count() / shard_rows), 1)
    dealt = vectors.withColumn("_shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    dealt = dealt.select("_shard", F.size("_vector").alias("_dim"), "vec_id", "_vector")
    return stored(dealt.groupBy("_shard", "_dim").applyInArrow(build_shard, SHARD))


def search_shard(pair: pa.Table, k: int, width: int) -> pa.Table:
    """The k nearest of one shard for each query of one block."""
    row = pair.to_pylist()[0]
    vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
    graph = Graph.from_flat(
        vectors, np.array(row["level"], np.int32), np.array(row["first"]), np.array(row["neighbours"])
    )
    out: list[tuple[int, int, float]] = []
    for asked in row["queries"]:
        if len(asked["_vector"]) != row["dim"]:
            continue
        query, own = np.array(asked["_vector"]), asked["query_id"]
        nodes = [node for _, node in graph.search(query, graph.descend(query, 0), 0, width)]
        scores = np.sqrt(((vectors[nodes] - query) ** 2).sum(axis=1)).tolist()
        found = [(d, other) for d, node in zip(scores, nodes) for other in row["node_ids"][node] if other != own]
        out += [(own, other, d) for d, other in sorted(found)[:k]]
    ids, others, scores = zip(*out) if out else ((), (), ())
    return pa.table(
        {"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(others, pa.int64()), "score": pa.array(scores, pa.float64())}
    )


def nearest(
    embeddings: DataFrame, every: int = 100, k: int = NEAREST, shard_rows: int = SHARD_ROWS, width: int = SEARCH_WIDTH
) -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id divisible by `every`, the k nearest other rows found.

    Score is the Euclidean distance of the original vectors in double precision; ties go to the
    smaller vec_id. Rows with a null id, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part. Rows that repeat an id are one row (the least vector).
    Vectors of different lengths are never compared.
    """
    ship(embeddings.sparkSession)
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    known = embeddings.filter(F.col("vec_id").isNotNull()).select("vec_id", doubles.alias("_vector"))
    known = stored(known.filter(usable(F.col("_vector"))).groupBy("vec_id").agg(F.min("_vector").alias("_vector")))
    index = build_index(known, shard_rows)
    queries = known.filter(F.col("vec_id") % every == 0)
    blocks = max(ceil(queries.count() / QUERY_BLOCK), 1)
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int")
    asked = queries.groupBy(block.alias("block")).agg(
        F.collect_list(F.struct(F.col("vec_id").alias("query_id"), "_vector")).alias("queries")
    )
    meetings = index.select("shard").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    paired = meetings.join(asked, "block").join(index, "shard")
    found = paired.groupBy("shard", "dim", "block").applyInArrow(lambda pair: search_shard(pair, k, width), FOUND)
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
