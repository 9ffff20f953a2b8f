"""Merkle manifest of a dataset, with hash states kept inside the tree (operator 12).

The leaves of a source, in order, are the first level of a tree of three-way parents; the
subroots of the sources are the leaves of one more such tree. A parent keeps a copied hash state
before each child slot. Folding a changed leaf resumes the state of its slot, adds the
replacement and the siblings to the right, and goes on with the parent.

Trees are built in bands of some levels. A band cuts the nodes of every tree into blocks, each
the foot of one node above, so that tasks work on blocks of a bounded size and a source with
most of the rows is many blocks. What a leaf needs from the bands above its block are the
siblings on the way, which are the same for the whole block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from storelens.llm.common import ship, stored

ARITY = 3
# Levels of a band; a block has up to ARITY ** LEVELS nodes.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Siblings of one step: those to the left and those to the right, as hex texts put together.
Step = tuple[str, str]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(text: str | Column = "text") -> Column:
    """Digest of a row: each field as `-` if null, else byte count, colon, value."""
    parts = []
    for name in FIELDS:
        value = (F.col(text) if isinstance(text, str) else text) if name == "text" else F.col(name).cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def height(nodes: int) -> int:
    """Levels of parents above so many nodes; one node has none."""
    levels = 0
    while nodes > 1:
        nodes = -(-nodes // ARITY)
        levels += 1
    return levels


class Parent:
    """A node with the hash states before each of its children and what follows them."""

    def __init__(self, children: list[str]) -> None:
        self.children = children
        state = hashlib.sha256()
        self.states = []
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def step(self, slot: int) -> Step:
        return "".join(self.children[:slot]), "".join(self.children[slot + 1 :])

    def fold(self, slot: int, child: str) -> str:
        state = self.states[slot].copy()
        state.update(child.encode())
        state.update("".join(self.children[slot + 1 :]).encode())
        return state.hexdigest()


class Block:
    """The tree over the nodes of one block."""

    def __init__(self, nodes: list[str], levels: int) -> None:
        self.parents: list[list[Parent]] = []
        for _ in range(levels):
            row = [Parent(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            self.parents.append(row)
            nodes = [p.digest for p in row]
        (self.root,) = nodes

    def steps(self, place: int) -> list[Step]:
        found = []
        for row in self.parents:
            place, slot = divmod(place, ARITY)
            found.append(row[place].step(slot))
        return found

    def fold(self, place: int, node: str) -> str:
        for row in self.parents:
            place, slot = divmod(place, ARITY)
            node = row[place].fold(slot, node)
        return node


class Way:
    """The steps from a block to the root, with the hash state before the open slot of each."""

    def __init__(self, steps: list[Step]) -> None:
        self.siblings = "".join(left + right for left, right in steps)
        self.states = [(hashlib.sha256(left.encode()), right.encode()) for left, right in steps]

    def fold(self, node: str) -> str:
        for state, right in self.states:
            state = state.copy()
            state.update(node.encode())
            state.update(right)
            node = state.hexdigest()
        return node


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with `place`, from 0 by group in order, and `nodes`, the group's number of rows.

    Rows are sorted over the tasks; a task counts its own rows of a group and adds those of the
    tasks before it, so a large group is numbered by many tasks.
    """
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # An id is the task's number and, below 33 bits, the row's place in the task.
    placed = stored(ordered.withColumn("_id", F.monotonically_increasing_id()))
    task = F.shiftright("_id", 33)
    counts = placed.groupBy(F.col(group).alias("_group"), task.alias("_task")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first")
    )
    before = Window.partitionBy("_group").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    offsets = counts.select(
        "_group",
        "_task",
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("nodes"),
    )
    # Stored, so that the join may split or broadcast by size.
    offsets = stored(offsets)
    same = F.col(group).eqNullSafe(F.col("_group")) & (task == F.col("_task"))
    place = F.col("_id") - F.col("_first") + F.col("_before")
    return placed.join(offsets, same).withColumn("place", place).drop("_id", "_group", "_task", "_first", "_before")


def in_blocks(nodes: DataFrame, group: str, values: list[str], levels: int) -> DataFrame:
    """One row for each block: group, block, nodes, and `held` with the values by place."""
    width = ARITY**levels
    held = F.array_sort(F.collect_list(F.struct("place", *values)))
    block = F.floor(F.col("place") / width).cast("long").alias("block")
    return nodes.groupBy(group, block, "nodes").agg(held.alias("held"))


LONG, TEXT = T.LongType(), T.StringType()
STEPS = T.ArrayType(T.StructType([T.StructField("left", TEXT), T.StructField("right", TEXT)]))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _map(df: DataFrame, function, fields: list[T.StructField], rows: int = 16) -> DataFrame:
    """Rows that a function makes of each row, some rows at a time."""
    schema = T.StructType(fields)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                made = [x for r in batch.slice(at, rows).to_pylist() for x in function(r)]
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return df.mapInArrow(run, schema)


def _block(r: dict, band: int, levels: int) -> Block:
    """`nodes` is the number of leaves of the whole tree, of which earlier bands took some levels."""
    left = max(height(r["nodes"]) - band * levels, 0)
    return Block([h["digest"] for h in r["held"]], min(left, levels))


def ways(nodes: DataFrame, group: str, levels: int, band: int = 0) -> DataFrame:
    """Group, place, `steps` to the tree's root and `root`, for the nodes of a band.

    `nodes` has group, place, digest and `nodes`, the number of leaves of its tree. Each round
    goes up by one band, with fewer nodes by the size of a block, until every tree is one node.
    """
    key = next(f for f in nodes.schema.fields if f.name == group)
    held = stored(in_blocks(nodes, group, ["digest"], levels))

    def roots(r: dict) -> list[dict]:
        return [{group: r[group], "place": r["block"], "nodes": r["nodes"], "digest": _block(r, band, levels).root}]

    fields = [key, T.StructField("place", LONG), T.StructField("nodes", LONG), T.StructField("digest", TEXT)]
    above = stored(_map(held, roots, fields))
    if above.filter("place > 0").isEmpty():
        upper = above.select(F.col(group).alias("_group"), F.col("place").alias("_block"), F.array().cast(STEPS).alias("_steps"), F.col("digest").alias("root"))
    else:
        found = ways(above, group, levels, band + 1)
        upper = found.select(F.col(group).alias("_group"), F.col("place").alias("_block"), F.col("steps").alias("_steps"), "root")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block"))

    def down(r: dict) -> Iterator[dict]:
        block = _block(r, band, levels)
        rest = [(s["left"], s["right"]) for s in r["_steps"]]
        for i, h in enumerate(r["held"]):
            steps = [{"left": a, "right": b} for a, b in block.steps(i) + rest]
            yield {group: r[group], "place": h["place"], "steps": steps, "root": r["root"]}

    fields = [key, T.StructField("place", LONG), T.StructField("steps", STEPS), T.StructField("root", TEXT)]
    return stored(_map(held.join(upper, same), down, fields))


def manifest(documents: DataFrame, tampered_text: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, siblings, folded_root, verified of every document.

    `siblings` are the digests on the way to the root, level by level and left to right, put
    together. `tampered_text` is the text to verify in place of the original one: folded_root is
    made of its leaf and the original siblings, and verified says whether it is the root.

    The documents need the columns of FIELDS; others are left out. A null source is a source of
    its own and comes first; null ids come first in their source, and rows of one id by their
    leaf, so repeated rows are leaves beside each other. Without rows there is no root and no
    row. A task holds one block of digests and no text.
    """
    leaves = documents.select("doc_id", "source", leaf().alias("digest"), leaf(tampered_text if tampered_text is not None else "text").alias("other"))
    placed = numbered(leaves.withColumn("other", F.when(F.col("other") != F.col("digest"), F.col("other"))), "source", ["doc_id", "digest"])
    held = stored(in_blocks(placed, "source", ["doc_id", "digest", "other"], levels))

    # Roots of the first band's blocks, then the ways from them to their subroot.
    def roots(r: dict) -> list[dict]:
        return [{"source": r["source"], "place": r["block"], "nodes": r["nodes"], "digest": _block(r, 0, levels).root}]

    node = [T.StructField("source", TEXT), T.StructField("place", LONG), T.StructField("nodes", LONG), T.StructField("digest", TEXT)]
    above = stored(_map(held, roots, node))
    within = ways(above, "source", levels, band=1).withColumnRenamed("root", "subroot")

    # The sources' subroots are the leaves of one more tree.
    subroots = within.filter("place = 0").select("source", F.col("subroot").alias("digest"), F.lit(0).alias("tree"))
    ranked = numbered(subroots, "tree", ["source"])
    over = ways(ranked.select("tree", "place", "digest", "nodes"), "tree", levels).drop("tree")
    sources = ranked.select(F.col("source").alias("_source"), "place").join(over, "place")
    sources = stored(sources.select("_source", F.col("steps").alias("_over"), "root"))
    joined = within.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_source", F.col("place").alias("_block"), F.concat("steps", "_over").alias("_steps"), "subroot", "root"
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))

    def fold(r: dict) -> Iterator[dict]:
        block = _block(r, 0, levels)
        way = Way([(s["left"], s["right"]) for s in r["_steps"]])
        for i, h in enumerate(r["held"]):
            folded = way.fold(block.fold(i, h["other"] or h["digest"]))
            own = "".join(left + right for left, right in block.steps(i))
            yield {
                "doc_id": h["doc_id"],
                "leaf": h["digest"],
                "subroot": r["subroot"],
                "root": r["root"],
                "siblings": own + way.siblings,
                "folded_root": folded,
                "verified": folded == r["root"],
            }

    text = [T.StructField(name, TEXT) for name in ("leaf", "subroot", "root", "siblings", "folded_root")]
    return _map(held.join(joined, same), fold, [T.StructField("doc_id", LONG), *text, T.StructField("verified", T.BooleanType())], rows=4)
