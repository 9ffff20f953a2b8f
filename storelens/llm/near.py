"""Near-duplicate detection by circulant MinHash (operator 7).

A document is its set of word shingles. Two permutations make all signature coordinates: the
first scatters the shingles, the second is applied after a circular shift by the number of the
coordinate. Signatures are cut into bands; documents that share a band are candidates, and
candidates are linked if their full sets are similar enough.

Equal sets are one candidate. In a band's bucket, all are first compared with a pivot (more rounds
take pivots of other groups); a bucket of n copies of one text takes about n comparisons. In
large buckets, shingles that no other candidate there has are counted first: the set with fewest
is the pivot, and sets with many can be near to nothing. Then members of the groups that are
still apart meet by their rarest shingles; comparisons within a group could not change the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import LOWER, WordHashes, add_columns, mix, row_key, ship, slices, stored, word_bounds

# A pair of similarity 0.85 shares no band with a probability of 4e-7; of 0.8, 2e-5.
BANDS, ROWS = 20, 4
# Members of a bucket up to which shingles are not counted.
SMALL = 16
# Rounds in which all members of a bucket meet one pivot.
PIVOTS = 1


def shingle_sets(texts: list[str | None], size: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of all texts, one text after another, and their counts."""
    data = LOWER[np.frombuffer(b"\n".join((text or "").encode() for text in texts), dtype=np.uint8)]
    start, end = word_bounds(data)
    word = hashes(data, start, end)
    first_byte = np.cumsum([0, *(len((text or "").encode()) + 1 for text in texts)])[:-1]
    owner = np.searchsorted(first_byte, start, side="right") - 1
    count = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(count)
    value = np.zeros(len(word), dtype=np.uint64)
    for k in range(size):
        # A document of fewer words has one shingle, of all its words.
        shifted = np.concatenate((word[k:], np.zeros(min(k, len(word)), np.uint64)))
        value = np.where(np.arange(len(word)) + k < ends[owner], mix(value + shifted + np.uint64(k + 1)), value)
    at = np.arange(len(word)) - (ends - count)[owner]
    whole = at <= np.maximum(count[owner] - size, 0)
    owner, value = owner[whole], value[whole]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts))


def _second(x: np.ndarray) -> np.ndarray:
    """The permutation of 32-bit numbers that follows the circular shift; works in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(values: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Row of coordinates for each non-empty set."""
    scattered = mix(values ^ np.uint64(0x6A09E667F3BCC909)).astype(np.uint32)
    filled = counts > 0
    heads = (np.cumsum(counts) - counts)[filled]
    out = np.zeros((len(heads), size), dtype=np.uint32)
    if len(heads):
        for k in range(size):
            out[:, k] = np.minimum.reduceat(_second(scattered + np.uint32(k)), heads)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band, which holds the band's number too."""
    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * rows + r])
        keys[:, b] = key
    return keys.view(np.int64)


def _prints(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """128 bits of each set: two sums of mixed shingles, and so the same for equal sets."""
    sums = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mix(values ^ np.uint64(seed)), out=total[1:])
        end = np.cumsum(counts)
        sums.append(mix(total[end] - total[end - counts]))
    return [x.tobytes() for x in np.stack(sums, axis=1)]


class Shingled:
    """How texts become sets; the same for every step."""

    def __init__(self, size: int, bands: int, rows: int) -> None:
        self.size, self.bands, self.rows = size, bands, rows

    def columns(self, df: DataFrame) -> DataFrame:
        """Adds _set (print of the set), n_shingles and _bands (keys)."""

        def both(batch: pa.RecordBatch) -> list[pa.Array]:
            values, counts = shingle_sets(batch["text"].to_pylist(), self.size, WordHashes())
            keys = band_keys(signatures(values, counts, self.bands * self.rows), self.bands, self.rows)
            offsets = np.concatenate(([0], np.cumsum(np.where(counts > 0, self.bands, 0)))).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
            return [pa.array(_prints(values, counts), pa.binary()), pa.array(counts, pa.int64()), listed]

        fields = [
            T.StructField("_set", T.BinaryType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("_bands", T.ArrayType(T.LongType())),
        ]
        return add_columns(df, fields, both)

    def values(self, df: DataFrame) -> DataFrame:
        """Adds _values, the sorted shingles as bytes."""

        def one(batch: pa.RecordBatch) -> list[pa.Array]:
            values, counts = shingle_sets(batch["text"].to_pylist(), self.size, WordHashes())
            return [pa.array([x.tobytes() for x in np.split(values, np.cumsum(counts)[:-1])], pa.binary())]

        return add_columns(df, [T.StructField("_values", T.BinaryType())], one)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b|, for sorted distinct values."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    left = sets.select(F.col("_set").alias("a"), F.col("_values").alias("va"))
    right = sets.select(F.col("_set").alias("b"), F.col("_values").alias("vb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            va, vb = batch["va"].to_pylist(), batch["vb"].to_pylist()
            good = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(va, vb)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb")
    return joined.mapInArrow(check, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """Every end of a link (a, b) with the smallest end that it reaches: _set, _group.

    Alternates large-star and small-star steps until nothing changes, so long chains shrink in
    logarithmically many rounds; a node's neighbours are never gathered, only their minimum.
    """
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    edges = stored(links.select(*pair).filter("a <> b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(large.filter("a <> b"))
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b")))
        edges = stored(small.filter("a <> b").distinct())
        # Done when no end above is an end below: every node then names its smallest.
        if edges.select("b").join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return edges.groupBy("a").agg(F.min("b").alias("_group")).withColumnRenamed("a", "_set")


def met_shingles(held: DataFrame) -> DataFrame:
    """A row (shingle, h1, h2, n) for every shingle of every set; h1 and h2 are the set's print."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values = [np.frombuffer(v, np.int64) for v in part["_values"].to_pylist()]
                sizes = np.array([len(v) for v in values])
                halves = np.frombuffer(b"".join(part["_set"].to_pylist()), ">i8").astype(np.int64).reshape(-1, 2)
                columns = [np.concatenate(values), *np.repeat(halves, sizes, axis=0).T, np.repeat(sizes, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "h1", "h2", "n"])

    return held.select("_set", "_values").mapInArrow(explode, "shingle long, h1 long, h2 long, n long")


def _print_of(h1: str, h2: str) -> Column:
    """The print of a set from its halves."""
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (h1, h2)]))


def lonely_shingles(held: DataFrame) -> DataFrame:
    """Number of shingles of each set that no other of the sets has: _set, u (none if 0)."""
    # Of one row, the exclusive or is the row itself.
    once = met_shingles(held).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    counted = once.filter("c = 1").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("u"))
    return counted.select(_print_of("h1", "h2").alias("_set"), "u")


def _possible(shared: Column, percent: int) -> Column:
    """Whether sets of na and nb shingles that share at most so many can be similar enough."""
    return 100 * shared >= percent * (F.col("na") + F.col("nb") - shared)


def _ordered() -> list[Column]:
    return [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]


def pivot_pairs(placed: DataFrame, used: DataFrame | None, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of one pivot a bucket with members (key, _set, n, u, _group) of other groups.

    The pivot is a set with fewest lonely shingles of a group that has held none of the pivots
    (key, _set) before. A set shares at most n - u shingles with any other; pairs that this
    rules out are left out. Also returns all pivots so far.
    """
    open_sets = placed
    if used is not None:
        spent = placed.join(used, ["key", "_set"], "left_semi").select("key", "_group").distinct()
        open_sets = placed.join(stored(spent), ["key", "_group"], "left_anti")
    first = open_sets.groupBy("key").agg(F.min(F.struct("u", "n", "_set", "_group")).alias("p"))
    pivots = stored(first.select("key", "p.*"))
    one = pivots.select(
        "key", F.col("_set").alias("b"), F.col("n").alias("nb"), F.col("u").alias("ub"), F.col("_group").alias("gb")
    )
    own = placed.select("key", F.col("_set").alias("a"), F.col("n").alias("na"), F.col("u").alias("ua"), F.col("_group").alias("ga"))
    shared = F.least(F.col("na") - F.col("ua"), F.col("nb") - F.col("ub"))
    met = own.join(one, "key").filter((F.col("ga") != F.col("gb")) & _possible(shared, percent))
    named = pivots.select("key", "_set")
    return met.select(*_ordered()).distinct(), named if used is None else used.unionByName(named)


def rare_pairs(placed: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups of one bucket that share one of their rarest shingles.

    All sets order their shingles by the number of sets here that have them. Similar sets share
    so many that the first one they share is near the front of both, and leaves enough behind
    it in both; so no similar pair is lost. A shingle that only one set has meets nothing.
    """
    sets = stored(placed.select("_set").distinct())
    met = stored(met_shingles(held.join(sets, "_set", "left_semi")))
    several = stored(met.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"))
    one_set = Window.partitionBy("h1", "h2")
    place = F.col("n") - F.count(F.lit(1)).over(one_set) + F.row_number().over(one_set.orderBy("c", "shingle")) - 1
    front = F.col("n") - F.ceil(F.col("n") * percent / 100)
    rare = met.join(several, "shingle").withColumn("place", place).filter(F.col("place") <= front)
    rare = rare.select(_print_of("h1", "h2").alias("_set"), "shingle", "place")
    listed = stored(placed.select("key", "_set", "n", "_group").join(stored(rare), "_set"))
    sizes = listed.groupBy("key", "shingle", "_group").agg(F.count(F.lit(1)).alias("c"))
    # Members of the largest group need not meet each other, and a lone group meets none.
    kinds = sizes.groupBy("key", "shingle").agg(
        F.count(F.lit(1)).alias("groups"), F.max_by("_group", F.struct("c", "_group")).alias("largest")
    )
    several_groups = stored(kinds.filter("groups > 1").drop("groups"))
    listed = stored(listed.join(several_groups, ["key", "shingle"]))
    own = listed.select("key", "shingle", F.col("_set").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("_group").alias("ga"), "largest")
    other = listed.filter(F.col("_group") != F.col("largest")).select(
        "key", "shingle", F.col("_set").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("_group").alias("gb")
    )
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    once = (F.col("ga") == F.col("largest")) | (F.col("a") < F.col("b"))
    apart = (F.col("ga") != F.col("gb")) & once & _possible(left, percent)
    return own.join(other, ["key", "shingle"]).filter(apart).select(*_ordered()).distinct()


def near_groups(members: DataFrame, held: DataFrame, percent: int) -> DataFrame | None:
    """_set and _group of linked sets; None without links.

    `members` (key, _set, n) are the buckets, `held` has _values for each _set in them.
    """
    # A smaller set is similar to itself only.
    members = members.filter(100 * F.col("n") >= percent * (F.col("n") + 1))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    large = stored(sizes.filter(F.col("c") > SMALL).select("key"))
    crowd = stored(members.join(large, "key", "left_semi"))
    members = members.withColumn("u", F.lit(0).cast("long"))
    if not crowd.isEmpty():
        # Counts hold among these sets, so they count in their large buckets only.
        lonely = lonely_shingles(held.join(stored(crowd.select("_set").distinct()), "_set"))
        counted = crowd.join(stored(lonely), "_set", "left").fillna(0, ["u"])
        members = stored(members.join(large, "key", "left_anti").unionByName(counted))
    tested = links = groups = used = None
    for step in range(PIVOTS + 1):
        placed = members.withColumn("_group", F.col("_set"))
        if groups is not None:
            placed = members.join(groups, "_set", "left").withColumn("_group", F.coalesce("_group", "_set"))
        apart = placed.groupBy("key").agg(F.min("_group").alias("x"), F.max("_group").alias("y")).filter("x <> y")
        placed = stored(placed.join(stored(apart.select("key")), "key", "left_semi"))
        if step < PIVOTS:
            pairs, used = pivot_pairs(placed, used, percent)
        else:
            pairs = rare_pairs(placed, held, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        if pairs.isEmpty():
            continue
        found = stored(linked(pairs, held, percent))
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            groups = stored(components(links))
    return groups


def near_components(
    documents: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """_k1, _k2, doc_id, n_shingles, component_id, kept of every row; see mark_near_copies."""
    ship(documents.sparkSession)
    shingled = Shingled(size, bands, rows)
    texts = row_key(documents.select("doc_id", "text"))
    light = stored(shingled.columns(texts).drop("text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_k1", "_k2")).alias("least")
    sets = light.filter(F.col("n_shingles") > 0).groupBy("_set")
    sets = stored(sets.agg(first, F.first("n_shingles").alias("n"), F.first("_bands").alias("_bands")))
    keys = sets.select("_set", "n", F.explode("_bands").alias("key"))
    # Stored, as other sides of joins here, so that the join may split a key of many rows.
    shared = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"))
    members = stored(keys.join(shared, "key"))
    # Texts move once, to the rows that stand for a candidate set.
    wanted = members.select("_set").distinct().join(sets.select("_set", "least._k1", "least._k2"), "_set")
    chosen = texts.join(stored(wanted).hint("shuffle_hash"), ["_k1", "_k2"]).select("_set", "text")
    held = stored(shingled.values(chosen).drop("text").dropDuplicates(["_set"]))
    groups = near_groups(members, held, percent)
    named = sets.select("_set", F.col("least.doc_id").alias("_least"))
    if groups is not None:
        named = named.join(groups, "_set", "left").withColumn("_group", F.coalesce("_group", "_set"))
        least = named.groupBy("_group").agg(F.min("_least").alias("component_id"))
        named = named.join(least, "_group").select("_set", "component_id")
    else:
        named = named.withColumnRenamed("_least", "component_id")
    some = light.filter(F.col("n_shingles") > 0).join(named, "_set")
    none = light.filter(F.col("n_shingles") == 0).withColumn("component_id", F.col("doc_id"))
    found = some.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return found.select("_k1", "_k2", "doc_id", "n_shingles", "component_id", "kept")


def mark_near_copies(
    documents: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Every row with n_shingles, component_id and kept; further columns stay.

    Sets hold the distinct shingles of so many words of the text with A-Z in lower case; with
    fewer words, all of them are one shingle. Two sets are linked if 100 times what they share
    is at least percent times what they have together. A component holds all documents that
    links connect; it is named by its smallest doc_id (a null id counts as largest), and the
    rows with that id stay. A null text, or one without words, is linked with nothing, so its
    row stays. Columns of these names are replaced; names that begin with an underscore are
    reserved.
    """
    found = near_components(documents, size, percent, bands, rows).drop("doc_id").dropDuplicates(["_k1", "_k2"])
    plain = documents.drop("n_shingles", "component_id", "kept")
    return row_key(plain).join(found.hint("shuffle_hash"), ["_k1", "_k2"]).drop("_k1", "_k2")
