"""Exact deduplication by an extendible-hash index (operator 2).

Entries are the 64-bit hashes of the normalised texts. A directory maps leading bits of the
hash to buckets: it starts with few bits and doubles, splitting the buckets that hold more
hashes than a task should own, until none is overfull. Entries lie in shared files, and each
task owns a range of buckets, hence of keys. Which texts are equal is not decided by the owners
of buckets: of the index only the hashes of several rows are used, and the rows with such a
hash are grouped by hash and whole text, which makes the chain below each entry.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import stored

# Hashes that a bucket may hold before it splits, and the bits that a directory starts with
# and ends at; with all bits in use a bucket stays overfull.
CAPACITY = 100_000
FIRST_BITS, MOST_BITS = 4, 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str | Column) -> Column:
    """A-Z in lower case, all else unchanged; null counts as empty.

    A text of one byte a character takes the quick way, which does the same there.
    """
    whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    plain = F.octet_length(whole) == F.char_length(whole)
    return F.when(plain, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def hash64(text: Column) -> Column:
    return F.xxhash64(text)


def directory(hashes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Directory entries (leaf, bucket, bits): a bucket is named by the first leaf it covers.

    `hashes` has distinct values of `hash`. A round only looks at the buckets that the last
    one found overfull; each entry is settled in the round in which its bucket fits.
    """
    leaf = F.shiftrightunsigned("_hash", 64 - MOST_BITS)
    open_leaves = stored(hashes.groupBy(leaf.alias("leaf")).agg(F.count(F.lit(1)).alias("hashes")))
    settled = []
    for bits in range(FIRST_BITS, MOST_BITS + 1):
        unused = MOST_BITS - bits
        bucket = F.shiftleft(F.shiftright("leaf", unused), unused)
        named = open_leaves.withColumn("bucket", bucket)
        filled = named.groupBy("bucket").agg(F.sum("hashes").alias("held"))
        fits = (F.col("held") <= capacity) | F.lit(bits == MOST_BITS)
        settled.append(named.join(filled.filter(fits), "bucket").select("leaf", "bucket", F.lit(bits).alias("bits")))
        split = filled.filter(~fits)
        if split.isEmpty():
            break
        open_leaves = stored(named.join(split, "bucket", "left_semi").drop("bucket"))
    return reduce(DataFrame.unionByName, settled)


def index(documents: DataFrame, capacity: int = CAPACITY, hashed: Callable[[Column], Column] = hash64) -> DataFrame:
    """Index entries (bucket, hash, rows, max_id) in shared files, one for each distinct hash.

    Equal hashes are counted before they move, so that a text with many copies is one entry.
    Each task owns a range of buckets, in the order of their keys.
    """
    text = normalised("text")
    hashes = documents.groupBy(hashed(text).alias("_hash")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("doc_id").alias("max_id")
    )
    hashes = stored(hashes)
    leaf = F.shiftrightunsigned("_hash", 64 - MOST_BITS)
    entries = hashes.withColumn("leaf", leaf).join(directory(hashes, capacity), "leaf")
    owned = entries.repartitionByRange("bucket").sortWithinPartitions("bucket", "_hash")
    return stored(owned.select("bucket", "_hash", "rows", "max_id"))


def chains(documents: DataFrame, entries: DataFrame, hashed: Callable[[Column], Column] = hash64) -> DataFrame:
    """Distinct texts below each entry of several rows: hash, text, keep_id, group_size.

    Grouping compares whole texts; copies meet before the shuffle as far as a task holds them.
    """
    text = normalised("text")
    several = entries.filter(F.col("rows") > 1).select("_hash")
    return (
        documents.select("doc_id", text.alias("text"), hashed(text).alias("_hash"))
        .join(several.hint("shuffle_hash"), "_hash", "left_semi")
        .groupBy("_hash", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def mark_copies(
    documents: DataFrame, capacity: int = CAPACITY, hashed: Callable[[Column], Column] = hash64
) -> DataFrame:
    """Every row with keep_id, group_size, kept and text_sha256; all further columns stay.

    Of equal texts the row with the largest doc_id stays; a null id is smaller than any other,
    and rows with the same text and id stay together. A null text equals an empty one. Columns
    of these names in the input are replaced.
    """
    text = normalised("text")
    links = stored(chains(documents, index(documents, capacity, hashed), hashed))
    heads = links.groupBy("_hash").agg(
        F.count(F.lit(1)).alias("_links"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    # Stored, so that the join may split a hash that many rows have.
    heads = stored(heads)
    plain = documents.drop("keep_id", "group_size", "kept", "text_sha256").withColumns(
        {"_hash": hashed(text), "text_sha256": F.sha2(text, 256)}
    )
    marked = plain.join(heads, "_hash", "left")
    collided = heads.filter(F.col("_links") > 1)
    if not collided.isEmpty():
        # Chains of several texts: the text itself says which link a row belongs to.
        chained = links.join(collided.select("_hash"), "_hash", "left_semi").select(
            F.col("_hash").alias("_other"), F.col("text").alias("_text"), "keep_id", "group_size"
        )
        several = plain.join(collided.select("_hash"), "_hash", "left_semi")
        found = several.join(chained, (F.col("_hash") == F.col("_other")) & (text == F.col("_text")))
        single = marked.filter(F.coalesce("_links", F.lit(1)) == 1).drop("_links")
        marked = single.unionByName(found.drop("_other", "_text"))
    marked = marked.drop("_hash", "_links")
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return marked.withColumns({"keep_id": keep, "group_size": size}).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
    )
