from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from storelens.llm import exact

TEXTS = [(1, "Abc É"), (2, "aBC É"), (3, "abc é"), (4, None), (5, ""), (6, "x"), (7, "x"), (7, "x"), (None, "X"), (9, "Z" * 50_000)]


def expected(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for i, text in rows:
        groups.setdefault((text or "").translate(lower), []).append(i)
    out = []
    for i, text in rows:
        own = groups[(text or "").translate(lower)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256((text or "").translate(lower).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("hashed", [exact.hash64, lambda t: F.length(t).cast("bigint"), lambda t: F.lit(5).cast("bigint")])
def test_copies_under_any_hash(rows, hashed):
    df = rows("doc_id bigint, text string", *TEXTS)
    assert found(exact.mark_copies(df, capacity=1, hashed=hashed)) == expected(TEXTS)


def test_extra_columns_stay_and_same_names_are_replaced(rows):
    df = rows("doc_id bigint, text string, kept string, note string", (1, "a", "old", "n"), (2, "a", "old", "m"))
    got = {r["doc_id"]: (r["kept"], r["note"]) for r in exact.mark_copies(df).collect()}
    assert got == {1: (False, "n"), 2: (True, "m")}


def test_empty(rows):
    assert exact.mark_copies(rows("doc_id bigint, text string")).count() == 0


def test_directory_covers_every_hash_once_and_splits(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("_hash"))
    found = exact.directory(hashes, capacity=20)
    buckets = found.groupBy("bucket").agg(F.max("bits").alias("bits"), F.min("bits").alias("least")).collect()
    assert all(r["bits"] == r["least"] for r in buckets) and max(r["bits"] for r in buckets) > exact.FIRST_BITS
    leaf = F.shiftrightunsigned("_hash", 64 - exact.MOST_BITS).alias("leaf")
    joined = hashes.select("_hash", leaf).join(found, "leaf").groupBy("bucket").agg(F.count("_hash").alias("n"))
    got = joined.agg(F.sum("n"), F.max("n")).first()
    assert got[0] == 2000 and got[1] <= 20
