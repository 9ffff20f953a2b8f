"""Facts stored by their key, as a clustered index would lay them out (Q1).

A table lies in buckets of a key's hash, each sorted by the whole key, so that equal keys are
neighbours in one file. Checks and sums by the key then start without a shuffle: the cost of
moving the facts is paid once, when they are stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from storelens.operators.quality import duplicate_keys
from storelens.sources.tables import PRIMARY_KEYS


# Sorting and summing that many lines takes about 100 MB of a task's memory.
LINES_PER_BUCKET = 500_000


def buckets_for(lines: int) -> int:
    """Buckets for a number of lines, so that a bucket, which is one task, does not grow with the table."""
    return max(8, -(-lines // LINES_PER_BUCKET))


def store_clustered(
    df: DataFrame, path: str, key: Sequence[str], buckets: int = 200, by: Sequence[str] | None = None
) -> DataFrame:
    """Replaces a table at a path by one in buckets, one file each, and returns it.

    Rows meet in a bucket by the columns `by`, by default the first of the key: for sale and
    tender lines that is the transaction, so sums by transaction need no shuffle either. A
    bucket is read by one task. Where one value of that column may hold much of the table, name
    more columns of the key; the whole key spreads any such value, and still checks without a
    shuffle. The number of buckets should make them some hundred megabytes each, see `buckets_for`.

    The buckets are known to the session's catalog, under a name of their own.
    """
    spread = list(by or key[:1])
    if not spread or not set(spread) <= set(key):
        raise ValueError("rows are spread by columns of the key")
    name = f"clustered_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *spread).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *spread).sortBy(*key).saveAsTable(name)
    return df.sparkSession.table(name)


def clustered_key_violations(clustered: DataFrame, table: str) -> DataFrame:
    """Primary key values that occur again or lack a part, of facts that are stored by that key."""
    return duplicate_keys(clustered, list(PRIMARY_KEYS[table]))
