"""What several operators share: reading, held-out folds, words, stored intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.sources.stored import shared_folder

# The whitespace that parts words: space and U+0009 to U+000D, which is also what
# bytes.split() parts at.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Text that a worker takes at a time; its arrays take some tens of times as much.
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors' Python, once for each Spark context."""
    context = spark.sparkContext
    if not getattr(context, "_storelens_shipped", False):
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='run-')}/storelens", "zip", root, "storelens")
        context.addPyFile(archive)
        context._storelens_shipped = True
    return spark


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Writes a table to the folder that all machines share and reads it back.

    Cuts the lineage, so that a lost executor does not bring the work back.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts


def slices(batch: pa.RecordBatch, rows: int = 500, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch, of at most so many rows and bytes of text; one row may be longer."""
    length = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            length += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(length), 0
    while at < batch.num_rows:
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
        end = min(max(full, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def add_columns(
    df: DataFrame, fields: list[T.StructField], function: Callable[[pa.RecordBatch], list[pa.Array]], rows: int = 500
) -> DataFrame:
    """The rows with columns that a function makes of some rows at a time; it replaces same names."""
    ship(df.sparkSession)
    kept = df.drop(*[f.name for f in fields])
    schema = T.StructType(kept.schema.fields + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows):
                yield pa.RecordBatch.from_arrays(part.columns + function(part), names=schema.names)

    return kept.mapInArrow(run, schema)


def row_key(df: DataFrame) -> DataFrame:
    """With columns _k1, _k2 that no row lacks; only rows with equal id and text share them."""
    whole = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return df.withColumns({"_k1": whole, "_k2": F.xxhash64("text", F.lit(1))})


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers with well spread bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a byte array."""
    gap = np.ones(len(data) + 2, dtype=np.int8)
    gap[1:-1] = SPACES[data]
    step = np.diff(gap)
    return np.flatnonzero(step == -1), np.flatnonzero(step == 1)


class WordHashes:
    """64-bit hashes of the words of a byte array: a polynomial in the bytes, then mixed."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if n >= len(self.up):
            size = 1 << n.bit_length()
            for name, base in (("up", self.BASE), ("down", self.INVERSE)):
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.zeros(0, dtype=np.uint64)
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
