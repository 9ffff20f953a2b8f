"""Substring deduplication by super-k-mers of words (operator 1).

A window is a fixed number of consecutive words. Consecutive windows with the same
minimiser, the least hash of a few words in the window, are one super-k-mer. Its minimiser and
a print of its bytes travel to the minimiser's bucket. Equal windows have equal minimisers, so a
super-k-mer that is alone there holds no repeated window, and where all have one print, all their
windows are repeated: the text of neither moves. The others travel as packed strings to their
bucket, where sorting shows which windows occur more than once.

Where one minimiser has very many super-k-mers that differ, their windows are keyed by a hash
of their own words instead and counted before they move, so that no task receives them all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from storelens.llm.common import WordHashes, add_columns, mix, row_key, ship, slices, stored, word_bounds

WIDTH = 35
# Words of which a minimiser is made.
SEED_WORDS = 4
# Mask of the bits that number the words of some texts handled together.
PLACES = (1 << 28) - 1
# Super-k-mers of one minimiser that a task may hold (some 100 MB if all differ); beyond, their
# windows are dealt out one by one, for which the texts of all documents are read once more.
HOT = 20_000


class SuperKmers:
    """Super-k-mers of some texts, in order; all arrays have one entry for each."""

    def __init__(self, texts: list[str | None], width: int, hashes: WordHashes) -> None:
        words = [(text or "").encode().split() for text in texts]
        self.data = b"\n".join(b" ".join(own) for own in words)
        self.bytes = np.frombuffer(self.data, dtype=np.uint8)
        self.start, self.end = word_bounds(self.bytes)
        self.word_hash = hashes(self.bytes, self.start, self.end)
        self.width = width
        counts = np.array([len(own) for own in words], dtype=np.int64)
        first_word = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(texts)), counts)
        windows = len(owner) - width + 1
        if windows <= 0:
            inside = np.zeros(0, dtype=np.int64)
        else:
            inside = np.flatnonzero(owner[:windows] == owner[width - 1 :])
        seeds, place = self._minimisers(len(owner))
        place = place[inside]
        new = np.ones(len(inside), dtype=bool)
        new[1:] = place[1:] != place[:-1]
        head = np.flatnonzero(new)
        self.windows = np.diff(np.append(head, len(inside)))
        self.first = inside[head]
        self.minimiser = seeds[place[head]].view(np.int64)
        self.document = owner[self.first]
        self.position = self.first - first_word[self.document]

    def _minimisers(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the words at each place, and the place of the least one in the window there.

        Of equal ones the first counts, so no two windows of a super-k-mer are equal. Places
        of windows that cross documents are not used.
        """
        seed = min(SEED_WORDS, self.width)
        count = max(words - seed + 1, 0)
        value = np.zeros(count, dtype=np.uint64)
        for k in range(seed):
            value += self.word_hash[k : k + count] * np.uint64(2 * (k * 0x3C6EF372 + 0x1F123BB5) + 1)
        value = mix(value)
        # High bits of the hash, then the place: the least is the first of the least.
        least = (value & ~np.uint64(PLACES)) | np.arange(count, dtype=np.uint64)
        span, reach = self.width - seed + 1, 1
        while reach < span:
            step = min(reach, span - reach)
            least = np.minimum(least[: max(len(least) - step, 0)], least[step:])
            reach += step
        return value, (least & np.uint64(PLACES)).astype(np.int64)

    def prints(self) -> np.ndarray:
        """64 bits of a digest of each packed string."""
        digests = (blake2b(x, digest_size=8).digest() for x in self.packed(np.arange(len(self.first))))
        return np.frombuffer(b"".join(digests), dtype=np.int64)

    def at(self, document: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Index of the super-k-mers of some documents that begin at some words."""
        return np.searchsorted((self.document << 32) + self.position, (document << 32) + position)

    def packed(self, chosen: np.ndarray) -> list[bytes]:
        low = self.start[self.first[chosen]]
        high = self.end[self.first[chosen] + self.windows[chosen] + self.width - 2]
        return [self.data[a:b] for a, b in zip(low.tolist(), high.tolist())]


def window_prints(kmers: SuperKmers, chosen: np.ndarray) -> np.ndarray:
    """Two 64-bit prints of each window of the chosen super-k-mers, one after another."""
    count = kmers.windows[chosen]
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(kmers.first[chosen], count) + step
    prints = []
    for seed in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        total = np.zeros(len(first), dtype=np.uint64)
        for k in range(kmers.width):
            total = mix(total + kmers.word_hash[first + k] + np.uint64(seed))
        prints.append(total.view(np.int64))
    return np.stack(prints, axis=1)


def repeated_windows(strings: list[bytes], width: int) -> list[np.ndarray]:
    """For each packed string, whether each of its windows occurs again in any of them."""
    windows, sizes = [], []
    for string in strings:
        at = [-1, *(i for i, byte in enumerate(string) if byte == 32), len(string)]
        own = [string[at[i] + 1 : at[i + width]] for i in range(len(at) - width)]
        windows += own
        sizes.append(len(own))
    order = sorted(range(len(windows)), key=windows.__getitem__)
    again = np.zeros(len(windows), dtype=bool)
    for a, b in zip(order, order[1:]):
        if windows[a] == windows[b]:
            again[a] = again[b] = True
    return np.split(again, np.cumsum(sizes)[:-1])


SPANS = "_k1 long, _k2 long, spans array<struct<low: long, high: long>>"


def repeated_spans(documents: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Word ranges of repeated windows: _k1, _k2 of the document, spans of [low, high)."""
    ship(documents.sparkSession)
    # All columns, so that Spark moves the texts once for this and for the removal after it.
    keyed = row_key(documents)

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                found = SuperKmers(part["text"].to_pylist(), width, hashes)
                own = part.select(["_k1", "_k2"]).take(pa.array(found.document))
                high = found.position + found.windows + width - 1
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(found.position), pa.array(high), pa.array(found.minimiser), pa.array(found.prints())],
                    names=["_k1", "_k2", "low", "high", "minimiser", "print"],
                )

    kmers = keyed.select("_k1", "_k2", "text").mapInArrow(light, "_k1 long, _k2 long, low long, high long, minimiser long, print long")
    bucket = Window.partitionBy("minimiser")
    shared = kmers.withColumns(
        {"n": F.count(F.lit(1)).over(bucket), "alike": F.min("print").over(bucket) == F.max("print").over(bucket)}
    ).filter(F.col("n") > 1)
    differ, often = ~F.col("alike"), F.col("n") > hot
    chosen = shared.groupBy("_k1", "_k2").agg(
        F.collect_set(F.when(F.col("alike"), F.struct("low", "high"))).alias("spans"),
        F.collect_set(F.when(differ & ~often, F.col("low"))).alias("lows"),
        F.collect_set(F.when(differ & often, F.col("minimiser"))).alias("hot"),
    )
    chosen = stored(chosen)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                found, lows = SuperKmers(part["text"].to_pylist(), width, hashes), part["_lows"]
                document = np.repeat(np.arange(part.num_rows), lows.value_lengths().to_numpy())
                picked = found.at(document, lows.flatten().to_numpy())
                own = part.select(["_k1", "_k2"]).take(pa.array(document))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(found.position[picked]), pa.array(found.minimiser[picked]),
                     pa.array(found.packed(picked), pa.binary())],
                    names=["_k1", "_k2", "position", "minimiser", "packed"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by minimiser; one minimiser's rows are held at a time."""

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch[c].to_pylist() for c in ("minimiser", "packed", "_k1", "_k2", "position")))

        out: list[tuple] = []
        for _, group in groupby(rows(), key=lambda row: row[0]):
            own = list(group)
            if len(own) == 1:
                continue
            times = Counter(row[1] for row in own)
            found = dict(zip(times, repeated_windows(list(times), width)))
            for row in own:
                # All windows of a string that occurs again do so too.
                again = found[row[1]] | (times[row[1]] > 1)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], again.view(np.int8), [0])))) + row[4]
                if len(edge):
                    ranges = zip(edge[::2].tolist(), (edge[1::2] + width - 1).tolist())
                    out.append((row[2], row[3], [{"low": a, "high": b} for a, b in ranges]))
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    wanted = chosen.filter(F.size("lows") > 0).select("_k1", "_k2", F.col("lows").alias("_lows"))
    packed = keyed.join(wanted.hint("shuffle_hash"), ["_k1", "_k2"]).mapInArrow(
        pack, "_k1 long, _k2 long, position long, minimiser long, packed binary"
    )
    spans = packed.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(count, SPANS)
    spans = spans.unionByName(chosen.filter(F.size("spans") > 0).select("_k1", "_k2", "spans"))
    # At most one in `hot` super-k-mers: a table of 30 GB has some ten thousands if all are hot.
    common = [row[0] for row in chosen.select(F.explode("hot")).distinct().collect()]
    if common:

        def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                for part in slices(batch, 100):
                    found = SuperKmers(part["text"].to_pylist(), width, hashes)
                    picked = np.flatnonzero(np.isin(found.minimiser, common))
                    offsets = np.concatenate(([0], np.cumsum(found.windows[picked]))).astype(np.int32)
                    both = window_prints(found, picked)
                    pairs = pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["one", "two"])
                    own = part.select(["_k1", "_k2"]).take(pa.array(found.document[picked]))
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(found.position[picked]), pa.ListArray.from_arrays(pa.array(offsets), pairs)],
                        names=["_k1", "_k2", "position", "windows"],
                    )

        kind = "_k1 long, _k2 long, position long, windows array<struct<one: long, two: long>>"
        # The texts are read once more instead of being moved.
        found = keyed.select("_k1", "_k2", "text").mapInArrow(prints, kind)
        spans = spans.unionByName(_hot_spans(stored(found), width))
    return spans


def _hot_spans(found: DataFrame, width: int) -> DataFrame:
    """Spans of repeated windows of super-k-mers (_k1, _k2, position, windows) known by their prints.

    Equal super-k-mers are one row before their windows are counted, and again until the end.
    """
    kinds = stored(found.groupBy("windows").agg(F.count(F.lit(1)).alias("n")))
    windows = kinds.select(F.col("windows").alias("kind"), "n", F.posexplode("windows").alias("at", "window"))
    again = stored(windows.groupBy("window").agg(F.sum("n").alias("n")).filter(F.col("n") > 1).select("window"))
    marked = windows.join(again, "window").groupBy("kind").agg(F.collect_set("at").alias("places"))
    rows = found.join(stored(marked), F.col("windows") == F.col("kind"))
    spans = F.transform("places", lambda at: F.struct((F.col("position") + at).alias("low"), (F.col("position") + at + width).alias("high")))
    return rows.select("_k1", "_k2", spans.alias("spans"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    one, two, spans = zip(*rows) if rows else ((), (), ())
    kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(spans, kind)], names=["_k1", "_k2", "spans"]
    )


def remove_repeats(documents: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Every row with n_words, n_removed and kept_text, the words left, joined by one blank.

    A word goes if any window over it also starts elsewhere, in the same document or another;
    windows are those of the input. A null text has no words. Rows with equal text and id
    count as separate documents, which repeat each other. Further columns stay; those of these
    names are replaced, and names that begin with an underscore are reserved.
    """
    documents = documents.drop("n_words", "n_removed", "kept_text")
    spans = repeated_spans(documents, width, hot)
    marks = spans.groupBy("_k1", "_k2").agg(F.flatten(F.collect_list("spans")).alias("_spans"))
    joined = row_key(documents).join(marks.hint("shuffle_hash"), ["_k1", "_k2"], "left")

    def remove(batch: pa.RecordBatch) -> list[pa.Array]:
        total, removed, kept = [], [], []
        for text, spans in zip(batch["text"].to_pylist(), batch["_spans"]):
            words = (text or "").encode().split()
            keep = np.ones(len(words), dtype=bool)
            if spans.is_valid:
                ranges = spans.values
                for low, high in zip(ranges.field("low").to_pylist(), ranges.field("high").to_pylist()):
                    keep[low:high] = False
            left = [words[i] for i in np.flatnonzero(keep)] if not keep.all() else words
            total.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        return [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    fields.append(T.StructField("kept_text", T.StringType()))
    return add_columns(joined, fields, remove).drop("_k1", "_k2", "_spans")
