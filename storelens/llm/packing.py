"""Mixture-controlled packing of token sequences (operator 9).

Each source is a queue of its documents' tokens. Windows are filled by deficit round-robin:
with every window a source is owed its share of the tokens, is served in turn once the debt
makes a piece worth cutting, and what it is owed beyond that stays owed in the next window.
Blocks of windows are packed side by side: block b takes from a source the tokens between
floor(total * b / blocks) and floor(total * (b + 1) / blocks), so that a debt of under one
token is all that passes from one block to the next, and proportions hold throughout. Shares
of another mixture move these cuts and what a source is owed alike, see due_lines.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import chain
from math import ceil, floor, inf
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from storelens.llm.common import add_columns, ship, stored

WINDOW = 2048
END = 1
# Tokens that one task packs at a time.
BLOCK_TOKENS = 1 << 21
# A source waits until it is owed so many tokens.
LEAST_PIECE = 64
# Words that a worker knows: those of the last texts, up to so many, and as many before them.
CACHE = 350_000
# A tokenizer that normalizes and parts texts like this gives a word the ids of its pieces.
# Of PLAIN words, which have no digits, normalizing only lowers the case; PIECE finds the pieces then.
FORM = {
    "normalizer": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "pre_tokenizer": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
PLAIN = re.compile(rb"[!-/:-~]+")
PIECE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[^a-z]+")
# Stands between words that are encoded together, and how many are.
MARK, TOGETHER = "\x01", 256
PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


class WordCodec:
    """Ids of whole texts from the ids of their words; the tokenizer never joins across blanks."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.mark = self._ids(MARK)
        form = json.loads(self.tokenizer.to_str())
        steps = {name: next((x for x in (form[name] or {}).values() if isinstance(x, list)), None) for name in FORM}
        self.parted = steps == FORM and form["post_processor"] is None

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _lowered(self, text: str) -> str:
        """Lower case of texts where that leaves the ids as they are and makes fewer different words."""
        lowered = text.lower() if text.isascii() else text
        # Special tokens are told by their case.
        return text if any(s in lowered for s in self.special) else lowered

    def _whole(self, text: str) -> bytes:
        return np.array(self._ids(text), dtype="<u2").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Encodes plain words by their pieces, which many of them share, and others together."""
        if not self.parted:
            return self._encode(words)
        special = re.compile(b"|".join(re.escape(s.encode()) for s in self.special) or rb"(?!)")
        pieces = {w: PIECE.findall(w.lower()) for w in words if PLAIN.fullmatch(w) and not special.search(w)}
        self._encode([w for w in words if w not in pieces])
        known, earlier, model = self.known, self.earlier, self.tokenizer.model
        for piece in set(chain.from_iterable(pieces.values())):
            if piece not in known:
                # The bytes of plain words stand for themselves in the vocabulary.
                ids = earlier.get(piece)
                if ids is None:
                    found = [t.id for t in model.tokenize(piece.decode())]
                    ids = pack_ids(f"<{len(found)}H", *found)
                known[piece] = ids
        known.update((w, b"".join([known[p] for p in own])) for w, own in pieces.items() if w not in known)

    def _encode(self, words: list[bytes]) -> None:
        """Encodes words together, with a mark after each; a mark that is no single id serves no word."""
        texts = [w.decode() for w in words]
        alone = [*self.special, MARK] if len(self.mark) == 1 else [""]
        apart = [any(s in t for s in alone) for t in texts]
        self.known.update((w, self._whole(t)) for w, t, own in zip(words, texts, apart) if own)
        plain = [w for w, own in zip(words, apart) if not own]
        texts = [t for t, own in zip(texts, apart) if not own]
        if not plain:
            return
        runs = [f" {MARK} ".join(texts[i : i + TOGETHER]) + f" {MARK}" for i in range(0, len(texts), TOGETHER)]
        found = np.fromiter(chain.from_iterable(map(self._ids, runs)), dtype="<u2")
        ids, marks = found.tobytes(), np.flatnonzero(found == self.mark[0]) * 2
        self.known.update((w, ids[low:high]) for w, low, high in zip(plain, [0, *(marks + 2).tolist()], marks.tolist()))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [np.frombuffer(x, dtype="<u2").astype("<u4").tobytes() for x in self.short(texts)]

    def short(self, texts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each text."""
        words = [self._lowered(text).encode().split() for text in texts]
        if len(self.known) > CACHE:
            self.known, self.earlier = {}, self.known
        known, earlier, new = self.known, self.earlier, []
        for word in set().union(*words):
            if word not in known:
                if word in earlier:
                    known[word] = earlier[word]
                else:
                    new.append(word)
        self._learn(new)
        get = known.__getitem__
        return [
            self._whole(text) if any(s in text for s in self.special) else b"".join(map(get, own))
            for text, own in zip(texts, words)
        ]


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


def tokenize(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, source, n_tokens and `ids` (binary, little-endian 16-bit) with the end id last."""

    def ids(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = word_codec(path)
        if coder.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        end = END.to_bytes(2, "little")
        short = [x + end for x in coder.short([text or "" for text in batch["text"].to_pylist()])]
        return [pa.array(short, pa.binary()), pa.array([len(x) // 2 for x in short], pa.int64())]

    fields = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    return add_columns(documents.select("doc_id", "source", "text"), fields, ids).drop("text")


def due_lines(sizes: dict[int, int], shares: dict[int, float], total: int) -> dict[int, tuple[list[float], list[float]]]:
    """Corners (tokens of all sources, tokens of this one) of the line that a source follows.

    Sources are served in proportion to their shares. One that is exhausted ends there, and the
    others go on in the proportions they have among themselves. Sources of no share follow
    when all others are exhausted, in proportion to their sizes. `total` may count sources of
    no share that are not in `sizes`.
    """
    left = {s: Fraction(shares[s]) for s in sizes if shares.get(s) and sizes[s]}
    lines: dict[int, tuple[list[float], list[float]]] = {s: ([0.0], [0.0]) for s in left}
    at, served = Fraction(0), dict.fromkeys(left, Fraction(0))
    while left:
        whole = sum(left.values())
        need = {s: (sizes[s] - served[s]) / share for s, share in left.items()}
        step = min(need.values())
        at += step * whole
        for s, share in left.items():
            served[s] += step * share
            lines[s][0].append(float(at))
            lines[s][1].append(float(served[s]))
        left = {s: share for s, share in left.items() if need[s] > step}
    rest = {s: ([0.0, float(at), float(total)], [0.0, 0.0, float(n)]) for s, n in sizes.items() if s not in lines}
    return lines | rest


def deal(
    sources: list[tuple[int, int]], window: int = WINDOW, shares: dict[int, float] | None = None
) -> Iterator[tuple[int, int, int]]:
    """(window, source, tokens) in the order of service, for (source, tokens) queues of one block.

    All windows but the last are full. Without `shares` a source's share is that of its tokens.
    """
    total = sum(n for _, n in sources)
    windows = ceil(total / window)
    size, served = dict(sources), dict.fromkeys((s for s, _ in sources), 0)
    due: list[list[int]] = [[] for _ in range(windows)]
    lines = None if shares is None else due_lines(size, shares, total)

    def due_by(source: int, tokens: int) -> int:
        if lines is None:
            return size[source] * tokens // total
        return floor(np.interp(tokens, *lines[source]) + 1e-6)

    def wait(source: int, now: int) -> None:
        """Puts a source where the tokens owed to it reach the least piece."""
        left = size[source] - served[source]
        if left:
            goal = served[source] + min(LEAST_PIECE, left)
            if lines is None:
                reached = ceil(goal * total / (size[source] * window))
            else:
                reached = ceil(np.interp(goal, *reversed(lines[source])) / window - 1e-9)
            due[min(max(reached - 1, now), windows - 1)].append(source)

    for source, _ in sources:
        wait(source, 0)
    ahead = deque(sorted(size, key=lambda s: (-(shares or {}).get(s, 0), -size[s], s)))
    ready: deque[int] = deque()
    for now in range(windows):
        ready.extend(due[now])
        room = min(window, total - now * window)
        while room and ready:
            source = ready.popleft()
            owed = due_by(source, min((now + 1) * window, total)) - served[source]
            give = min(owed, room)
            if give > 0:
                yield now, source, give
                served[source] += give
                room -= give
            if give < owed:
                ready.appendleft(source)
            elif now + 1 < windows:
                wait(source, now + 1)
        while room:
            # Nobody is owed a piece: the largest share, then queue, runs ahead and is owed less later.
            source = ahead[0]
            give = min(room, size[source] - served[source])
            if give:
                yield now, source, give
                served[source] += give
                room -= give
            else:
                ahead.popleft()


def pack_block(block: pa.Table, shares: dict[str | None, float] | None = None) -> pa.Table:
    """Pieces of one block; `shares` are by source. Rows are stretches of documents, of one source queue after another."""
    block = block.sort_by([("source_no", "ascending"), ("at", "ascending")])
    number = block["source_no"].to_pylist()
    length = block["length"].to_pylist()
    queues: dict[int, deque[list[int]]] = {}
    for row, source in enumerate(number):
        queues.setdefault(source, deque()).append([row, 0])
    sizes = [(s, sum(length[row] for row, _ in q)) for s, q in queues.items()]
    rows, starts, lengths, sequence, offset = [], [], [], [], []
    window, filled = -1, 0
    named = block["source"].to_pylist() if shares is not None else []
    wanted = None if shares is None else {s: shares.get(named[q[0][0]], 0) for s, q in queues.items()}
    for now, source, tokens in deal(sizes, shares=wanted):
        if now != window:
            window, filled = now, 0
        queue = queues[source]
        while tokens:
            row, used = queue[0]
            take = min(tokens, length[row] - used)
            rows.append(row), starts.append(used), lengths.append(take)
            sequence.append(window), offset.append(filled)
            filled += take
            tokens -= take
            queue[0][1] += take
            if queue[0][1] == length[row]:
                queue.popleft()
    ids = block["ids"].to_pylist()
    wide = [memoryview(np.frombuffer(x, dtype="<u2").astype("<u4")).cast("B") for x in ids]
    cut = [ids[r][2 * s : 2 * (s + n)] for r, s, n in zip(rows, starts, lengths)]
    crc = [zlib.crc32(wide[r][4 * s : 4 * (s + n)]) for r, s, n in zip(rows, starts, lengths)]
    taken = block.take(pa.array(rows, pa.int64()))
    first = taken["start"].to_numpy() + np.array(starts, dtype=np.int64)
    block_no = taken["block"].to_numpy()
    return pa.table(
        {
            "doc_id": taken["doc_id"],
            "source": taken["source"],
            "start": first,
            "length": pa.array(lengths, pa.int64()),
            "ids": pa.array(cut, pa.binary()),
            "ids_crc32": pa.array(crc, pa.int64()),
            "doc_tokens": taken["doc_tokens"],
            "sequence_id": (block_no << 32) + np.array(sequence, dtype=np.int64),
            "offset": pa.array(offset, pa.int64()),
        }
    )


def _floor_ratio(a: Column, b: Column, c: Column) -> Column:
    """a * b // c of non-negative whole numbers, without overflow."""
    product = a.cast("decimal(19,0)") * b.cast("decimal(19,0)")
    return F.floor((product - product % c.cast("decimal(19,0)")) / c.cast("decimal(19,0)")).cast("long")


def _cut_by_shares(
    placed: DataFrame, parts: DataFrame, shares: dict[str | None, float], total: int, blocks: int
) -> DataFrame:
    """Stretches of documents by block (row, source_no, block, at, start, length) for another mixture."""
    wanted = F.col("source").isin(*[s for s in shares if s is not None])
    if None in shares:
        wanted = F.coalesce(wanted, F.lit(True))
    # As many sources as the caller names.
    named = parts.filter(wanted).select("source", "source_no", "all").distinct().collect()
    lines = due_lines({r["source_no"]: r["all"] for r in named}, {r["source_no"]: shares[r["source"]] for r in named}, total)
    first_rest = sum(r["all"] for r in named if shares[r["source"]])
    bounds = np.array([total * b // blocks for b in range(blocks + 1)], dtype=np.float64)

    def cuts(source: int, size: int) -> np.ndarray:
        line = lines.get(source, ([0.0, first_rest, total], [0.0, 0.0, size]))
        return np.append(np.floor(np.interp(bounds[:-1], *line)).astype(np.int64), size)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, source, size, start, n = (batch[c].to_numpy() for c in ("row", "source_no", "all", "from", "n_tokens"))
            for s in np.unique(source):
                own = source == s
                cut = cuts(int(s), int(size[own][0]))
                begin, end = start[own], start[own] + n[own]
                low = np.searchsorted(cut, begin, side="right") - 1
                times = np.searchsorted(cut, end - 1, side="right") - low
                at = np.repeat(np.arange(len(begin)), times)
                block = low[at] + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                first = np.maximum(begin[at], cut[block])
                length = np.minimum(end[at], cut[block + 1]) - first
                # A block may have no token of the source.
                full = length > 0
                arrays = (row[own][at], np.full(len(at), s), block, first, first - begin[at], length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[full], pa.int64()) for x in arrays], names=["row", "source_no", "block", "at", "start", "length"]
                )

    schema = "row bigint, source_no bigint, block bigint, at bigint, start bigint, length bigint"
    return placed.select("row", "source_no", "all", "from", "n_tokens").mapInArrow(split, schema)


def pack(
    documents: DataFrame, path: str, block_tokens: int = BLOCK_TOKENS, shares: dict[str | None, float] | None = None
) -> DataFrame:
    """Pieces of all documents: doc_id, source, start, length, ids, ids_crc32, doc_tokens,
    sequence_id, offset.

    `shares` maps sources (None for null) to their target shares, in any unit; the default is
    their tokens in the whole table. Every token is packed whatever the shares: when a queue is
    exhausted, the others go on in the proportions they have among themselves, and sources
    without a share follow when all that have one are exhausted. A null text has the end id only; a null
    source is a queue of its own; every row counts, repeated ones too. Sequences are full but
    for the last of each block. An empty table has no piece.
    """
    if shares is not None and not (all(0 <= x < inf for x in shares.values()) and any(shares.values())):
        raise ValueError("shares are finite, not negative, and not all zero")
    ship(documents.sparkSession)
    tokens = stored(tokenize(documents, path).withColumn("row", F.monotonically_increasing_id()), "zstd")
    part = F.shiftright("row", 33)
    sizes = tokens.select("row", "source", "n_tokens", part.alias("part"))
    # Offsets in the queue: running totals within parts of the table, then of the parts.
    parts = sizes.groupBy("source", "part").agg(F.sum("n_tokens").alias("tokens"))
    queue = Window.partitionBy("source")
    parts = parts.withColumns(
        {
            "before": F.sum("tokens").over(queue.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
            "all": F.sum("tokens").over(queue),
        }
    )
    total = parts.agg(F.sum("tokens")).first()[0] or 0
    block_count = max(ceil(total / block_tokens), 1)
    blocks = F.lit(block_count).cast("long")
    parts = parts.withColumn("source_no", F.xxhash64("source"))
    inside = Window.partitionBy("source", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .withColumnRenamed("source", "s")
        .withColumnRenamed("part", "p")
        .join(parts, F.col("s").eqNullSafe(F.col("source")) & (F.col("p") == F.col("part")))
        .select("row", "source_no", "all", (F.coalesce("before", F.lit(0)) + F.col("inside")).alias("from"), "n_tokens")
    )
    last = F.col("from") + F.col("n_tokens") - 1
    block_of = lambda x: _floor_ratio((x + 1), blocks, F.col("all")) - F.when(
        (((x + 1).cast("decimal(19,0)") * blocks.cast("decimal(19,0)")) % F.col("all").cast("decimal(19,0)")) == 0, 1
    ).otherwise(0)
    cut = placed.withColumn("block", F.explode(F.sequence(block_of(F.col("from")), block_of(last))))
    low = F.greatest("from", _floor_ratio(F.col("all"), F.col("block"), blocks))
    high = F.least(last + 1, _floor_ratio(F.col("all"), F.col("block") + 1, blocks))
    cut = cut.select("row", "source_no", "block", low.alias("at"), (low - F.col("from")).alias("start"), (high - low).alias("length"))
    if shares is not None:
        cut = _cut_by_shares(placed, parts, shares, total, block_count)
    stretches = tokens.join(cut, "row").select(
        "doc_id",
        "source",
        "source_no",
        "block",
        "at",
        "start",
        "length",
        F.col("n_tokens").alias("doc_tokens"),
        F.expr("substring(ids, cast(2 * start + 1 as int), cast(2 * length as int))").alias("ids"),
    )
    return stretches.groupBy("block").applyInArrow(lambda block: pack_block(block, shares), PIECES)
