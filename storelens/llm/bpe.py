"""Byte-level BPE encoding and decoding by a rank file (operator 4).

Merges of one piece come from a queue with a bucket of list positions for each merge rank.
Two levels of bitmaps say which buckets hold something, and the lowest set bit of each level
leads to the next rank. Nothing is removed from a bucket when a merge makes an entry
stale; such an entry is skipped when it comes up. So a piece of n bytes takes about n
queue steps, however long it is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from storelens.llm.common import add_columns

# A blank and what follows it up to the next one, or blanks but for the last. No match of
# the splitting pattern crosses such a boundary while all blanks are ASCII.
CHUNK = re.compile(rb"\s?\S+|\s+(?=\s\S)|\s+")
# All further code points that some engine takes for blank.
BLANK_POINTS = (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
OTHER_BLANKS = re.compile("[" + "".join(map(chr, BLANK_POINTS)) + "]")
# Chunks and pieces kept by one worker; when full, the store starts anew.
CACHE = 700_000


class Codec:
    """Encodes and decodes as the rank file and the splitting pattern say; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.chunks: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        end = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        pair: list[int | None] = [None] * size
        # Positions by rank, and two levels of bits: of the ranks of a word, and of the words.
        buckets: dict[int, list[int]] = {}
        low: dict[int, int] = {}
        top = 0
        new = [(position, rank_of(piece[position : position + 2])) for position in range(size - 1)]
        while True:
            for position, rank in new:
                pair[position] = rank
                if rank is not None:
                    bucket = buckets.get(rank)
                    if bucket is None:
                        buckets[rank] = [position]
                        word = rank >> 6
                        low[word] = low.get(word, 0) | 1 << (rank & 63)
                        top |= 1 << word
                    else:
                        heappush(bucket, position)
            new = ()
            while top and not new:
                word = (top & -top).bit_length() - 1
                bits = low[word]
                rank = (word << 6) + (bits & -bits).bit_length() - 1
                bucket = buckets[rank]
                left = heappop(bucket)
                if not bucket:
                    del buckets[rank]
                    low[word] = bits = bits & (bits - 1)
                    if not bits:
                        top &= top - 1
                if pair[left] != rank:
                    continue
                right = end[left]
                after = end[left] = end[right]
                pair[right] = None
                ahead = before[left]
                if after < size:
                    before[after] = left
                    new = ((left, rank_of(piece[left : end[after]])),)
                else:
                    new = ((left, None),)
                if ahead >= 0:
                    new += ((ahead, rank_of(piece[ahead:after])),)
            if not new:
                break
        ids, at = [], 0
        while at < size:
            ids.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def _split(self, text: str) -> bytes:
        """Ids of a text, packed as 32-bit numbers."""
        found = []
        for match in self.pattern.findall(text):
            known = self.pieces.get(match)
            if known is None:
                known = np.array(self.piece(match.encode()), dtype=np.int32).tobytes()
                if len(match) < 64:
                    if len(self.pieces) >= CACHE:
                        self.pieces.clear()
                    self.pieces[match] = known
            found.append(known)
        return b"".join(found)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as 32-bit numbers."""
        if OTHER_BLANKS.search(text):
            return np.frombuffer(self._split(text), dtype=np.int32)
        if len(self.chunks) >= CACHE:
            self.chunks.clear()
        known, found = self.chunks, []
        for chunk in CHUNK.findall(text.encode()):
            packed = known.get(chunk)
            if packed is None:
                packed = self._split(chunk.decode())
                if len(chunk) < 64:
                    known[chunk] = packed
            found.append(packed)
        return np.frombuffer(b"".join(found), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file: lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern)


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every document with `ids` (array of int) and `decoded` (binary, from those ids).

    A null text counts as empty and has no ids. Repeated rows are encoded each; further
    columns stay, and columns ids and decoded of the input are replaced. The rank file lies
    under the same path on every machine.
    """

    def both(batch: pa.RecordBatch) -> Iterator[list[pa.Array]]:
        coder = codec(path, pattern)
        ids = [coder.encode(text or "") for text in batch["text"].to_pylist()]
        offsets = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in ids], out=offsets[1:])
        values = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
        return [listed, pa.array([coder.decode(x) for x in ids], pa.binary())]

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return add_columns(documents, fields, both)
