"""Language identification by cross-parsing entropy (operator 6).

For each language, a suffix automaton accepts every substring of a sample of its labelled
text. A document is parsed into phrases, each the longest piece that occurs in the sample;
the number of phrases times log2 of the sample's length estimates the bits that the
document takes in that language. The language that needs fewest wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from storelens.llm.common import fold, ship

# Bounds of the labelled sample of one language: documents in hash order, and of each the
# segments of so many characters that come first by hash, wherever they are in the text.
SAMPLE_DOCUMENTS = 96
SAMPLE_SEGMENTS, SEGMENT = 8, 128
# Symbols: 0 parts words, OTHER is a letter that no sample has, END ends a text. A letter is
# written as one of the others or, from the first of LEADS on, as a lead and 1 to 3 of them.
SYMBOLS = 64
OTHER, END = SYMBOLS - 2, SYMBOLS - 1
LEADS = (49, 59, 61, OTHER)
BLOCK = 1024
UNKNOWN = "und"
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def letter_map(sample: dict[str, list[str]]) -> np.ndarray:
    """Code of each code point: up to four symbols, lowest byte first; 0 for what is no letter.

    Every letter of the samples has a code of its own, the commonest have the short ones. A
    letter counts by its share in each language, so that long samples do not go before others.
    """
    counts: Counter = Counter()
    for texts in sample.values():
        own = Counter(c for text in texts for c in text.lower() if c.isalpha())
        for letter, n in own.items():
            counts[letter] += n / own.total()
    symbols = np.zeros(0x110000, dtype=np.uint32)
    symbols[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
    for code, (letter, _) in zip(letter_codes(), sorted(counts.items(), key=lambda x: (-x[1], x[0]))):
        symbols[ord(letter)] = int.from_bytes(code, "little")
    return symbols


def letter_codes() -> Iterator[bytes]:
    """More codes than there are code points; none begins another."""
    yield from (bytes([k]) for k in range(1, LEADS[0]))
    for more, (first, end) in enumerate(pairwise(LEADS), 1):
        yield from map(bytes, product(range(first, end), *[range(1, OTHER)] * more))


def to_symbols(text: str | None, symbols: np.ndarray) -> np.ndarray:
    """Codes of letters, everything between two letters as one 0."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype=np.uint32)
    found = symbols[points]
    keep = found != 0
    keep[1:] |= found[:-1] != 0
    found = found[keep]
    if not len(found) or found.max() < SYMBOLS:
        return found.astype(np.uint8)
    codes = found.astype("<u4").view(np.uint8).reshape(-1, 4)
    used = codes != 0
    used[:, 0] = True
    return codes[used]


def suffix_automaton(sequence: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in sequence.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            after = moves[state][symbol]
            if length[after] == length[state] + 1:
                link[new] = after
            else:
                copy = len(moves)
                moves.append(dict(moves[after]))
                length.append(length[state] + 1)
                link.append(link[after])
                while state >= 0 and moves[state].get(symbol) == after:
                    moves[state][symbol] = copy
                    state = link[state]
                link[after] = link[new] = copy
        last = new
    return moves


def _parse_table(moves: list[dict[int, int]], first: int) -> np.ndarray:
    """Row per state and symbol: twice the next row's offset, plus one where a phrase ended."""
    start = np.full(SYMBOLS, first * SYMBOLS * 2 + 1, dtype=np.int32)
    for symbol, state in moves[0].items():
        start[symbol] = (first + state) * SYMBOLS * 2 + 1
    start[END] = first * SYMBOLS * 2
    rows = np.tile(start, (len(moves), 1))
    for state, out in enumerate(moves):
        for symbol, after in out.items():
            rows[state, symbol] = (first + after) * SYMBOLS * 2
    return rows


class Languages:
    """The parse tables of all languages, one below another."""

    def __init__(self, sample: dict[str, list[str]]) -> None:
        self.names = sorted(sample)
        self.symbols = letter_map(sample)
        tables, self.roots, self.bits, first = [], [], [], 0
        for name in self.names:
            parts = [to_symbols(text, self.symbols) for text in sample[name]]
            sequence = np.concatenate([np.append(p, 0) for p in parts] or [np.zeros(0, np.uint8)])
            moves = suffix_automaton(sequence)
            tables.append(_parse_table(moves, first))
            self.roots.append(first * SYMBOLS)
            self.bits.append(np.log2(max(len(sequence), 2)))
            first += len(moves)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases that each language needs for each text; all blocks advance side by side."""
        blocks = [max(-(-len(t) // BLOCK), 1) for t in texts]
        owner = np.repeat(np.arange(len(texts)), blocks)
        grid = np.full((len(owner), BLOCK), END, dtype=np.uint8)
        flat, at = grid.reshape(-1), 0
        for text, n in zip(texts, blocks):
            flat[at : at + len(text)] = text
            at += n * BLOCK
        state = np.repeat(np.asarray(self.roots, dtype=np.int32)[:, None], len(owner), axis=1)
        count = np.zeros(state.shape, dtype=np.int32)
        for column in np.ascontiguousarray(grid.T):
            state = self.table[state + column]
            count += state & 1
            state >>= 1
        total = np.zeros((len(self.names), len(texts)))
        for row, counts in zip(total, count):
            np.add.at(row, owner, counts)
        return total

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        symbols = [to_symbols(text, self.symbols) for text in texts]
        known = np.array([len(s) > 0 for s in symbols], dtype=bool)
        if not self.names:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(symbols), "score": 0.0})
        bits = (self.phrases(symbols) + 1) * np.asarray(self.bits)[:, None]
        best = bits.argmin(axis=0)
        share = 1 / np.exp2(-np.minimum(bits - bits.min(axis=0), 1000)).sum(axis=0)
        names = np.where(known, np.asarray(self.names, dtype=object)[best], UNKNOWN)
        return pd.DataFrame({"lang_pred": names, "score": np.where(known, share, 0.0)})


@lru_cache(maxsize=1)
def languages(sample: tuple[tuple[str, tuple[str, ...]], ...]) -> Languages:
    """Each worker builds the automata itself; the sample is far smaller."""
    return Languages({name: list(texts) for name, texts in sample})


def sample_texts(documents: DataFrame) -> dict[str, list[str]]:
    """Segments of a bounded number of labelled documents of each language, in hash order.

    Segments are drawn from the whole text; a text of SAMPLE_SEGMENTS or fewer is taken whole,
    and neighbours stay joined. A language's documents are ranked by id alone, so the texts of
    the rest never move.
    """
    labelled = documents.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2)
    )
    ranked = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labelled.filter(F.col("text").isNotNull())
        .select("doc_id", "lang")
        .withColumn("place", F.row_number().over(ranked))
        .filter(F.col("place") <= SAMPLE_DOCUMENTS)
        .select("doc_id", "lang")
        .distinct()
    )
    # A bounded number of ids for each language.
    texts = labelled.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    count = F.ceil(F.char_length("text") / SEGMENT)
    ranks = F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)).cast("int") - 1),
        lambda k: F.struct(F.xxhash64("doc_id", k).alias("hash"), k.alias("k")),
    )
    first = F.array_sort(F.transform(F.slice(F.array_sort(ranks), 1, SAMPLE_SEGMENTS), lambda x: x["k"]))
    parts = F.transform(first, lambda k: F.struct(k.alias("k"), F.substring("text", k * SEGMENT + 1, F.lit(SEGMENT)).alias("part")))
    sample: dict[str, list[str]] = {}
    for row in sorted(texts.filter(F.col("text").isNotNull()).select("doc_id", "lang", parts.alias("parts")).collect()):
        runs, last = [], None
        for k, part in row["parts"]:
            if last is not None and k == last + 1:
                runs[-1] += part
            else:
                runs.append(part)
            last = k
        sample.setdefault(row["lang"], []).extend(runs)
    return sample


def identify(documents: DataFrame) -> DataFrame:
    """Every document with lang_pred and score, its share among the languages (0 to 1).

    `und` with score 0 for a null text, one without letters, and if nothing is labelled.
    Equal bits go to the first language by name. Repeated rows are judged each; columns
    lang_pred and score of the input are replaced.
    """
    ship(documents.sparkSession)
    sample = tuple((name, tuple(texts)) for name, texts in sorted(sample_texts(documents).items()))

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield languages(sample).predict(texts)

    found = documents.withColumn("_found", predict(F.coalesce("text", F.lit(""))))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")
