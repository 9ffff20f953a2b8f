"""Quality rules with verdicts on hosts (operator 13).

Every document is measured and tried by rules of its own. Failures are then counted by host,
and a host's rate of failure is drawn towards the other hosts' by a beta prior, which is fitted
to the hosts themselves by the method of moments. A host whose rate stays high after that is
rejected with all its documents; a host of few documents hardly moves from the prior.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import SPACES, add_columns, stored, word_bounds

WINDOW = 8
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
# A host is rejected if its drawn rate of failing documents is beyond this.
REJECT_ABOVE = 0.5
# The prior counts as so many documents at least and at most, however alike hosts are.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0


def _spread(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring starts; the last start is the end."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def _numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each of some pieces of a byte array, the same for equal pieces only."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    bare = data[np.cumsum(inside[:-1]) > 0]
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(bare)])
    return pieces.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair of numbers, the same for equal pairs only."""
    return np.unique(left * (right.max(initial=0) + 1) + right, return_inverse=True)[1].astype(np.int64)


def measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of some texts; windows and lines are compared as a whole, not by a hash."""
    n = len(texts)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    # Each text ends with a line break, so that neither words nor lines reach into the next.
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    start, end = word_bounds(data)
    first = np.searchsorted(start, bounds)
    inner = ((data & 0xC0) != 0x80) & ~SPACES[data]
    found = {"n_words": np.diff(first), "word_chars": _spread(inner, bounds), "n_symbols": _spread(SYMBOLS[data], bounds)}

    line_end = np.flatnonzero(data == ord("\n"))
    line_start = np.concatenate([[0], line_end[:-1] + 1]).astype(np.int64) if len(line_end) else line_end
    filled = _spread(~SPACES[data], np.concatenate([line_start, [len(data)]])) > 0
    line_start, line_end = line_start[filled], line_end[filled]
    owner = np.searchsorted(bounds, line_start, side="right") - 1
    line = _numbers(data, line_start, line_end)
    distinct = np.unique(_pairs(owner, line), return_index=True)[1] if len(line) else np.zeros(0, dtype=np.int64)
    found["n_lines"] = np.bincount(owner, minlength=n)
    found["n_dup_lines"] = found["n_lines"] - np.bincount(owner[distinct], minlength=n)

    repeated = np.zeros(len(start) + 1, dtype=np.int64)
    if len(start) >= WINDOW:
        # The words of 1, 2, 4, then 8 places have a number; windows across texts fall out.
        window, width = _numbers(data, start, end), 1
        while width < WINDOW:
            window, width = _pairs(window[:-width], window[width:]), 2 * width
        of_word = np.searchsorted(bounds, start, side="right") - 1
        place = np.flatnonzero(of_word[: len(window)] == of_word[WINDOW - 1 :])
        if len(place):
            _, same, count = np.unique(_pairs(of_word[place], window[place]), return_inverse=True, return_counts=True)
            place = place[count[same] > 1]
            np.add.at(repeated, place, 1)
            np.add.at(repeated, place + WINDOW, -1)
    found["n_repeat_words"] = _spread(np.cumsum(repeated[:-1]) > 0, first)
    return found


def measured(documents: DataFrame) -> DataFrame:
    """The documents with their measures; a null text has no words."""

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        found = measures([(t or "").encode() for t in batch["text"].to_pylist()])
        return [pa.array(found[name], pa.int64()) for name in MEASURES]

    return add_columns(documents, [T.StructField(name, T.LongType()) for name in MEASURES], columns)


def rules() -> dict[str, Column]:
    """Failures of a document, by name; whole numbers, so that no rounding decides."""
    words = F.col("n_words")
    return {
        "short": words < 20,
        "repeats": 100 * F.col("n_repeat_words") > 30 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "word_length": (words > 0) & ((F.col("word_chars") < 3 * words) | (F.col("word_chars") > 10 * words)),
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


BASE = ("short", "repeats")


class Prior(NamedTuple):
    """A beta distribution of the hosts' rates."""

    rate: float
    weight: float


def fit_prior(hosts: DataFrame) -> Prior:
    """The prior of hosts with `docs` and `failed`; the driver gets one row of sums.

    The spread of rates beyond what chance gives for hosts of their sizes sets the weight: that
    of a beta-binomial with the same mean and the same weighted variance.
    """
    docs, failed = F.col("docs").cast("double"), F.col("failed").cast("double")
    k, n, bad, squares, spread = hosts.agg(
        F.count(F.lit(1)), F.sum(docs), F.sum(failed), F.sum(docs * docs), F.sum(failed * failed / docs)
    ).first()
    if not k:
        return Prior(0.0, MOST_PRIOR)
    rate = bad / n
    within = rate * (1 - rate)
    expected = n - squares / n
    if k < 2 or within == 0 or expected <= k - 1:
        return Prior(rate, MOST_PRIOR)
    # Of the weighted variance, chance alone gives (k - 1) parts; the rest grows with size.
    alike = (spread - n * rate * rate - (k - 1) * within) / ((expected - (k - 1)) * within)
    weight = (1 - alike) / alike if alike > 0 else MOST_PRIOR
    return Prior(rate, min(max(weight, LEAST_PRIOR), MOST_PRIOR))


def host_verdicts(tried: DataFrame, host: str, reject_above: float = REJECT_ABOVE) -> DataFrame:
    """Host, docs, failed, counts of each rule's failures, drawn rate, rejected.

    Failures are counted before they move, so a host of many documents is one row a task.
    """
    counts = [F.count_if(F.array_contains("failures", name)).alias(f"failed_{name}") for name in rules()]
    hosts = tried.filter(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(F.size("failures") > 0).alias("failed"), *counts
    )
    hosts = stored(hosts)
    prior = fit_prior(hosts)
    drawn = (F.col("failed") + F.lit(prior.rate * prior.weight)) / (F.col("docs") + F.lit(prior.weight))
    return hosts.withColumn("rate", drawn).withColumn("rejected", F.col("rate") > reject_above)


def judge(documents: DataFrame, host: str = "source", reject_above: float = REJECT_ABOVE) -> DataFrame:
    """Every document, without its text, with measures, `failures`, `host_rate`, base_failed, kept.

    A document is kept if it does not fail a base rule and its host is not rejected. Without a
    host (null) the document stands alone. Null and empty texts have no words, so they fail;
    repeated rows count as often as they are there; a very long text is measured whole, by one
    task, with some 60 bytes a word. Columns of these names in the input are replaced. Without
    rows there is no prior and no row.
    """
    made = ("failures", "host_rate", "base_failed", "kept")
    failures = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules().items()]))
    kept = [c for c in documents.columns if c not in made]
    tried = stored(measured(documents.select(*kept)).drop("text").withColumn("failures", failures))
    hosts = host_verdicts(tried, host, reject_above).select(F.col(host).alias("_host"), F.col("rate").alias("host_rate"), "rejected")
    base = F.arrays_overlap("failures", F.array(*[F.lit(name) for name in BASE]))
    # Stored, so that the join is by size and a host of many documents may be split.
    joined = tried.join(stored(hosts), F.col(host) == F.col("_host"), "left")
    verdict = ~base & ~F.coalesce("rejected", F.lit(False))
    return joined.withColumns({"base_failed": base, "kept": verdict}).drop("_host", "rejected")
