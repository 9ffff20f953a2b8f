"""Document likelihood by a gated recurrent language model (operator 5).

A small GRU reads a document word by word and keeps its state from the first word to the end.
It is trained by truncated backpropagation: gradients stop at the edge of a window of some
words, the state does not. The output softmax is factored: a class of units, then the unit in
its class. A unit is the end of a text, a common word, or a sub-class of rare words with like
endings; in a sub-class a word's probability comes from its smoothed count, so that any text
has a probability. Common words, sub-classes and classes follow the training vocabulary: every
word above a count is common, and the rarer the words the wider their class.

Tasks train on their own documents and the weights are averaged, in rounds over growing parts
of the corpus; every training document is used once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import heapreplace
from itertools import filterfalse
from math import isqrt, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import row_key, ship, stored

HIDDEN, EMBEDDED = 16, 16
# Units of the first classes, and places of common words in the smallest vocabulary.
CLASS_WORDS = 64
COMMON = 31 * CLASS_WORDS
# A common word occurs so often, and as often as the root of all tokens divided by ROOTS.
LEAST_COUNT, ROOTS = 10, 100
# Rare words belong to sub-classes by their last bytes.
ENDING = 3
# Numbers in a stored piece of a weight vector.
PIECE = 1 << 18
WINDOW = 32
STREAMS = 256
# Logits that are computed at a time, and tokens that are scored together.
BLOCK, TOGETHER = 1 << 16, 1 << 16
TEXTS = 10_000
RATE = 0.15
# Eighths of the corpus that a round trains on.
ROUNDS = ((0,), (1, 2), (3, 4, 5, 6, 7))
END = 0
NAMES = ("embed", "into", "again", "gate", "class_w", "class_b", "word_w", "word_b")


def ending_class(word: bytes, rare: int) -> int:
    return crc32(word[-ENDING:]) % rare


def ending_column(word: str, rare: int) -> Column:
    """The same in SQL."""
    return F.crc32(F.substring(F.col(word).cast("binary"), -ENDING, ENDING)) % rare


def class_bounds(common: int, rare: int) -> np.ndarray:
    """First unit of each class, and the end. Units are in order of frequency, rare sub-classes last."""
    bounds = [0]
    while bounds[-1] < common:
        at = bounds[-1]
        bounds.append(min(at + (CLASS_WORDS if at < COMMON else 4 * isqrt(at)), common))
    return np.array([*bounds, *range(common + CLASS_WORDS, common + rare, CLASS_WORDS), common + rare])


class Vocabulary(dict):
    """Units of words: 0 ends a document, common words follow, then sub-classes from `places` on."""

    def __init__(self, common: list[bytes], places: int, rare: int) -> None:
        super().__init__((word, k + 1) for k, word in enumerate(common))
        self.size, self.places, self.rare = len(self), places, rare

    def __missing__(self, word: bytes) -> int:
        unit = self.places + ending_class(word, self.rare)
        if len(self) > self.size + 500_000:
            for old in list(self)[self.size :]:
                del self[old]
        if len(word) < 64:
            self[word] = unit
        return unit

    def numbers(self, text: str | None) -> np.ndarray:
        """Of the words and the end."""
        words = (text or "").encode().lower().split()
        units = np.empty(len(words) + 1, dtype=np.int32)
        units[:-1] = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        units[-1] = END
        return units


def start_weights(counts: np.ndarray, tail: float | np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights; biases give the units' shares.

    `counts` are those of END and common words, `tail` those of the sub-classes.
    """
    rng = np.random.default_rng(11)
    tail = np.atleast_1d(tail)
    common = max(COMMON, len(counts))
    full = np.zeros(common + len(tail))
    full[: len(counts)] = counts
    full[common:] = tail
    full += 0.5
    bounds = class_bounds(common, len(tail))
    classes = np.add.reduceat(full, bounds[:-1])
    normal = lambda *shape: rng.normal(0, 0.1, shape)
    weights = {
        "embed": normal(len(full), EMBEDDED),
        "into": normal(EMBEDDED, 3 * HIDDEN),
        "again": normal(HIDDEN, 3 * HIDDEN),
        "gate": np.zeros(3 * HIDDEN),
        "class_w": normal(HIDDEN, len(classes)),
        "class_b": np.log(classes / classes.sum()),
        "word_w": normal(len(full), HIDDEN).T,
        "word_b": np.log(full / np.repeat(classes, np.diff(bounds))),
    }
    return {name: weights[name].astype(np.float32, order="C") for name in NAMES}


def pack_weights(weights: dict[str, np.ndarray]) -> bytes:
    return b"".join(weights[name].astype(np.float32).tobytes() for name in NAMES)


def unpack_weights(data: bytes, places: int, rare: int) -> dict[str, np.ndarray]:
    units, classes = places + rare, len(class_bounds(places, rare)) - 1
    wide = 3 * HIDDEN
    shapes = [(units, EMBEDDED), (EMBEDDED, wide), (HIDDEN, wide), (wide,), (HIDDEN, classes), (classes,), (HIDDEN, units), (units,)]
    flat, at, weights = np.frombuffer(data, dtype=np.float32), 0, {}
    for name, shape in zip(NAMES, shapes):
        size = int(np.prod(shape))
        weights[name] = flat[at : at + size].reshape(shape).copy()
        at += size
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.tanh(x * 0.5)
    x += 1.0
    x *= 0.5
    return x


def _softmax(
    states: np.ndarray, w: np.ndarray, goal: np.ndarray, room: np.ndarray, scale: float, top: bool
) -> tuple[list[np.ndarray], ...]:
    """Logits of the goals and sums of exponentials of some states; gradients by states and `w`.

    States end in a 1, the last row of `w` is the bias. Gradients are those of `scale` times the
    log probability, there are none if it is 0. Rows are taken in blocks whose logits fit `room`,
    which stays in a processor's cache; the sums divide the few columns of the states and not the
    logits. With `top` the greatest logit of a state becomes 0.
    """
    width = w.shape[1]
    rows = max(len(room) // width, 1)
    ones = np.ones(width, dtype=w.dtype)
    picked, totals, backs, grads = [], [], [], []
    for at in range(0, len(goal), rows):
        own, aim = states[at : at + rows], goal[at : at + rows]
        flat = room[: len(aim) * width] if width <= len(room) else np.empty(width, dtype=w.dtype)
        logits = flat.reshape(len(aim), width)
        np.matmul(own, w, out=logits)
        if top:
            logits -= logits.max(axis=1, keepdims=True)
        place = np.arange(0, len(aim) * width, width) + aim
        picked.append(flat[place])
        np.exp(flat, out=flat)
        total = logits @ ones
        totals.append(total)
        if scale:
            share = (-scale / total)[:, None]
            flat[place] -= total
            back = logits @ w[:HIDDEN].T
            back *= share
            backs.append(back)
            grads.append((own * share).T @ logits)
    return picked, totals, backs, grads


class Streams:
    """Documents laid end to end in parallel streams, longest stream first."""

    def __init__(self, documents: list[np.ndarray]) -> None:
        width = min(STREAMS, max(len(documents), 1))
        load = [(0, s) for s in range(width)]
        own: list[list[int]] = [[] for _ in range(width)]
        for d in sorted(range(len(documents)), key=lambda d: (-len(documents[d]), d)):
            size, s = load[0]
            own[s].append(d)
            heapreplace(load, (size + len(documents[d]), s))
        own.sort(key=lambda ds: -sum(len(documents[d]) for d in ds))
        self.length = np.array([sum(len(documents[d]) for d in ds) for ds in own], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        laid = [d for ds in own for d in ds]
        sizes = [len(documents[d]) for d in laid]
        self.target = np.concatenate([documents[d] for d in laid]) if laid else np.zeros(0, dtype=np.int32)
        self.document = np.repeat(np.array(laid, dtype=np.int32), sizes)
        self.first = np.zeros(len(self.target), dtype=bool)
        self.first[np.cumsum(sizes, dtype=np.int64) - sizes] = True

    def windows(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Inputs, targets (-1 beyond a stream's end), documents, and 0 where a document starts, by step and stream."""
        steps = int(self.length[0]) if len(self.length) else 0
        for low in range(0, steps, WINDOW):
            step = np.arange(low, min(low + WINDOW, steps))[:, None]
            active = int((self.length > low).sum())
            length = self.length[:active]
            at = self.start[:active] + np.minimum(step, length - 1)
            beyond, first, target = step >= length, self.first[at], self.target[at]
            inputs = np.where(first | beyond, END, self.target[at - 1])
            target[beyond] = -1
            yield inputs, target, self.document[at], (~first | beyond)[:, :, None].astype(np.float32)


class Model:
    """Weights by name; `joint` has the arrays that are trained, where biases are the last row of their weights."""

    def __init__(self, weights: dict[str, np.ndarray], places: int = COMMON) -> None:
        self.joint = {name: weights[name] for name in NAMES[:4]}
        for side in ("class", "word"):
            self.joint[side] = np.concatenate([weights[f"{side}_w"], weights[f"{side}_b"][None]])
        self.w = self.named(self.joint)
        self.bounds = class_bounds(places, len(weights["word_b"]) - places)
        self.number = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        self.squares = {name: np.full_like(w, 1e-6) for name, w in self.joint.items()}
        self.room = np.empty(BLOCK, dtype=weights["word_w"].dtype)

    @staticmethod
    def named(joint: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Views of joint arrays by the names of the weights."""
        sides = {f"{side}_{x}": joint[side][rows] for side in ("class", "word") for x, rows in (("w", slice(HIDDEN)), ("b", HIDDEN))}
        return {name: sides[name] if name in sides else joint[name] for name in NAMES}

    def run(self, inputs: np.ndarray, keep: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each step of a window, and what backpropagation needs."""
        w = self.w
        into = w["embed"][inputs] @ w["into"] + w["gate"]
        states, steps = np.empty((*inputs.shape, HIDDEN), np.float32), []
        for t in range(len(inputs)):
            before = state * keep[t]
            again = before @ w["again"]
            gates = _sigmoid(into[t, :, : 2 * HIDDEN] + again[:, : 2 * HIDDEN])
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(into[t, :, 2 * HIDDEN :] + reset * again[:, 2 * HIDDEN :])
            state = new + update * (before - new)
            states[t] = state
            steps.append((before, again, update, reset, new))
        return states, steps

    def outputs(self, states: np.ndarray, target: np.ndarray, scale: float, top: bool = False):
        """Natural log probability of each target, and gradients of `scale` times their sum as `parts` has them."""
        flat, goal = states.reshape(-1, HIDDEN), np.minimum(target.ravel(), len(self.number) - 1)
        # Rows in order of class, without those that have no target.
        number = np.where(goal < 0, -1, self.number[goal])
        order = np.argsort(number, kind="stable")
        order = order[np.searchsorted(number[order], 0) :]
        number = number[order]
        place = goal[order] - self.bounds[number]
        own = np.ones((len(order), HIDDEN + 1), dtype=flat.dtype)
        own[:, :HIDDEN] = flat[order]
        ends = np.searchsorted(number, np.arange(len(self.bounds)))
        parts = []
        with np.errstate(all="ignore"):
            picked, totals, backs, grads = _softmax(own, self.joint["class"], number, self.room, scale, top)
            if grads:
                parts.append(("class", ..., sum(grads)))
            class_backs, backs = backs, []
            for c in np.flatnonzero(np.diff(ends)).tolist():
                rows, units = slice(ends[c], ends[c + 1]), slice(self.bounds[c], self.bounds[c + 1])
                found = _softmax(own[rows], self.joint["word"][:, units], place[rows], self.room, scale, top)
                picked += found[0]
                totals += found[1]
                backs += found[2]
                if found[3]:
                    parts.append(("word", (slice(None), units), sum(found[3]) if len(found[3]) > 1 else found[3][0]))
            picked, totals = (np.concatenate([x.ravel() for x in xs] or [np.zeros(0)]) for xs in (picked, totals))
            fits = len(order) == 0 or (picked.min() > -60 and totals.min() > 1e-25 and totals.max() < 1e25)
        if not fits and not top:
            # A float holds no exponentials of such logits.
            return self.outputs(states, target, scale, True)
        logp, back = np.zeros(len(goal)), np.zeros_like(flat) if scale else None
        logp[order] = (picked - np.log(totals)).reshape(2, -1).sum(axis=0)
        if scale:
            if len(order):
                back[order] = np.concatenate(class_backs) + np.concatenate(backs)
            back = back.reshape(states.shape)
        return logp.reshape(target.shape), parts, back

    def parts(self, inputs: np.ndarray, target: np.ndarray, keep: np.ndarray, state: np.ndarray, scale: float):
        """Gradients of `scale` times a window's log likelihood, and the state after the window.

        They are (joint array, place in it, gradient). Places that are not listed have none: those
        of words that are no input, and of classes without a target.
        """
        w = self.w
        states, steps = self.run(inputs, keep, state)
        _, parts, back = self.outputs(states, target, scale)
        into, own = (np.empty((*inputs.shape, 3 * HIDDEN), np.float32) for _ in range(2))
        befores = np.empty(states.shape, np.float32)
        later, again_w = np.zeros_like(state), w["again"].T
        for t in range(len(inputs) - 1, -1, -1):
            before, again, update, reset, new = steps[t]
            d = back[t] + later
            d_new = d * (1 - update) * (1 - new * new)
            into[t, :, :HIDDEN] = d * (before - new) * update * (1 - update)
            into[t, :, HIDDEN : 2 * HIDDEN] = d_new * again[:, 2 * HIDDEN :] * reset * (1 - reset)
            into[t, :, 2 * HIDDEN :] = d_new
            own[t] = into[t]
            own[t, :, 2 * HIDDEN :] *= reset
            befores[t] = before
            later = (d * update + own[t] @ again_w) * keep[t]
        flat = into.reshape(-1, 3 * HIDDEN)
        again = befores.reshape(-1, HIDDEN).T @ own.reshape(-1, 3 * HIDDEN)
        seen = inputs.ravel()
        order = np.argsort(seen, kind="stable")
        starts = np.flatnonzero(np.diff(seen[order], prepend=-1))
        rows = seen[order[starts]]
        embed = np.add.reduceat((flat @ w["into"].T)[order], starts, axis=0)
        parts += [("again", ..., again), ("into", ..., w["embed"][seen].T @ flat), ("gate", ..., flat.sum(axis=0))]
        return [*parts, ("embed", rows, embed)], states[-1]

    def gradients(self, inputs: np.ndarray, target: np.ndarray, keep: np.ndarray, state: np.ndarray):
        """Of a window's log likelihood, by weight; and the state after the window."""
        parts, state = self.parts(inputs, target, keep, state, 1.0)
        grads = {name: np.zeros_like(w) for name, w in self.joint.items()}
        for name, place, part in parts:
            grads[name][place] = part
        return self.named(grads), state

    def learn(self, inputs: np.ndarray, target: np.ndarray, keep: np.ndarray, state: np.ndarray) -> np.ndarray:
        """One Adagrad step up the mean log likelihood of a window; the state after it."""
        parts, state = self.parts(inputs, target, keep, state, 1 / max(int((target >= 0).sum()), 1))
        for name, place, step in parts:
            # Of outputs no mean gradient is beyond 1, for no state or error of a probability is.
            if name in NAMES:
                np.clip(step, -1, 1, out=step)
            square = self.squares[name][place]
            square += step * step
            if name == "embed":
                self.squares[name][place] = square
            step /= np.sqrt(square)
            step *= RATE
            self.joint[name][place] += step
        return state

    def train(self, documents: list[np.ndarray]) -> None:
        state = np.zeros((0, HIDDEN), np.float32)
        for k, (inputs, target, _, keep) in enumerate(Streams(documents).windows()):
            state = np.zeros((inputs.shape[1], HIDDEN), np.float32) if k == 0 else state[: inputs.shape[1]]
            state = self.learn(inputs, target, keep, state)

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each document's units; outputs are taken for some windows together."""
        total = np.zeros(len(documents))
        state, waiting, rows = np.zeros((0, HIDDEN), np.float32), [], 0

        def add() -> None:
            states, target, document = map(np.concatenate, zip(*waiting))
            logp, _, _ = self.outputs(states, target, 0)
            total[:] += np.bincount(document, logp, minlength=len(documents))
            waiting.clear()

        for k, (inputs, target, document, keep) in enumerate(Streams(documents).windows()):
            state = np.zeros((inputs.shape[1], HIDDEN), np.float32) if k == 0 else state[: inputs.shape[1]]
            states, _ = self.run(inputs, keep, state)
            state = states[-1]
            met = target >= 0
            waiting.append((states[met], target[met], document[met]))
            rows += len(waiting[-1][1])
            if rows >= TOGETHER:
                add()
                rows = 0
        if waiting:
            add()
        return total / np.log(10)


def word_counts(texts: DataFrame) -> DataFrame:
    """word (A-Z in lower case), n: tokens of a corpus; the empty word is the end of a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"]
            )

        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                found.update((text or "").encode().lower().split())
                found[b""] += 1
                if len(found) > 300_000:
                    yield batch_of(found)
                    found = Counter()
        yield batch_of(found)

    parts = texts.select("text").mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _pieces(part: int, words: int, weights: bytes) -> Iterator[pa.RecordBatch]:
    """Rows (part, piece, words, weights) that hold a weight vector."""
    for piece, at in enumerate(range(0, len(weights), 4 * PIECE)):
        arrays = [pa.array([part], pa.int64()), pa.array([piece], pa.int64()), pa.array([words], pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array([weights[at : at + 4 * PIECE]], pa.binary())], names=["part", "piece", "words", "weights"]
        )


PARTS = "part bigint, piece bigint, words bigint, weights binary"


def _average(parts: DataFrame) -> bytes | None:
    """Mean of weight vectors in pieces, weighted by words; by groups of 16, and again."""

    def mean(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        words = np.array(rows["words"].to_pylist(), dtype=np.float64)
        total = sum(n * np.frombuffer(w, np.float32).astype(np.float64) for n, w in zip(words, rows["weights"].to_pylist()))
        return pa.table(
            {
                "part": pa.array([rows["part"][0].as_py() // 16], pa.int64()),
                "piece": rows["piece"][:1],
                "words": pa.array([int(words.sum())], pa.int64()),
                "weights": pa.array([(total / words.sum()).astype(np.float32).tobytes()], pa.binary()),
            }
        )

    parts = stored(parts)
    while True:
        most = parts.agg(F.max("part")).first()[0]
        if most is None:
            return None
        if most == 0:
            # One vector.
            return b"".join(parts.toArrow().sort_by("piece")["weights"].to_pylist())
        parts = stored(parts.groupBy(F.floor(F.col("part") / 16), "piece").applyInArrow(mean, PARTS))


def train(
    texts: DataFrame, common: list[bytes], weights: dict[str, np.ndarray], places: int, rare: int
) -> dict[str, np.ndarray]:
    """Weights after all rounds; each task trains on what it reads, from the round's first weights."""
    eighth = F.pmod(F.xxhash64("_k1", "_k2"), F.lit(8))
    for eighths in ROUNDS:
        data = pack_weights(weights)

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            vocabulary, words = Vocabulary(common, places, rare), 0
            model = Model(unpack_weights(data, places, rare), places)
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    own = [vocabulary.numbers(t) for t in batch["text"].slice(at, TEXTS).to_pylist()]
                    words += sum(map(len, own))
                    model.train(own)
            if words:
                yield from _pieces(TaskContext.get().partitionId(), words, pack_weights(model.w))

        chosen = texts.filter(eighth.isin(*eighths)).select("text")
        found = _average(chosen.mapInArrow(fit, PARTS))
        weights = weights if found is None else unpack_weights(found, places, rare)
    return weights


def common_words(counts: DataFrame, tokens: int) -> list[tuple[str, int]]:
    """The words above a count that grows slower than the corpus, and at least COMMON - 1 words; commonest first."""
    words = counts.filter("word <> ''")
    often = words.filter(F.col("n") >= max(LEAST_COUNT, isqrt(tokens) // ROOTS)).toArrow()
    if often.num_rows < COMMON - 1:
        often = words.orderBy(F.desc("n"), "word").limit(COMMON - 1).toArrow()
    found = zip(often["word"].to_pylist(), often["n"].to_pylist())
    return sorted(found, key=lambda x: (-x[1], x[0].encode()))


def rare_sums(counts: DataFrame, top: list[tuple[str, int]], kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and kinds of words in each sub-class. Their number follows that of the rare words."""
    left = max(kinds - len(top), 0)
    rare = CLASS_WORDS * max(-(-isqrt(left) // CLASS_WORDS), 1)
    tokens, words = np.zeros(rare, np.int64), np.zeros(rare, np.int64)
    sums = counts.filter("word <> ''").groupBy(ending_column("word", rare).alias("ending"))
    for ending, n, k in sums.agg(F.sum("n"), F.count(F.lit(1))).collect():
        tokens[ending], words[ending] = n, k
    for word, n in top:
        ending = ending_class(word.encode(), rare)
        tokens[ending] -= n
        words[ending] -= 1
    return tokens, words


def score_documents(documents: DataFrame, learn: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every document.

    Learns from the rows where `learn` holds. Scores are log10 probabilities of the words and
    the end of the text; base_score is that of smoothed counts, score the model's. A null text
    counts as empty: its one token is the end. Without any row to learn from, every word is as
    likely as the unknown one. Repeated rows are scored each, and learnt from each.
    """
    ship(documents.sparkSession)
    texts = row_key(documents.select("doc_id", "text", learn.alias("_learn")))
    counts = stored(word_counts(texts.filter("_learn")))
    tokens, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # Words above a share of the corpus that falls with its size.
    top = common_words(counts, tokens)
    ends = counts.filter("word = ''").first()
    common = [word.encode() for word, _ in top]
    known = np.array([ends["n"] if ends else 0, *(n for _, n in top)], dtype=np.float64)
    tail_tokens, tail_kinds = rare_sums(counts, top, kinds)
    places, rare_classes = max(COMMON, len(known)), len(tail_tokens)
    base_all = tokens + kinds + 1
    weights = train(texts.filter("_learn"), common, start_weights(known, tail_tokens), places, rare_classes)
    data = pack_weights(weights)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What units add to a document's scores; counts of rare words are still to come."""
        vocabulary = Vocabulary(common, places, rare_classes)
        model = Model(unpack_weights(data, places, rare_classes), places)
        base = np.full(places + rare_classes, -log10(base_all))
        base[: len(known)] += np.log10(known + 1)
        within = np.zeros(places + rare_classes)
        within[places:] = -np.log10(tail_tokens + tail_kinds + 1)
        seen = np.zeros(places + rare_classes, dtype=np.int64)
        seen[: len(known)] = known > 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                own = [vocabulary.numbers(t) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.select(["_k1", "_k2", "doc_id"]).columns,
                        pa.array([len(x) for x in own], pa.int64()),
                        pa.array([int(seen[x].sum()) for x in own], pa.int64()),
                        pa.array([float(base[x].sum()) for x in own], pa.float64()),
                        pa.array(model.score(own) + [float(within[x].sum()) for x in own], pa.float64()),
                    ],
                    names=["_k1", "_k2", "doc_id", "n_tokens", "known", "base", "nn"],
                )

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of the other words of each document."""
        skip = set(common)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, words, times = [], [], []
                for i, text in enumerate(part["text"].to_pylist()):
                    own = Counter(filterfalse(skip.__contains__, (text or "").encode().lower().split()))
                    rows += [i] * len(own)
                    words += own
                    times += own.values()
                keys = part.select(["_k1", "_k2"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())],
                    names=["_k1", "_k2", "word", "times"],
                )

    keyed = texts.select("_k1", "_k2", "doc_id", "text")
    scored = keyed.mapInArrow(near, "_k1 bigint, _k2 bigint, doc_id bigint, n_tokens bigint, known bigint, base double, nn double")
    scored = stored(scored)
    words = keyed.select("_k1", "_k2", "text").mapInArrow(rare, "_k1 bigint, _k2 bigint, word string, times bigint")
    n = F.coalesce("n", F.lit(0))
    share = F.log10((n + 1).cast("double"))
    added = words.join(counts, "word", "left").select(
        "_k1", "_k2", F.lit(0).alias("copies"), F.when(n > 0, F.col("times")).otherwise(0).alias("met"),
        (F.col("times") * share).alias("share"),
    )
    # Rows that repeat a key bring their words each, and count as copies here.
    marks = scored.select("_k1", "_k2", F.lit(1).alias("copies"), F.lit(0).alias("met"), F.lit(0.0).alias("share"))
    sums = added.unionByName(marks).groupBy("_k1", "_k2").agg(*[F.sum(c).alias(c) for c in ("copies", "met", "share")])
    met, share = (F.col(c) / F.col("copies") for c in ("met", "share"))
    return scored.join(sums, ["_k1", "_k2"]).select(
        "doc_id",
        "n_tokens",
        (F.col("known") + met.cast("long")).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + share).alias("base_score"),
        (F.col("nn") + share).alias("score"),
    )
