"""Language-model scores of whole documents by a gated recurrent network with a class-factored softmax.

**Events.** Words in lower case, one end per document, and one event for any word that no training document has. All words of the
training documents are counted. The network's symbols are the ``LEARNED`` most frequent words, ``ENDINGS`` groups of the other
dictionary words by their last two bytes, and one symbol for all words outside the dictionary, known or not. A word's probability is the
class's, from the network's state, times the word's within its class: a second softmax for learned words; its share of the class's
count for the others; outside the dictionary an unknown word has the share that words seen once have in the training text, which
is how often a word is met for the first time. Over all events the probabilities add up to one. Before training the network gives
every word about its relative frequency.

**Training** is truncated backpropagation in numpy over windows of ``WINDOW`` tokens with the state carried from window to window. Longer
documents are several sequences of ``SEGMENT`` tokens, so that all lanes stay busy. Every training document is used once, in one of ``ROUNDS`` rounds. In a round tasks of about
``TOKENS`` / ``ROUNDS`` tokens train copies of the network side by side; copies are averaged by their tokens, in a tree, before the next round.
More data means more tasks, not longer ones. The result depends on how rows are dealt to tasks only as a trained model does.

**Scoring** runs documents of similar length side by side, carries the state through each from its first token to its end, and adds up
the log probabilities of all tokens. Words outside the
dictionary meet their counts in a join, document by document summed before.

What is sent to tasks is the dictionary (at most ``DICTIONARY`` words) and the network, whatever the corpus; counts stay in a table.

Defined cases: a null or empty text is its end alone. A null document id is never held out. Repeated ids and texts are documents of their own.
Without training documents nothing is known: base and model give the one event left, the unknown, probability one. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import ship

#: folds of documents, and the fold that is held out
FOLDS, HELD_OUT = 5, 1
#: words that tasks know by heart; words and classes of the two softmaxes; groups of other words by their endings
DICTIONARY, LEARNED, CLASSES, ENDINGS = 1 << 17, 512, 16, 16
#: units of the state; tokens between cuts of the gradient, of a training sequence at most; sequences side by side
UNITS, WINDOW, SEGMENT, LANES = 16, 16, 512, 512
#: rounds of training, tokens per trainer in all rounds, step size of the adaptive gradient
ROUNDS, TOKENS, STEP = 4, 4_000_000, 0.5
#: distinct words that a counting task holds before it passes them on; values sent together when networks are averaged
HELD_WORDS, CHUNK, FAN_IN = 400_000, 8192, 32
#: steps of counts that the dictionary's limit is chosen by, per doubling
STEPS = 16
END = b""
LN10 = math.log(10)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8: what ASCII white space separates, A-Z in lower case."""
    return text.lower().split() if text else []


# ---------------------------------------------------------------------------------------------------------- vocabulary
@dataclass(frozen=True)
class Vocabulary:
    """What tasks know of the corpus: the dictionary by number, most frequent first, and totals.

    The arrays by dictionary number have one more entry, for any other word.
    """
    number: dict[bytes, int]
    symbol: np.ndarray
    base: np.ndarray  # log10(count + 0.5); 0 outside the dictionary
    within: np.ndarray  # log10 of the share within the class, where it is fixed; 0 otherwise
    bounds: np.ndarray  # first learned word of each class of learned words, and their number
    class_mass: np.ndarray  # counts per class
    word_mass: np.ndarray  # counts per learned word
    tokens: int
    words: int
    rare_tokens: int  # tokens of training text outside the dictionary
    unknown: float  # share of words never met among those outside the dictionary

    @property
    def n_symbols(self) -> int:
        return len(self.word_mass) + ENDINGS + 1

    @staticmethod
    def of(words: list[bytes], counts: np.ndarray, tokens: int, distinct: int, once: int, twice_known: int) -> Vocabulary:
        """``words`` and their counts by falling count; the end is among the first ``LEARNED``."""
        learned = min(LEARNED, len(words))
        tail = len(words) - learned
        ending = np.array([zlib.crc32(w[-2:]) % ENDINGS for w in words[learned:]], dtype=np.int64)
        group = np.bincount(ending, weights=counts[learned:], minlength=ENDINGS) if tail else np.zeros(ENDINGS)
        root = np.cumsum(np.sqrt(counts[:learned]))
        # classes of equal sums of root counts: few words where they are frequent
        share = np.minimum((root - root[0] / 2) / root[-1] * CLASSES, CLASSES - 1e-9).astype(np.int64) if learned else np.zeros(0, np.int64)
        bounds = np.append(np.flatnonzero(np.diff(share, prepend=-1)), learned)
        rare = tokens - int(counts.sum())
        per_class = np.add.reduceat(counts[:learned], bounds[:-1]) if learned else np.zeros(0)
        within = np.zeros(len(words) + 1)
        within[learned:-1] = np.log10(counts[learned:] / group[ending])
        return Vocabulary(
            {w: i for i, w in enumerate(words)},
            np.concatenate((np.arange(learned), learned + ending, [learned + ENDINGS])).astype(np.uint16),
            np.append(np.log10(counts + 0.5), 0.0), within, bounds,
            np.concatenate((per_class, group, [rare])), counts[:learned].astype(np.float64), tokens, distinct, rare,
            (once + 0.5) / (rare + 2 * twice_known + 1) if rare else 1.0)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over the texts of ``docs`` (text binary), with their ends: the empty word. A written table."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for text in b.column(0):
                held.update(words_of(text.as_buffer().to_pybytes() if text.is_valid else None))
                if len(held) > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "c"])
                    held.clear()
            held[END] += len(b)
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "c"])

    counted = docs.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))
    return cut_lineage(counted.where("c > 0"), "counts")


def _step(c: Column) -> Column:
    return F.floor(F.log2(c) * STEPS).cast("int")


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, Column]:
    """The dictionary of a count table, and which of the table's words are outside it."""
    rows = counts.groupBy(_step(F.col("c")).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()
    size = {r["s"]: (r["n"], int(r["c"])) for r in rows}  # one row per step of counts
    least, held = 0, 0
    for s in sorted(size, reverse=True):  # words met once are never in it: they stand for what is yet unknown
        if s < STEPS or held + size[s][0] > DICTIONARY - 1:
            break
        least, held = s, held + size[s][0]
    inside = (_step(F.col("c")) >= least) & F.lit(held > 0) | (F.col("word") == F.lit(END))
    found = counts.where(inside).toArrow()  # at most DICTIONARY words
    by_count = sorted(zip(found.column("word").to_pylist(), found.column("c").to_pylist()), key=lambda x: (-x[1], x[0]))
    words = [w for w, _ in by_count]
    if END in words and words.index(END) >= LEARNED:
        by_count.insert(LEARNED - 1, by_count.pop(words.index(END)))
    once, twice = size.get(0, (0, 0))[0], size.get(STEPS, (0, 0))[0]
    return Vocabulary.of([w for w, _ in by_count], np.array([c for _, c in by_count], dtype=np.float64), sum(c for _, c in size.values()),
                         sum(n for n, _ in size.values()), once, twice if held and least <= STEPS else 0), ~inside


# ------------------------------------------------------------------------------------------------------------- network
def _shift(w: np.ndarray, b: np.ndarray) -> bool:
    """Whether sums of states (within -1 and 1) and weights can be too large for the exponential in single precision."""
    return bool(w.size) and float(np.abs(w).sum(axis=1).max() + np.abs(b).max()) > 80


def _softmax(p: np.ndarray, bias: np.ndarray, shift: bool, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of the target of each column and all probabilities, in place of ``p``."""
    p += bias[:, None]
    if shift:
        p -= p.max(axis=0)
    mine = p.ravel().take(target * np.intp(p.shape[1]) + np.arange(p.shape[1]))
    np.exp(p, out=p)
    total = np.ones(len(p), dtype=np.float32) @ p
    p *= np.reciprocal(total)
    return mine - np.log(total), p


def _less_one(p: np.ndarray, target: np.ndarray, k: int) -> None:
    """The gradient of the mean loss over ``k`` targets by what went into the softmax, in place of the probabilities."""
    p.ravel()[target * np.intp(p.shape[1]) + np.arange(p.shape[1])] -= 1
    p *= np.float32(1 / k)


class Network:
    """Gated recurrent units over symbols, with a softmax over classes and one within each class of learned words.

    States and sums have one row per unit or class and one column per token, which keeps long loops inside numpy.
    """

    def __init__(self, v: Vocabulary, flat: np.ndarray | None = None, seed: int = 1):
        self.bounds, learned = v.bounds, len(v.word_mass)
        n_classes = len(v.bounds) - 1
        self.class_of = np.concatenate((np.repeat(np.arange(n_classes), np.diff(v.bounds)), n_classes + np.arange(ENDINGS + 1))).astype(np.int16)
        self.start = v.number.get(END, v.n_symbols - 1)
        h, classes = UNITS, len(v.class_mass)
        shapes = [(3 * h, v.n_symbols), (3 * h, h), (classes, h), (classes,), (learned, h), (learned,)]
        if flat is None:
            rng = np.random.default_rng(seed)
            x, u = rng.normal(0, 0.2, shapes[0]), rng.normal(0, 0.7 / math.sqrt(h), shapes[1])
            x[:h] -= 1  # states last
            class_mass, word_mass = np.maximum(v.class_mass, 0.5), np.maximum(v.word_mass, 0.5)
            flat = np.concatenate([a.ravel() for a in (
                x, u, rng.normal(0, 0.05, shapes[2]), np.log(class_mass / class_mass.sum()), rng.normal(0, 0.05, shapes[4]), np.log(word_mass))])
        self.flat = np.array(flat, dtype=np.float32)
        self.parts, at = [], 0
        for s in shapes:
            self.parts.append(self.flat[at: at + math.prod(s)].reshape(s))
            at += math.prod(s)

    def outputs(self, state: np.ndarray, y: np.ndarray, grads: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each symbol ``y`` after its state, and the gradient of their mean loss by the states."""
        _, _, wc, bc, ww, bw = self.parts
        k, cls = len(y), self.class_of[y]
        logp, p = _softmax(wc @ state, bc, _shift(wc, bc), cls)
        d_state = None
        if grads is not None:
            _less_one(p, cls, k)
            grads[2] += p @ state.T
            grads[3] += p.sum(axis=1)
            d_state = wc.T @ p
        order = np.argsort(cls, kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(len(self.bounds)))
        inner, shift = order[:cuts[-1]], _shift(ww, bw)
        states, words, logs = state.take(inner, axis=1), y[inner], np.zeros(len(inner), dtype=np.float32)
        d_inner = np.zeros_like(states)
        for c, (low, high) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())):
            some = slice(cuts[c], cuts[c + 1])
            if cuts[c] == cuts[c + 1] or high - low < 2:
                continue
            s, w, word = states[:, some], ww[low:high], words[some] - low
            logs[some], p = _softmax(w @ s, bw[low:high], shift, word)
            if grads is not None:
                _less_one(p, word, k)
                grads[4][low:high] += p @ s.T
                grads[5][low:high] += p.sum(axis=1)
                d_inner[:, some] = w.T @ p
        logp[inner] += logs
        if grads is not None:
            d_state[:, inner] += d_inner
        return logp, d_state

    def run(self, texts: list[np.ndarray], train: Adaptive | None = None) -> np.ndarray:
        """Log probabilities of symbol sequences, which come by falling length; with ``train`` the network learns on the way."""
        lengths = np.array([len(t) for t in texts])
        flat, starts = np.concatenate(texts).astype(np.int64), np.cumsum(lengths) - lengths
        total, state = np.zeros(len(texts)), np.zeros((UNITS, len(texts)), dtype=np.float32)
        before = np.full(len(texts), self.start)
        low = width = 0
        while (low := low + width) < int(lengths[0]):
            # texts that still have a token, per position of the window: always the first ones
            width = WINDOW if train is not None else max(WINDOW, WINDOW * LANES // int(np.searchsorted(-lengths, -low, side="left")))
            alive = np.searchsorted(-lengths, -np.arange(low, min(low + width, int(lengths[0]))), side="left")
            y = [flat[starts[:n] + low + t] for t, n in enumerate(alive)]
            x = [before[:alive[0]], *(a[:n] for a, n in zip(y, alive[1:]))]
            kept, state = self._forward(x, state[:, :alive[0]])
            before = y[-1]
            grads = None if train is None else [np.zeros_like(p) for p in self.parts]
            logp, d_states = self.outputs(np.concatenate([s[5] for s in kept], axis=1), np.concatenate(y), grads)
            ends = np.cumsum(alive)
            for n, end in zip(alive, ends):
                total[:n] += logp[end - n: end]
            if train is not None:
                self._backward(x, kept, d_states, ends, grads)
                train.step(self.flat, np.concatenate([g.ravel() for g in grads]), len(logp))
        return total

    def _forward(self, xs: list[np.ndarray], state: np.ndarray) -> tuple[list, np.ndarray]:
        """What backpropagation needs of each position of a window, and the states behind it."""
        xw, u = self.parts[:2]
        h, kept = UNITS, []
        inputs = xw.take(np.concatenate(xs), axis=1)
        end = 0
        for x in xs:
            before, end = np.ascontiguousarray(state[:, :len(x)]), end + len(x)
            g, own = inputs[:, end - len(x): end], u @ before
            gates = g[:2 * h] + own[:2 * h]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            z, r, hidden = gates[:h], gates[h:], own[2 * h:]
            c = r * hidden
            c += g[2 * h:]
            np.tanh(c, out=c)
            state = c - before
            state *= z
            state += before
            kept.append((before, z, r, hidden, c, state))
        return kept, state

    def _backward(self, xs, kept, d_states, ends, grads) -> None:
        u, h = self.parts[1], UNITS
        by_input = np.empty((3 * h, ends[-1]), dtype=np.float32)
        carry = np.zeros((h, 0), dtype=np.float32)
        for (before, z, r, hidden, c, _), end in zip(reversed(kept), ends[::-1]):
            n = z.shape[1]
            d = d_states[:, end - n: end]
            d[:, :carry.shape[1]] += carry
            g = np.empty((3 * h, n), dtype=np.float32)
            keep = 1 - z
            dz = d * z
            dc = dz * (1 - c * c)
            g[:h] = dz * (c - before) * keep
            dr = dc * r
            g[h: 2 * h] = dr * hidden * (1 - r)
            g[2 * h:] = dr
            grads[1] += g @ before.T
            carry = u.T @ g
            carry += d * keep
            g[2 * h:] = dc
            by_input[:, end - n: end] = g
        x = np.concatenate(xs)
        cells = (np.arange(3 * h) * grads[0].shape[1])[:, None] + x
        grads[0] += np.bincount(cells.ravel(), weights=by_input.ravel(), minlength=grads[0].size).reshape(grads[0].shape)


class Adaptive:
    """Steps that shrink, per value, with the squares of the gradients seen."""

    def __init__(self, squares: np.ndarray):
        self.squares = squares.astype(np.float32)
        self.tokens = 0

    def step(self, values: np.ndarray, gradient: np.ndarray, tokens: int) -> None:
        # the mean over few tokens is a rough estimate
        gradient *= min(1.0, tokens / (WINDOW * LANES / 4))
        size = float(np.sqrt((gradient * gradient).sum()))
        if size > 1:
            gradient /= size
        self.squares += gradient * gradient
        values -= STEP * gradient / np.sqrt(self.squares)
        self.tokens += tokens


def lanes(symbols: pa.Array, segment: int | None = None) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Rows of a batch in groups of ``LANES`` of similar length, longest first: their places and symbols.

    With ``segment`` texts are cut into sequences of at most so many tokens, and groups come in no order of length.
    """
    texts = [np.frombuffer(t.as_buffer(), dtype=np.uint16) for t in symbols]
    if segment is not None:
        texts = [t[i: i + segment] for t in texts for i in range(0, len(t), segment)]
    order = np.argsort([-len(t) for t in texts], kind="stable")
    groups = [order[i: i + LANES] for i in range(0, len(order), LANES)]
    for g in range(len(groups)) if segment is None else np.random.default_rng(len(groups)).permutation(len(groups)):
        yield groups[g], [texts[i] for i in groups[g]]


# ---------------------------------------------------------------------------------------------------------------- jobs
def encode(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """Documents (doc, held_out, turn, text) as symbols, with what is known of their words without the network. A written table.

    ``rare`` holds the words outside the dictionary with their numbers; ``row`` names a row of the table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(v)
    carried = {f.name: f.dataType.simpleString() for f in docs.schema if f.name != "text"}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        number, other = v.number.get, len(v.number)
        end = number(END, other)
        for b in batches:
            n_tokens, n_known, base, within, symbols, rare = [], [], [], [], [], []
            for text in b.column(b.schema.get_field_index("text")):
                words = words_of(text.as_buffer().to_pybytes() if text.is_valid else None)
                ids = np.fromiter(map(number, words, repeat(other)), dtype=np.int64, count=len(words))
                outside = np.flatnonzero(ids == other)
                ids = np.append(ids, end)
                n_tokens.append(len(ids))
                n_known.append(int((ids != other).sum()))
                base.append(float(v.base[ids].sum()))
                within.append(float(v.within[ids].sum()))
                symbols.append(v.symbol[ids].tobytes())
                rare.append([{"word": w, "n": n} for w, n in Counter(words[i] for i in outside).items()])
            kept = [b.column(b.schema.get_field_index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base), pa.array(within),
                 pa.array(symbols, pa.binary()), pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))],
                [*carried, "n_tokens", "n_known", "base", "within", "symbols", "rare"])

    fields = ", ".join(f"{k} {t}" for k, t in carried.items())
    coded = docs.select(*carried, "text").mapInArrow(
        run, f"{fields}, n_tokens bigint, n_known bigint, base double, within double, symbols binary, rare array<struct<word:binary,n:bigint>>")
    return cut_lineage(coded.withColumn("row", F.monotonically_increasing_id()), "encoded")


def train(coded: DataFrame, v: Vocabulary) -> np.ndarray:
    """The network's values after all rounds over the training rows (``turn`` 0 and up)."""
    spark = coded.sparkSession
    flat = Network(v).flat
    squares = np.full_like(flat, 1e-3)
    trainers = max(1, math.ceil(v.tokens / TOKENS))
    vocab = spark.sparkContext.broadcast(v)
    for turn in range(ROUNDS):
        given = spark.sparkContext.broadcast((flat, squares))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net, steps = Network(vocab.value, given.value[0]), Adaptive(given.value[1].copy())
            for b in batches:
                for _, texts in lanes(b.column(0), SEGMENT):
                    net.run(texts, steps)
            if steps.tokens:
                values = np.concatenate((net.flat, steps.squares)).astype(np.float64)
                pieces = [values[i: i + CHUNK] for i in range(0, len(values), CHUNK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(pieces)), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(pieces), pa.int32()),
                     pa.array([steps.tokens] * len(pieces), pa.float64()), pa.array(pieces, pa.list_(pa.float64()))], ["chunk", "slot", "weight", "x"])

        trained = coded.where(F.col("turn") == turn).select("symbols").repartition(trainers).mapInArrow(run, _PIECE)
        averaged = cut_lineage(_average(trained, trainers), "network").orderBy("chunk").collect()  # one network
        if averaged:
            values = np.concatenate([np.array(r["x"]) for r in averaged])
            flat, squares = values[:len(flat)].astype(np.float32), values[len(flat):].astype(np.float32)
        given.unpersist()
    return flat


_PIECE = "chunk int, slot int, weight double, x array<double>"


def _average(pieces: DataFrame, n: int) -> DataFrame:
    """Weighted means of the pieces of ``n`` networks, ``FAN_IN`` of them at a time."""
    def mean(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("slot")
        weight = some["weight"].to_numpy()
        x = (np.stack(some["x"].to_numpy()) * (weight / weight.sum())[:, None]).sum(axis=0)
        return pd.DataFrame({"chunk": [some["chunk"].iloc[0]], "slot": [some["slot"].iloc[0] // FAN_IN], "weight": [weight.sum()], "x": [x]})

    while True:
        pieces = pieces.groupBy("chunk", F.floor(F.col("slot") / FAN_IN)).applyInPandas(mean, _PIECE)
        n = math.ceil(n / FAN_IN)
        if n <= 1:
            return pieces


def scores(documents: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, held_out, n_tokens, n_known, train_tokens, base_score, score) per document."""
    spark = documents.sparkSession
    ship(spark)
    fold = F.coalesce(F.crc32(F.col(doc_col).cast("string").cast("binary")) % FOLDS, F.lit(0))
    held = fold == HELD_OUT
    turn = F.when(held, F.lit(-1)).otherwise(F.pmod(F.xxhash64(doc_col, F.octet_length(text_col)), F.lit(ROUNDS))).cast("int")
    docs = documents.select(F.col(doc_col).alias("doc"), held.alias("held_out"), turn.alias("turn"), F.col(text_col).cast("binary").alias("text"))
    counts = count_words(docs.where(~F.col("held_out")))
    v, outside = vocabulary(counts)
    coded = encode(docs, v)
    flat = train(coded, v) if v.tokens else Network(v).flat
    vocab, net = spark.sparkContext.broadcast(v), spark.sparkContext.broadcast(flat)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(vocab.value, net.value)
        for b in batches:
            i = b.schema.get_field_index("symbols")
            logp = np.zeros(len(b))
            for rows, texts in lanes(b.column(i)):
                logp[rows] = model.run(texts)
            yield b.set_column(i, "net", pa.array(logp / LN10))

    kept = ["row", "doc", "held_out", "n_tokens", "n_known", "base", "within"]
    types = {f.name: f.dataType.simpleString() for f in coded.schema}
    scored = coded.select(*kept, "symbols").mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in kept) + ", net double")
    rare = coded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(
        counts.where(outside), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("met"),
        F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("base_met"), F.sum(F.col("n") * F.log10(F.col("c"))).alias("count_met"))
    known = F.col("n_known") + F.coalesce("met", F.lit(0))
    unknown = F.col("n_tokens") - known
    zero = F.lit(0.0)
    total = math.log10(v.tokens + 0.5 * (v.words + 1))
    base = F.col("base") + F.coalesce("base_met", zero) + unknown * math.log10(0.5) - F.col("n_tokens") * total
    share = math.log10((1 - v.unknown) / v.rare_tokens) if v.unknown < 1 else 0.0
    model = F.col("net") + F.col("within") + F.coalesce("count_met", zero) + F.coalesce("met", F.lit(0)) * share + unknown * math.log10(v.unknown)
    if not v.tokens:
        base = model = zero
    return scored.join(rare, "row", "left").select(
        "doc", "held_out", "n_tokens", known.alias("n_known"), F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), model.alias("score"))
