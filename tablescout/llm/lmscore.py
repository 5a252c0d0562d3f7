"""Language-model scores: a gated recurrent network over a unigram base.

Word counts cover every training document and grow with the corpus. The
network reads the most frequent words, the end of a document and one class
for all other words; an other word's share of that class is its smoothed
unigram probability there, so that every text has a probability. The output
softmax is factored into a class and a word within the class. Training is
truncated back-propagation through time in numpy, once over every training
document: a hash of the text deals them out to a fixed number of rounds, and
in a round each task trains a copy on its own documents of that round, from
the mean of the last round's copies, which are averaged by their tokens in a
tree of merges. So the network depends on how the table is cut into
partitions, the counts and the base score do not. Scoring carries the hidden
state from window to window, so a document's log-likelihood is that of its
complete text.

The ``HEAD`` most frequent words travel to the tasks. Every other word meets
its count in a join, whose keys are rare by construction.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import arrow_slices, stored

END = ""  # no word is empty
SMOOTH = 0.1
HEAD = 100_000  # words whose counts are sent to every task
WORDS = 1 << 14  # words that the network tells apart, at least; more as the cube root of the distinct words
PER_ROOT = 64  # so many times that root: 64,000 for 10^9 distinct words, and never more than HEAD
CLASSES = 12
HIDDEN = 16
WINDOW = 16  # tokens between truncations
STREAMS = 32  # documents trained on side by side, at least
MAX_STREAMS = 512
ROUNDS = 3  # each over its own share of the training documents
TASK_TOKENS = 200_000  # a task trains on so many, at least about
FAN = 4  # copies that one task merges
_SLICE = 1 << 23
_BLOCK = 1 << 10  # rows of a softmax at a time
_STEP = 1 << 14  # numbers updated at a time
_LOG10 = math.log10(math.e)


class Network(NamedTuple):
    read: np.ndarray  # tokens x 3 HIDDEN: input weights of the update gate, reset gate and candidate
    carry: np.ndarray  # HIDDEN x 3 HIDDEN
    class_w: np.ndarray  # HIDDEN x classes
    class_b: np.ndarray
    word_w: np.ndarray  # tokens x HIDDEN
    word_b: np.ndarray


class Vocabulary(NamedTuple):
    """Token 0 is the end, token 1 any other word; the rest by falling frequency. Classes are ranges of tokens."""

    token: dict[bytes, int]
    edges: np.ndarray  # first token of each class, and the number of tokens
    klass: np.ndarray
    freq: np.ndarray


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # on bytes: A-Z only, and ASCII white space


def vocabulary(frequent: list[tuple[bytes, int]], ends: int, others: int, classes: int = CLASSES) -> Vocabulary:
    freq = np.array([ends, others, *(n for _, n in frequent)], float) + 1.0
    mass = np.cumsum(np.sqrt(freq)) / np.sqrt(freq).sum()
    klass = np.minimum((mass * classes).astype(int), classes - 1)
    _, klass = np.unique(klass, return_inverse=True)
    edges = np.r_[np.flatnonzero(np.r_[True, np.diff(klass) > 0]), len(klass)]
    return Vocabulary({w: i + 2 for i, (w, _) in enumerate(frequent)}, edges, klass, freq)


def initial(vocab: Vocabulary, hidden: int = HIDDEN, seed: int = 3) -> Network:
    """Small random weights; the biases alone give the unigram frequencies."""
    rng = np.random.default_rng(seed)
    n, c = len(vocab.freq), len(vocab.edges) - 1
    normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    mass = np.add.reduceat(vocab.freq, vocab.edges[:-1])
    return Network(
        normal(n, 3 * hidden), normal(hidden, 3 * hidden), normal(hidden, c) * 0, np.log(mass / mass.sum()).astype(np.float32),
        normal(n, hidden) * 0, np.log(vocab.freq / mass[vocab.klass]).astype(np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _step(net: Network, x: np.ndarray, h: np.ndarray):
    """The next state after inputs whose rows of ``net.read`` are ``x``, and what the way back needs."""
    size = h.shape[1]
    u = h @ net.carry
    gates = _sigmoid(x[:, : 2 * size] + u[:, : 2 * size])
    z, r, a = gates[:, :size], gates[:, size:], u[:, 2 * size :]
    n = np.tanh(x[:, 2 * size :] + r * a)
    return n + z * (h - n), (z, r, a, n)


def _softmax(x: np.ndarray, at: np.ndarray, backward: bool) -> np.ndarray:
    """Natural log probability of column ``at`` of each row, in place; ``backward`` leaves the gradient of the loss in ``x``."""
    rows = np.arange(len(at))
    x -= x.max(axis=1, keepdims=True)
    out = x[rows, at]
    np.exp(x, out=x)
    total = x.sum(axis=1)
    out -= np.log(total)
    if backward:
        x *= (1 / total)[:, None]
        x[rows, at] -= 1
    return out


def _output(net: Network, vocab: Vocabulary, states: np.ndarray, targets: np.ndarray, gradients: list | None = None):
    """Natural log probability of each target after its state; with ``gradients``, also the states' gradient."""
    backward, klass = gradients is not None, vocab.klass[targets]
    order = np.argsort(klass.astype(np.int16), kind="stable")  # short ones are sorted by radix
    klass, targets, h = klass[order], targets[order], states[order]
    logs, d_h = np.empty(len(order), states.dtype), np.empty_like(h) if backward else None
    for lo in range(0, len(order), _BLOCK):
        at = slice(lo, lo + _BLOCK)
        x = h[at] @ net.class_w
        x += net.class_b
        logs[at] = _softmax(x, klass[at], backward)
        if backward:
            gradients[2] += h[at].T @ x
            gradients[3] += x.sum(0)
            d_h[at] = x @ net.class_w.T
    bounds = np.searchsorted(klass, np.arange(len(vocab.edges)))
    for c in np.flatnonzero(np.diff(bounds)):
        lo, hi = vocab.edges[c], vocab.edges[c + 1]
        if hi - lo == 1:
            continue
        for start in range(bounds[c], bounds[c + 1], _BLOCK):
            at = slice(start, min(start + _BLOCK, bounds[c + 1]))
            x = h[at] @ net.word_w[lo:hi].T
            x += net.word_b[lo:hi]
            logs[at] += _softmax(x, targets[at] - lo, backward)
            if backward:
                gradients[4][lo:hi] += x.T @ h[at]
                gradients[5][lo:hi] += x.sum(0)
                d_h[at] += x @ net.word_w[lo:hi]
    out = np.empty_like(logs)
    out[order] = logs
    if not backward:
        return out, None
    d_states = np.empty_like(d_h)
    d_states[order] = d_h
    return out, d_states


def _summed_rows(rows: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Add each row to ``out[at]``."""
    order = np.argsort(at, kind="stable")
    used, first = np.unique(at[order], return_index=True)
    out[used] += np.add.reduceat(rows[order], first, axis=0)


def loss_and_gradients(net: Network, vocab: Vocabulary, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray):
    """Summed loss over a window (time x streams), its gradients, and the state to carry on."""
    span, streams = inputs.shape
    size = h.shape[1]
    read = net.read[inputs]
    states = np.empty((span + 1, streams, size), h.dtype)
    states[0] = h
    kept = np.empty((4, span, streams, size), h.dtype)
    for t in range(span):
        states[t + 1], kept[:, t] = _step(net, read[t], states[t])
    gradients = [np.zeros_like(p) for p in net]
    logs, d_states = _output(net, vocab, states[1:].reshape(-1, size), targets.ravel(), gradients)
    d_states = d_states.reshape(span, streams, size)
    z, r, a, n = kept
    to_n, to_z, to_r = (1 - z) * (1 - n * n), (states[:-1] - n) * z * (1 - z), a * r * (1 - r)
    d_read, d_carry = np.empty((2, span, streams, 3 * size), h.dtype)
    after = np.zeros_like(h)
    for t in range(span - 1, -1, -1):  # truncated: nothing flows into the window before
        d = d_states[t] + after
        d_n = d * to_n[t]
        d_read[t, :, :size] = d_carry[t, :, :size] = d * to_z[t]
        d_read[t, :, size : 2 * size] = d_carry[t, :, size : 2 * size] = d_n * to_r[t]
        d_read[t, :, 2 * size :] = d_n
        d_carry[t, :, 2 * size :] = d_n * r[t]
        after = d * z[t] + d_carry[t] @ net.carry.T
    _summed_rows(d_read.reshape(-1, 3 * size), inputs.ravel(), gradients[0])
    gradients[1] += states[:-1].reshape(-1, size).T @ d_carry.reshape(-1, 3 * size)
    return -logs.sum(), gradients, states[-1]


class Trainer:
    """Adam over parallel streams of documents, each document ended by token 0; changes ``net`` in place."""

    def __init__(self, net: Network, vocab: Vocabulary, window: int = WINDOW, rate: float = 8e-3):
        self.net, self.vocab, self.window, self.rate = net, vocab, window, rate
        self.first, self.second, self.step, self.seen = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net], 0, 0

    def learn(self, documents: list[np.ndarray]) -> None:
        line = np.concatenate([np.zeros(1, np.int64), *documents])
        n, window = len(line) - 1, self.window
        streams = max(1, min(max(STREAMS, min(MAX_STREAMS, n // (64 * window))), n // (4 * window)))
        length = -(-n // streams)
        # Streams of equal length; the last ones may be a token short, which the end of a document fills.
        inputs, targets = (np.r_[x, np.zeros(streams * length - n, np.int64)].reshape(streams, length).T for x in (line[:-1], line[1:]))
        self.seen += n
        h = np.zeros((streams, self.net.carry.shape[0]), np.float32)
        for lo in range(0, length, window):
            x, y = inputs[lo : lo + window], targets[lo : lo + window]
            h = np.where((x[0] == 0)[:, None], 0, h).astype(np.float32)
            _, gradients, h = loss_and_gradients(self.net, self.vocab, x, y, h)
            norm = math.sqrt(sum(float(np.vdot(g, g)) for g in gradients)) / x.size
            self._update(gradients, (1.0 if norm < 1 else 1 / norm) / x.size)

    def _update(self, gradients: list[np.ndarray], scale: float) -> None:
        """One step of Adam, by blocks that stay in the cache; the gradients are used up."""
        self.step += 1
        root = math.sqrt(1 - 0.995**self.step)
        rate = self.rate * root / (1 - 0.9**self.step)
        for arrays in zip(self.net, gradients, self.first, self.second, strict=True):
            flat = [x.reshape(-1) for x in arrays]
            for lo in range(0, flat[0].size, _STEP):
                p, g, m, v = (x[lo : lo + _STEP] for x in flat)
                g *= scale
                change = g - m
                change *= 0.1
                m += change
                g *= g
                g -= v
                g *= 0.005
                v += g
                np.sqrt(v, out=g)
                g += 1e-8 * root
                np.divide(m, g, out=g)
                g *= rate
                p -= g


def _flat(net: Network) -> np.ndarray:
    return np.concatenate([p.ravel() for p in net])


def _shaped(flat: np.ndarray, like: Network) -> Network:
    ends = np.cumsum([p.size for p in like])
    return Network(*(x.reshape(p.shape).copy() for x, p in zip(np.split(flat, ends[:-1]), like, strict=True)))


def _mean(copies: list[bytes], seen: list[int]) -> np.ndarray:
    """The mean of copies weighted by their tokens."""
    total = np.zeros(len(copies[0]) // 4)
    for net, n in zip(copies, seen, strict=True):
        total += np.frombuffer(net, np.float32) * float(n)
    return (total / sum(seen)).astype(np.float32)


def _merged(table: pa.Table) -> pa.Table:
    """One row a table: the mean of the copies and their tokens."""
    seen = table.column("seen").to_pylist()
    net = _mean(table.column("net").to_pylist(), seen).tobytes()
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64()), "seen": pa.array([sum(seen)], pa.int64()), "net": pa.array([net], pa.binary())})


def train(texts: DataFrame, vocab: Vocabulary, total: int, rounds: int = ROUNDS, hidden: int = HIDDEN) -> Network:
    """The network after ``rounds`` over all of ``texts``, which hold ``total`` tokens."""
    net, schema = initial(vocab, hidden), "part bigint, seen bigint, net binary"
    if not total:
        return net
    parts = max(1, min(texts.rdd.getNumPartitions(), total // (TASK_TOKENS * rounds)))
    turn = F.pmod(F.xxhash64("text", F.lit(29)), F.lit(rounds))
    for n in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast((net, vocab))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            start, words = shared.value
            trainer = Trainer(Network(*(p.copy() for p in start)), words)
            for batch in arrow_slices(batches, limit=_SLICE):
                trainer.learn([_encode(text, words) for text in batch.column("text").to_pylist()])
            if trainer.seen:
                part = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([trainer.seen], pa.int64()), pa.array([_flat(trainer.net).tobytes()], pa.binary())], ["part", "seen", "net"])

        copies, left = texts.where(turn == n).coalesce(parts).mapInArrow(run, schema), parts
        while left > FAN:
            copies, left = copies.withColumn("part", F.expr(f"part div {FAN}")).groupBy("part").applyInArrow(_merged, schema), -(-left // FAN)
        # FAN rows at most, put in order here: a sort in Spark would first sample its input, that is train twice.
        rows = sorted(copies.collect(), key=lambda r: r["part"])
        if rows:
            net = _shaped(_mean([r["net"] for r in rows], [r["seen"] for r in rows]), net)
        shared.unpersist()
    return net


def log_likelihoods(net: Network, vocab: Vocabulary, documents: list[np.ndarray], window: int = 64) -> np.ndarray:
    """log10 probability of each whole token sequence (the end included), by windows that hand on their state."""
    out = np.zeros(len(documents))
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    lengths = np.array([len(documents[i]) for i in order])
    size = net.carry.shape[0]
    for lo in range(0, len(order), 512):
        group, long = order[lo : lo + 512], lengths[lo : lo + 512]
        h, last = np.zeros((len(group), size), np.float32), np.zeros(len(group), np.int64)
        for start in range(0, int(long[0]), window):
            live = int((long > start).sum())
            span = min(window, int(long[0]) - start)
            y = np.zeros((live, span), np.int64)
            for k in range(live):
                part = documents[group[k]][start : start + span]
                y[k, : len(part)] = part
            states = np.empty((span, live, size), np.float32)
            h, last = h[:live], last[:live]
            for t in range(span):
                h, _ = _step(net, net.read[last], h)
                states[t], last = h, y[:, t]
            real = np.arange(start, start + span)[:, None] < long[None, :live]
            who = np.broadcast_to(np.arange(live), real.shape)[real]
            logs, _ = _output(net, vocab, states[real], y.T[real])
            out[np.array(group)[:live]] += np.bincount(who, logs, minlength=live) * _LOG10
    return out


class Fitted(NamedTuple):
    counts: DataFrame  # word, n: all of them
    rank: dict[bytes, int]  # the place of each of the most frequent words
    often: np.ndarray  # their counts; the first ``words`` are the network's
    words: int
    ends: int  # training documents
    total: int  # training tokens
    distinct: int
    vocab: Vocabulary
    net: Network


def _encode(text: bytes, vocab: Vocabulary) -> np.ndarray:
    get = vocab.token.get
    return np.array([*(get(w, 1) for w in tokens(text)), 0], np.int64)


def fit(texts: DataFrame, head: int = HEAD, words: int | None = None, rounds: int = ROUNDS) -> Fitted:
    """Count the words of the column ``text`` (binary, not null) and train the network on all of it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, limit=_SLICE):
            found: Counter = Counter()
            for text in batch.column("text").to_pylist():
                found.update(tokens(text))
            found[END.encode()] = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    counts = stored(texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    found = counts.where(F.octet_length("word") > 0).orderBy(F.col("n").desc(), "word").limit(head).collect()
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    words = min(len(found), words or max(WORDS, PER_ROOT * round(distinct ** (1 / 3))))
    frequent = [(bytes(r["word"]), r["n"]) for r in found[:words]]
    vocab = vocabulary(frequent, ends, total - ends - sum(n for _, n in frequent), max(CLASSES, math.isqrt(words) // 2))
    rank, often = {bytes(r["word"]): i for i, r in enumerate(found)}, np.array([r["n"] for r in found], np.int64)
    return Fitted(counts, rank, often, words, ends, total, distinct, vocab, train(texts, vocab, total, rounds))


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """One row per row of ``docs``: its counts, base score and the model's log10 probability.

    Columns: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.
    ``learn`` marks the training rows. A null text counts as empty: its only
    token is the end. Rows with equal ids stay separate. Without training
    rows every word is unknown and the network knows the end and "other" alone.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text")
    model = fit(docs.where(learn).select(text), **parameters)
    shared = docs.sparkSession.sparkContext.broadcast((model.rank, np.log10(np.r_[model.often, 0] + SMOOTH), model.vocab, model.net))  # bounded by HEAD
    words, ends, end_log = model.words, model.ends, math.log10(model.ends + SMOOTH)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, log, vocab, net = shared.value
        for batch in arrow_slices(batches, limit=_SLICE):
            rows, lines = [], []
            for text in batch.column("text").to_pylist():
                found = tokens(text)
                at = np.fromiter((rank.get(w, -1) for w in found), np.int64, len(found))
                rare = Counter(w for w, i in zip(found, at.tolist(), strict=True) if i < 0)
                known, other = at[at >= 0], at >= words
                rows.append((
                    len(found) + 1, len(known) + (ends > 0), float(log[known].sum()) + end_log, len(found) - len(known) + int(other.sum()), float(log[at[other]].sum()),
                    [{"word": w, "n": n} for w, n in rare.items()],
                ))
                lines.append(np.r_[np.where((at < 0) | other, 1, at + 2), 0])
            n_tokens, n_known, base, n_other, other, rare = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                    pa.array(n_other, pa.int64()), pa.array(other, pa.float64()), pa.array(log_likelihoods(net, vocab, lines)),
                    pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
                ],
                ["doc_id", "n_tokens", "n_known", "base", "n_other", "other", "net", "rare"],
            )

    fields = "n_tokens bigint, n_known bigint, base double, n_other bigint, other double, net double, rare array<struct<word:binary,n:bigint>>"
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text).mapInArrow(run, f"doc_id {kind}, {fields}")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    shared.unpersist()
    rare = rows.select("row", F.inline("rare"))
    log = F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(SMOOTH))
    # Rare words are never among the network's: each counts for the base and for the other class alike.
    counted = rare.join(model.counts.toDF("word", "c"), "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * log).alias("rare_log"), F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("rare_known")
    )
    mass = model.total + SMOOTH * (model.distinct + 1)
    named = float((model.often[:words] + SMOOTH).sum()) + (ends + SMOOTH if ends else 0.0)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.join(counted, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + zero("rare_known")).cast("bigint").alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + zero("rare_log") - F.col("n_tokens") * F.lit(math.log10(mass))).alias("base_score"),
        (F.col("net") + F.col("other") + zero("rare_log") - F.col("n_other") * F.lit(math.log10(mass - named))).alias("score"),
    )
