"""Secret scanning: base patterns, and a character convolutional network over every candidate.

The base patterns find assignments, access keys and hex runs. Every other
run of ``MIN_CANDIDATE`` or more key-like characters, the least that an
assignment needs, is a candidate unless it lies wholly inside a base span: the
network reads it with its surrounding context, window by window, and adds
those whose calibrated probability reaches the threshold. The network is
trained in numpy on labelled findings: every window of every candidate of all
documents, labelled by whether a base pattern touches it, half of them with
their context blanked so that the characters themselves count. Windows alike
are one finding that stands for all of them. Few findings are trained on in
the driver; more are dealt out by a hash to the tasks, which train copies that
are averaged after each round. The outputs are calibrated on the held-back
quarter of the findings, each weighted by what it stands for, and the
threshold is the highest that still recalls ``MIN_RECALL`` of the held-back
secrets by their characters alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import arrow_slices, discard, field_type, stored

MIN_CANDIDATE = 12
SAMPLE_PER_DOC = 20  # where a caller asks for a sample: secret findings taken of one document, and plain ones, spread over the whole text
SAMPLE_WINDOWS = 4  # likewise, windows taken of one finding, spread over its length
ROUNDS = 6  # of training; few findings are all read in each, many once in all
FEW = 20_000  # findings that the driver trains on by itself
ROUND_FINDINGS = 100_000  # a round reads so many at least, or all
TASK_FINDINGS = 4_000  # a task trains on so many in a round, at least about
MAX_TASKS = 512  # copies that the driver averages
BATCH, RATE = 64, 3e-3
BINS = 256  # of the scores a unit, for calibration
MIN_RECALL = 0.99
KINDS = ("assign", "access", "hex", "cnn")

LEFT, CORE, RIGHT = 24, 64, 16
STRIDE = 32  # a candidate longer than CORE is read in overlapping windows
WIDTH, FILTERS, EMBED, HIDDEN = 5, 24, 12, 16
_LENGTH = LEFT + CORE + RIGHT
_SYMBOLS = 98  # 0: padding, 1-95: printable ASCII, 96: white space, 97: any other

_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_CANDIDATE)

_CODE = np.full(0x80, 97, np.int64)
_CODE[32:127] = np.arange(1, 96)
_CODE[[9, 10, 11, 12, 13, 32]] = 96

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Whole matches of the base patterns, leftmost and non-overlapping per kind; places in code points."""
    low = text.lower()
    out: list[Span] = []
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CANDIDATE.finditer(text)]


def covered(spans: list[Span], found: list[tuple[int, int]]) -> np.ndarray:
    """Whether a base span overlaps each candidate."""
    if not spans or not found:
        return np.zeros(len(found), bool)
    starts = np.array([s[0] for s in spans])
    reach = np.maximum.accumulate([s[2] for s in spans])  # furthest end so far, in order of start
    lo, hi = np.array(found).T
    before = np.searchsorted(starts, hi, side="left")
    return (before > 0) & (reach[np.maximum(before - 1, 0)] > lo)


def inside(spans: list[Span], found: list[tuple[int, int]]) -> np.ndarray:
    """Whether a base span holds each candidate whole."""
    if not spans or not found:
        return np.zeros(len(found), bool)
    starts = np.array([s[0] for s in spans])
    reach = np.maximum.accumulate([s[2] for s in spans])
    lo, hi = np.array(found).T
    before = np.searchsorted(starts, lo, side="right")
    return (before > 0) & (reach[np.maximum(before - 1, 0)] >= hi)


def spread(n: int, most: int) -> range:
    """At most ``most`` of ``n`` places, evenly spaced from the first on."""
    return range(0, n, -(-n // most) or 1)


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], 97).astype(np.uint8)


def windows(text: str, lo: int, hi: int) -> np.ndarray:
    """Symbol codes of a candidate with its context, one row per window that covers it."""
    return _windows(symbols(text), lo, hi)


def _windows(text: np.ndarray, lo: int, hi: int) -> np.ndarray:
    starts = range(lo, max(lo + 1, hi - CORE + STRIDE), STRIDE)
    out = np.zeros((len(starts), _LENGTH), np.uint8)
    for line, at in zip(out, starts, strict=True):
        end = min(at + CORE, hi)
        left, right = text[max(0, at - LEFT) : at], text[end : end + RIGHT]
        line[LEFT - len(left) : LEFT] = left
        line[LEFT : LEFT + end - at] = text[at:end]
        line[LEFT + CORE : LEFT + CORE + len(right)] = right
    return out


class Network(NamedTuple):
    """Embedding, convolution, max-pooling over places, one hidden layer, logistic output with calibration."""

    embed: np.ndarray  # symbols x EMBED
    place: np.ndarray  # three regions (left, core, right) x EMBED
    conv: np.ndarray  # WIDTH x EMBED x FILTERS
    conv_b: np.ndarray
    hidden: np.ndarray
    hidden_b: np.ndarray
    out: np.ndarray
    out_b: np.ndarray
    calibration: np.ndarray  # slope, offset
    threshold: float


_REGION = np.repeat([0, 1, 2], [LEFT, CORE, RIGHT])


def _symbol_vectors(net: Network) -> np.ndarray:
    """What each symbol in each region means to the convolution, region by region; padding is zero everywhere."""
    out = net.embed + net.place[:, None]
    out[:, 0] = 0
    return out.reshape(-1, net.embed.shape[1])


def _forward(net: Network, codes: np.ndarray, winners: bool = False):
    """Scores; with ``winners`` also the symbols at the places that won the pooling, and the layers."""
    vectors = _symbol_vectors(net)
    at = codes + _SYMBOLS * _REGION
    places = _LENGTH - WIDTH + 1
    z = np.take(vectors @ net.conv[0], at[:, :places], axis=0)
    for k in range(1, WIDTH):
        z += np.take(vectors @ net.conv[k], at[:, k : k + places], axis=0)
    pooled = z.max(axis=1) + net.conv_b
    relu = np.maximum(pooled, 0)
    h = np.tanh(relu @ net.hidden + net.hidden_b)
    score = h @ net.out + net.out_b[0]
    if not winners:
        return score, None
    best = np.ascontiguousarray(z.transpose(0, 2, 1)).argmax(axis=2)
    won = [np.take_along_axis(at, best + k, 1) for k in range(WIDTH)]
    return score, (vectors, won, pooled, relu, h)


def logits(net: Network, codes: np.ndarray, block: int = 512) -> np.ndarray:
    return np.concatenate([_forward(net, codes[i : i + block])[0] for i in range(0, len(codes), block)] or [np.zeros(0)])


def _gradients(net: Network, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    score, (vectors, won, pooled, relu, h) = _forward(net, codes, winners=True)
    d = ((1 / (1 + np.exp(-score)) - labels) * weights / weights.sum())[:, None]
    g_out, g_out_b = h.T @ d[:, 0], np.array([d.sum()])
    dh = d * net.out * (1 - h * h)
    g_hidden, g_hidden_b = relu.T @ dh, dh.sum(0)
    dp = (dh @ net.hidden.T) * (pooled > 0)
    g_conv, g_vectors, size = np.empty_like(net.conv), np.zeros(vectors.size), vectors.shape[1]
    for k in range(WIDTH):
        g_conv[k] = np.einsum("nf,nfe->ef", dp, vectors[won[k]])
        back = dp[:, :, None] * net.conv[k].T
        g_vectors += np.bincount((won[k][:, :, None] * size + np.arange(size)).ravel(), back.ravel(), len(g_vectors))
    g_vectors = g_vectors.reshape(len(net.place), -1, size)
    g_vectors[:, 0] = 0
    return [g_vectors.sum(0), g_vectors.sum(1), g_conv, dp.sum(0), g_hidden, g_hidden_b, g_out, g_out_b]


def initial(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    shapes = [(_SYMBOLS, EMBED), (3, EMBED), (WIDTH, EMBED, FILTERS), (FILTERS,), (FILTERS, HIDDEN), (HIDDEN,), (HIDDEN,), (1,)]
    params = [rng.normal(0, 0.2, s) if len(s) > 1 or s == (HIDDEN,) else np.zeros(s) for s in shapes]
    return Network(*(p.astype(np.float32) for p in params), np.array([1.0, 0.0]), np.inf)


def blanked(codes: np.ndarray) -> np.ndarray:
    """Without their context."""
    out = codes.copy()
    out[:, :LEFT] = out[:, LEFT + CORE :] = 0
    return out


class Trainer:
    """Adam on batches of findings; changes ``net`` in place."""

    def __init__(self, net: Network, secret_share: float, seed: int, rate: float = RATE):
        self.net, self.share, self.rate, self.rng = net, secret_share, rate, np.random.default_rng(seed)
        self.first, self.second, self.step, self.seen = [np.zeros_like(p) for p in net[:8]], [np.zeros_like(p) for p in net[:8]], 0, 0

    def learn(self, codes: np.ndarray, labels: np.ndarray) -> None:
        labels = labels.astype(np.float32)
        weight = np.where(labels == 1, 0.5 / self.share, 0.5 / (1 - self.share)).astype(np.float32)
        codes = np.where(self.rng.random(len(codes))[:, None] < 0.5, blanked(codes), codes)
        self.step, self.seen = self.step + 1, self.seen + len(codes)
        for p, g, m, v in zip(self.net, _gradients(self.net, codes, labels, weight), self.first, self.second, strict=False):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.99**self.step)) + 1e-8)


def calibrated(net: Network, score: np.ndarray, labels: np.ndarray, alone: np.ndarray, weights: np.ndarray) -> Network:
    """Platt scaling on scores of held-back findings, and the threshold by those ``alone`` (without their context)."""
    calibration, share = np.array([1.0, 0.0]), weights / weights.sum()
    spread_of = share @ (score - share @ score) ** 2
    for _ in range(200):
        off = share * (1 / (1 + np.exp(-(calibration[0] * score + calibration[1]))) - labels)
        calibration -= 0.1 * np.array([(off @ score) / (spread_of + 1e-9), off.sum()])
    net = net._replace(calibration=calibration)
    secret = (labels == 1) & alone
    p = _calibrate(net, score[secret])
    order = np.argsort(p)
    below = np.cumsum(weights[secret][order])
    return net._replace(threshold=float(p[order][np.searchsorted(below, (1 - MIN_RECALL) * below[-1] * (1 + 1e-12), side="right")]))


def train(
    codes: np.ndarray, labels: np.ndarray, stands_for: np.ndarray | None = None, seed: int = 7, epochs: int = ROUNDS, batch: int = BATCH, rate: float = RATE
) -> Network:
    """Train on three quarters of the findings; the rest, weighted by what each stands for, calibrates and sets the threshold."""
    rng, net = np.random.default_rng(seed), initial(seed)
    held = rng.random(len(labels)) < 0.25
    fit, aside = np.flatnonzero(~held), np.flatnonzero(held)
    share = labels[fit].mean() if len(fit) else 0.0
    if not 0 < share < 1 or not labels[aside].any():
        return net  # nothing to learn from: no span is added
    trainer = Trainer(net, share, seed, rate)
    for _ in range(epochs):
        order = rng.permutation(fit)
        for lo in range(0, len(order), batch):
            trainer.learn(codes[order[lo : lo + batch]], labels[order[lo : lo + batch]])
    # Findings count with and without their context: what the base patterns miss has no telling one.
    score, aside = np.concatenate([logits(net, codes[aside]), logits(net, blanked(codes[aside]))]).astype(float), np.tile(aside, 2)
    weights = np.ones(len(aside)) if stands_for is None else stands_for[aside]
    return calibrated(net, score, labels[aside], np.arange(len(aside)) >= len(aside) // 2, weights)


def _calibrate(net: Network, score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(net.calibration[0] * score + net.calibration[1])))


def probabilities(net: Network, codes: np.ndarray) -> np.ndarray:
    return _calibrate(net, logits(net, codes).astype(float))


def labelled_findings(docs: DataFrame, sample_docs: int | None = None) -> DataFrame:
    """``codes, label, stands_for``: the different findings of all documents, and how many each stands for.

    ``sample_docs`` asks for those of about so many documents alone, chosen by
    a hash of their text, and for a bounded number of each.
    """
    rows = docs.where("text IS NOT NULL").select("text")
    if sample_docs is not None:
        total = docs.agg(F.count("text")).first()[0]
        key = F.pmod(F.xxhash64(F.col("text"), F.lit(8)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        rows = rows.where(key < min(1.0, sample_docs / max(total, 1))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            codes, labels, shares = [], [], []
            for text in batch.column("text").to_pylist():
                found = candidates(text)
                if not found:
                    continue
                secret, points = covered(base_spans(text), found), symbols(text)
                for label in (True, False):
                    places = np.flatnonzero(secret == label)
                    take = places if sample_docs is None else places[spread(len(places), SAMPLE_PER_DOC)] if len(places) else places
                    for i in take:
                        seen = _windows(points, *found[i])
                        if sample_docs is not None:
                            seen = seen[spread(len(seen), SAMPLE_WINDOWS)]
                        codes += [r.tobytes() for r in seen]
                        labels += [int(label)] * len(seen)
                        shares += [len(places) / len(take)] * len(seen)
            arrays = [pa.array(codes, pa.binary()), pa.array(labels, pa.int32()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["codes", "label", "stands_for"])

    found = rows.mapInArrow(run, "codes binary, label int, stands_for double")
    return found.groupBy("codes", "label").agg(F.sum("stands_for").alias("stands_for"))


def _codes(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, _LENGTH)


def _train_in_tasks(findings: DataFrame, n: int, secret_share: float, seed: int) -> Network:
    """Rounds of copies, each trained on a task's findings and averaged by their number: ``n`` findings in all."""
    net, schema = initial(seed), "part int, seen bigint, net binary"
    shares = max(1, min(ROUNDS, n // ROUND_FINDINGS))
    parts = max(1, min(findings.rdd.getNumPartitions(), n // shares // TASK_FINDINGS, MAX_TASKS))
    turn = F.pmod(F.xxhash64("codes", F.lit(13)), F.lit(shares))
    for i in range(ROUNDS):
        shared = findings.sparkSession.sparkContext.broadcast(net)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, i=i) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            trainer = Trainer(Network(*(np.array(p) for p in shared.value[:8]), *shared.value[8:]), secret_share, seed + 1000 * i + part)
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                codes, labels = _codes(batch), batch.column("label").to_numpy()
                order = trainer.rng.permutation(len(labels))
                for lo in range(0, len(order), BATCH):
                    trainer.learn(codes[order[lo : lo + BATCH]], labels[order[lo : lo + BATCH]])
            if trainer.seen:
                flat = np.concatenate([p.ravel() for p in trainer.net[:8]])
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([trainer.seen], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["part", "seen", "net"])

        # MAX_TASKS small rows at most, put in order here: a sort in Spark would first sample its input, that is train twice.
        rows = sorted(findings.where(turn == i % shares).coalesce(parts).mapInArrow(run, schema).collect(), key=lambda r: r["part"])
        shared.unpersist()
        if rows:
            mean = sum(np.frombuffer(r["net"], np.float32) * float(r["seen"]) for r in rows) / sum(r["seen"] for r in rows)
            ends = np.cumsum([p.size for p in net[:8]])
            net = Network(*(x.reshape(p.shape).astype(np.float32) for x, p in zip(np.split(mean, ends[:-1]), net, strict=False)), *net[8:])
    return net


def _calibrate_in_tasks(net: Network, aside: DataFrame) -> Network:
    """Calibration and threshold from all held-back findings, their scores counted in bins; a bin counts as its lower end."""
    shared = aside.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(batch)
            for alone, seen in enumerate((codes, blanked(codes))):
                bins = np.floor(logits(shared.value, seen).astype(float) * BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label"), pa.array([alone] * len(bins), pa.int32()), batch.column("stands_for")], ["bin", "label", "alone", "n"])

    found = aside.mapInArrow(run, "bin bigint, label int, alone int, n double").groupBy("bin", "label", "alone").agg(F.sum("n").alias("n"))
    rows = found.toPandas().sort_values(["bin", "label", "alone"])  # scores are bounded by the network's weights, so are the bins
    shared.unpersist()
    return calibrated(net, rows["bin"].to_numpy(float) / BINS, rows["label"].to_numpy(float), rows["alone"].to_numpy() == 1, rows["n"].to_numpy(float))


def fit(docs: DataFrame, sample_docs: int | None = None, seed: int = 7) -> Network:
    """Train, calibrate and set the threshold on the findings of all documents."""
    # In order of a hash: tasks and batches mix what documents hold, and a rerun reads the same order.
    findings = stored(labelled_findings(docs, sample_docs).sortWithinPartitions(F.xxhash64("codes"), "codes", "label"))
    held = F.pmod(F.xxhash64("codes", F.lit(11)), F.lit(4)) == 0
    n = {(r["held"], r["label"]): r["n"] for r in findings.groupBy(held.alias("held"), "label").agg(F.count("*").alias("n")).collect()}
    total, (plain, secret) = sum(n.values()), (n.get((False, label), 0) for label in (0, 1))
    if total <= FEW:
        # Put in order here: a sort in Spark would first sample its input, that is read it twice.
        rows = findings.toPandas().sort_values(["label", "codes", "stands_for"], ignore_index=True)
        codes = np.frombuffer(b"".join(rows["codes"]), np.uint8).reshape(-1, _LENGTH)
        net = train(codes, rows["label"].to_numpy(float), rows["stands_for"].to_numpy(float), seed)
    elif plain and secret and n.get((True, 1)):
        net = _calibrate_in_tasks(_train_in_tasks(findings.where(~held), plain + secret, secret / (plain + secret), seed), findings.where(held))
    else:
        net = initial(seed)  # nothing to learn from: no span is added
    discard(findings)
    return net


def find(text: str, net: Network) -> list[Span]:
    """Base spans and the candidates that the network adds, by start and kind."""
    return _find_all([text], net)[0]


def _find_all(texts: list[str], net: Network) -> list[list[Span]]:
    spans = [base_spans(t) for t in texts]
    codes, owner = [], []
    for k, text in enumerate(texts):
        found = candidates(text) if np.isfinite(net.threshold) else []
        points = symbols(text) if found else None
        for (lo, hi), known in zip(found, inside(spans[k], found).tolist(), strict=True):
            if not known:
                seen = _windows(points, lo, hi)
                codes.append(seen)
                owner += [(k, lo, hi)] * len(seen)
    if codes:
        p = probabilities(net, np.concatenate(codes))
        added = {owner[i] for i in np.flatnonzero(p >= net.threshold)}
        for k, lo, hi in added:
            spans[k].append((lo, 3, hi))
    return [sorted(s) for s in spans]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", net: Network | None = None, **parameters) -> DataFrame:
    """One row per row of ``docs``: counts, digest and list of the secrets in its whole text.

    Columns: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_cnn``.
    A null text counts as empty. Texts shorter than any pattern have no
    spans. Without labelled secrets to learn from, the base spans stand alone.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    model = rows.sparkSession.sparkContext.broadcast(net or fit(rows, **parameters))  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            found = _find_all([t or "" for t in batch.column("text").to_pylist()], model.value)
            base = [[s for s in spans if s[1] < 3] for spans in found]
            counts = [pa.array([sum(s[1] == kind for s in spans) for spans in found], pa.int64()) for kind in range(4)]
            digest = [hashlib.sha256(_joined(spans).encode()).hexdigest() for spans in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts[:3], pa.array(digest), pa.array([_joined(s) for s in found], pa.string()), counts[3]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_cnn"],
            )

    kind = field_type(rows, "doc_id")
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_cnn bigint"
    )
