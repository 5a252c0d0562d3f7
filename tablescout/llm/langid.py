"""Language identification by interpolated Kneser-Ney character language models.

One model per language value, over case-folded letters with every other run
of characters read as one space. The counts come from whole texts of a
bounded sample of labelled rows and are added up by Spark. A model is a set
of sorted hash arrays: for each order the hashes of its n-grams with their
interpolated probabilities, and the hashes of its contexts with their
back-off weights. A text's language is the one of lowest cross-entropy per
character. Rows of the sample that the counts leave aside calibrate the
confidence and the cross-entropy above which a text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import arrow_slices, field_type

ORDER = 5
SAMPLE_DOCS = 600  # labelled rows per language that the models learn from, a hash of the text decides which
ASIDE = 0.2  # share of the sample kept for calibration
MARGIN = 3.0  # a text is rejected beyond this multiple of the worst deviation seen on the rows kept aside
UNDETERMINED = "und"
_SPACE, _EDGE = 32, 0
_SLICE = 1 << 18  # bytes of text at a time: a task's arrays are many times as large


class Model(NamedTuple):
    languages: list[str]
    grams: list[list[tuple[np.ndarray, np.ndarray]]]  # language, order: sorted hashes, probabilities
    contexts: list[list[tuple[np.ndarray, np.ndarray]]]  # language, order: sorted hashes, back-off weights
    uniform: float
    top: np.ndarray  # sorted hashes of the highest order's n-grams of all languages
    top_bits: np.ndarray  # their -log2 probabilities, one column per language
    sharpness: float = 1.0  # scale of the confidence
    centre: float = np.inf  # usual cross-entropy and its deviation: variance spread[0] + spread[1] / length
    spread: tuple[float, float] = (0.0, 0.0)
    limit: float = np.inf


@lru_cache(maxsize=1)
def _alphabet() -> np.ndarray:
    """Per code point: its lower-case letter, or a space; the text separator stays."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    table[_EDGE] = _EDGE
    return table


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each led by an edge, and the number of the text each belongs to."""
    joined = "".join("\0" + t.replace("\0", " ") for t in texts)
    codes = _alphabet()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = codes == _SPACE
    after = np.r_[False, (codes[:-1] == _SPACE) | (codes[:-1] == _EDGE)]
    codes = codes[~(blank & after)]
    return codes, np.cumsum(codes == _EDGE) - 1


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _contexts(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of all codes but the last; a single code has the empty context."""
    return _hash(columns[:-1]) if len(columns) > 1 else np.zeros(len(columns[0]), np.uint64)


def _windows(codes: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-gram that ends at each letter or space, as ``order`` code arrays; texts begin as after a space."""
    places = np.flatnonzero(codes != _EDGE)
    edge = np.maximum.accumulate(np.where(codes == _EDGE, np.arange(len(codes)), 0))
    columns = []
    for back in range(order - 1, -1, -1):
        at = places - back
        columns.append(np.where(at > edge[places], codes[np.maximum(at, 0)], _SPACE))
    return columns, places


def _lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, values = table
    if not len(hashes):
        return np.zeros(len(keys), bool), np.zeros((len(keys), *values.shape[1:]))
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return hashes[at] == keys, values[at]


def _probability(model: Model, language: int, grams: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney probability of each row's last code after the others."""
    order = grams.shape[1]
    p = np.full(len(grams), model.uniform)
    for k in range(1, order + 1):
        columns = list(grams[:, order - k :].T)
        seen, value = _lookup(model.grams[language][k - 1], _hash(columns))
        known, weight = _lookup(model.contexts[language][k - 1], _contexts(columns))
        p = np.where(known, weight * p, p)
        p = np.where(seen, value, p)
    return p


def _language_tables(grams: np.ndarray, counts: np.ndarray, uniform: float):
    """Sorted hash arrays of one language from its distinct n-grams of the highest order."""
    order = grams.shape[1]
    levels = [(grams, counts.astype(float))]
    for _ in range(order - 1):  # lower orders count the different letters that come before
        lower, n = np.unique(levels[0][0][:, 1:], axis=0, return_counts=True)
        levels.insert(0, (lower, n.astype(float)))
    gram_tables, context_tables = [], []
    below = (np.zeros(0, np.uint64), np.zeros(0))
    for k, (g, n) in enumerate(levels, 1):
        once, twice = (n == 1).sum(), (n == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        context, group = np.unique(_contexts(list(g.T)), return_inverse=True)
        total, kinds = np.bincount(group, n), np.bincount(group)
        weight = discount * kinds / total
        rest = uniform if k == 1 else _lookup(below, _hash(list(g[:, 1:].T)))[1]
        p = np.maximum(n - discount, 0) / total[group] + weight[group] * rest
        h = _hash(list(g.T))
        by = np.argsort(h)
        below = (h[by], p[by])
        gram_tables.append(below)
        context_tables.append((context, weight))
    return gram_tables, context_tables


def build(counted: list[tuple[str, str, int]], order: int = ORDER) -> Model:
    """The models from ``(language, n-gram, count)`` rows."""
    languages = sorted({r[0] for r in counted})
    parts: dict[str, list] = {name: [] for name in languages}
    for name, gram, n in counted:
        parts[name].append((gram, n))
    arrays = []
    for name in languages:
        text = "".join(g for g, _ in parts[name])
        arrays.append((np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, order), np.array([n for _, n in parts[name]])))
    letters = len(np.unique(np.concatenate([a.ravel() for a, _ in arrays]))) if arrays else 0
    uniform = 1.0 / (letters + 1)
    tables = [_language_tables(g, n, uniform) for g, n in arrays]
    model = Model(languages, [t[0] for t in tables], [t[1] for t in tables], uniform, np.zeros(0, np.uint64), np.zeros((0, len(languages))))
    if not arrays:
        return model
    every = np.unique(np.concatenate([g for g, _ in arrays]), axis=0)
    h = _hash(list(every.T))
    by = np.argsort(h)
    bits = np.stack([-np.log2(_probability(model, i, every[by])) for i in range(len(languages))], axis=1)
    return model._replace(top=h[by], top_bits=bits)


def cross_entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per character of every text under every language, and the number of characters (0: no letter)."""
    codes, owner = _letters(texts)
    order = len(model.grams[0]) if model.grams else ORDER
    columns, places = _windows(codes, order)
    owner = owner[places]
    lengths = np.bincount(owner, minlength=len(texts))
    letters = np.bincount(owner, columns[-1] != _SPACE, minlength=len(texts))
    bits = np.zeros((len(places), len(model.languages)))
    if len(places) and model.languages:
        keys = _hash(columns)
        seen, bits = _lookup((model.top, model.top_bits), keys)
        missed = np.flatnonzero(~seen)
        if len(missed):
            _, first, back = np.unique(keys[missed], return_index=True, return_inverse=True)
            grams = np.stack([c[missed[first]] for c in columns], axis=1)
            found = np.stack([-np.log2(_probability(model, i, grams)) for i in range(len(model.languages))], axis=1)
            bits[missed] = found[back]
    sums = np.stack([np.bincount(owner, bits[:, i], minlength=len(texts)) for i in range(len(model.languages))], axis=1) if model.languages else np.zeros((len(texts), 0))
    lengths = np.where(letters > 0, lengths, 0)
    return sums / np.maximum(lengths, 1)[:, None], lengths


def _deviation(model: Model, bits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return (bits - model.centre) / np.sqrt(model.spread[0] + model.spread[1] / np.maximum(lengths, 1))


def calibrate(model: Model, entropies: np.ndarray, lengths: np.ndarray, truth: np.ndarray, margin: float = MARGIN) -> Model:
    """Set the confidence scale and the rejection limit from rows that the counts did not see."""
    used = lengths > 0
    entropies, lengths, truth = entropies[used], lengths[used], truth[used]
    if not len(lengths):
        return model
    best = entropies.min(axis=1)

    def loss(scale: float) -> float:
        z = scale * (best[:, None] - entropies) * np.sqrt(lengths)[:, None]
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        return -np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean()

    sharpness = min((2.0**e for e in range(-4, 7)), key=loss)
    centre = float(np.median(best))
    square = (best - centre) ** 2
    inverse = 1.0 / lengths
    slope = max(0.0, float(np.cov(inverse, square, bias=True)[0, 1] / (inverse.var() + 1e-18)))
    level = max(float(square.mean() - slope * inverse.mean()), 1e-3)
    model = model._replace(sharpness=sharpness, centre=centre, spread=(level, max(slope, 1.0)))
    return model._replace(limit=margin * max(float(_deviation(model, best, lengths).max()), 1.0))


def predict(model: Model, texts: list[str]) -> list[tuple[str, float, float, bool]]:
    """``language, score, bits per character, accepted`` of every text."""
    entropies, lengths = cross_entropies(model, texts)
    out = []
    for row, n in zip(entropies, lengths.tolist(), strict=True):
        if not n or not model.languages:
            out.append((UNDETERMINED, 0.0, None, False))
            continue
        best = int(row.argmin())  # ties: the first language by name
        z = model.sharpness * (row[best] - row) * np.sqrt(n)
        accepted = bool(_deviation(model, row[best], n) <= model.limit)
        out.append((model.languages[best], float(1.0 / np.exp(z).sum()), float(row[best]), accepted))
    return out


def _sample(docs: DataFrame, sample_docs: int) -> DataFrame:
    """``lang, text, aside`` of about ``sample_docs`` rows per language, whole texts, by a hash of the text."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not totals:
        return rows.select("lang", "text", F.lit(False).alias("aside"))
    share = F.create_map(*[F.lit(x) for name, n in totals.items() for x in (name, min(1.0, sample_docs / n))])
    unit = lambda seed: F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return rows.where(unit(2) < share[F.col("lang")]).select("lang", "text", (unit(3) < ASIDE).alias("aside"))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, order: int = ORDER, margin: float = MARGIN) -> Model:
    """Learn from the ``text`` and ``lang`` of ``docs``: all rows given are training rows.

    The driver receives the distinct n-grams and the calibration figures of a
    sample of at most about ``sample_docs`` whole texts per language.
    """
    sample = _sample(docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")), sample_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, limit=_SLICE):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for name in sorted(set(langs)):
                columns, _ = _windows(_letters([t for t, x in zip(texts, langs, strict=True) if x == name])[0], order)
                if not len(columns[0]):
                    continue
                _, first, n = np.unique(_hash(columns), return_index=True, return_counts=True)
                raw = np.stack([c[first] for c in columns], axis=1).astype(np.uint32).tobytes()
                grams = [raw[i : i + 4 * order].decode("utf-32-le", "surrogatepass") for i in range(0, len(raw), 4 * order)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    counted = sample.where("NOT aside").mapInArrow(count, "lang string, gram string, n bigint")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    model = build(list(zip(totals["lang"], totals["gram"], totals["n"], strict=True)), order)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, limit=_SLICE):
            entropies, lengths = cross_entropies(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(lengths, pa.int64()), pa.array(entropies.tolist(), pa.list_(pa.float64()))], ["lang", "n", "bits"])

    aside = sample.where("aside").mapInArrow(measure, "lang string, n bigint, bits array<double>").toPandas()
    aside = aside[aside["lang"].isin(model.languages)]
    if aside.empty:
        return model
    truth = np.array([model.languages.index(x) for x in aside["lang"]])
    return calibrate(model, np.array(aside["bits"].tolist()), aside["n"].to_numpy(), truth, margin)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_char, accepted`` for every row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0, and not
    accepted; so is every text if no language was learned. Rows with equal
    ids stay separate rows. No other column is read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return _predicted(rows, model).select("doc_id", "lang_pred", "score", "bits_per_char", "accepted")


def _predicted(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with a column ``text``) and the four columns of ``predict``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was learned from

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, limit=_SLICE):
            found = predict(shared.value, [t or "" for t in batch.column("text").to_pylist()])
            lang, score, bits, accepted = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64()), pa.array(accepted, pa.bool_())],
                [*batch.schema.names, "lang_pred", "score", "bits_per_char", "accepted"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double, bits_per_char double, accepted boolean")


def keep_identified(docs: DataFrame, learn: Column | None = None, **parameters) -> DataFrame:
    """The rows of ``docs`` whose language is identified, all columns kept; rejected rows go.

    ``learn`` marks the rows that the models may learn from (default: all).
    """
    model = fit(docs if learn is None else docs.where(learn), **parameters)
    if ("text", "string") not in docs.dtypes:
        held = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
        return _predicted(held, model).where("accepted").select("row.*")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was learned from

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, limit=_SLICE):
            found = predict(shared.value, [t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array([accepted for *_, accepted in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
