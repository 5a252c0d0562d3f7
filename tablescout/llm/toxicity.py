"""Toxicity by the nearest labelled examples.

A text is a vector of TF-IDF weights over all its words, each times how far
the word tells the labels apart, but never zero. The labelled examples'
vectors, every word of them, lie in an inverted index cut into blocks of
examples: rarer words have postings with the largest weight of each block, the
weights of frequent words are a matrix. A block's bound is the best frequent
part in it plus the query's weights times those largest weights. The blocks
with the highest bounds are read first, and no other block is read whose bound
is below the k-th best cosine so far, so the k nearest are exact. Their votes,
weighted by cosine, are calibrated on examples kept out of the index and come
back with the examples as evidence.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import arrow_slices, field_type, stored

NEIGHBOURS = 15
EXAMPLES = 4000  # different labelled texts of each label that are learned from, at most; a hash of the text decides which
ASIDE = 0.25  # share of them that calibrates the votes and is not indexed
FREQUENT = 256  # terms of the index, at most, whose weights are kept for every example; the others have postings
FREQUENT_SHARE = 1 / 32  # of the examples, from which a term is one of them
FLOOR = 0.003  # weight of a word that says nothing about the label; one that decides it has 1 more
BATCH = 64  # texts whose cosines are taken together
BLOCK = 64  # examples in a block of the index
FIRST_BLOCKS = 4  # read before any is skipped
SLACK = 1e-9  # by which rounding may falsify a bound
PREDICT_AT = 0.7
_WORD = regex.compile(r"\p{L}+")


class Index(NamedTuple):
    terms: dict[str, int]
    idf: np.ndarray  # each term's weight
    unseen: float  # that of a term that no example has
    ids: np.ndarray  # the examples' numbers, one row each below
    labels: np.ndarray
    places: np.ndarray  # postings of all terms but the frequent ones
    weights: np.ndarray
    spans: np.ndarray  # where each term's blocks begin, and their number
    blocks: np.ndarray  # each term's blocks, one after another: number, first posting, largest weight
    firsts: np.ndarray
    largest: np.ndarray
    row: np.ndarray  # a frequent term's row below, -1 for others
    dense: np.ndarray  # frequent terms x examples, filled up to whole blocks
    block: int
    prior: float
    share: np.ndarray  # how many labelled rows one example of label 0 and of label 1 stands for
    steps: tuple[np.ndarray, np.ndarray]  # calibration: raw votes and probabilities, both ascending


def terms_of(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def _vector(index: Index, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and TF-IDF weights of the known terms, scaled so that all terms have length 1; empty if none is known."""
    at = np.fromiter((index.terms.get(w, -1) for w in counts), np.int64, len(counts))
    weight = (1 + np.log(np.fromiter(counts.values(), float, len(counts)))) * np.where(at < 0, index.unseen, index.idf[at] if len(index.idf) else 0.0)
    known = np.flatnonzero(at >= 0)
    order = known[np.argsort(at[known])]
    return at[order], weight[order] / np.sqrt((weight**2).sum()) if len(order) else np.zeros(0)


def term_weights(examples: list[tuple[int, Counter, int]], share: tuple[float, float] = (1.0, 1.0)) -> tuple[dict[str, int], np.ndarray, float]:
    """Every term of the examples, its weight, and that of a term in none.

    The weight is the inverse document frequency times ``FLOOR`` plus the
    size of the term's correlation with the label, so words that tell the
    labels apart count most and no word is dropped. An example counts for
    ``share[label]`` documents, which makes both independent of the sample.
    """
    terms: dict[str, int] = {}
    at = np.array([terms.setdefault(w, len(terms)) for _, counts, _ in examples for w in counts], np.int64)
    on = np.repeat(np.array([label for _, _, label in examples], float), [len(counts) for _, counts, _ in examples])
    with_off, with_on = (np.bincount(at, on == label, minlength=len(terms)) * share[label] for label in (0, 1))
    off, on = (share[label] * sum(x == label for _, _, x in examples) for label in (0, 1))
    total, docs = off + on, with_off + with_on
    spread = np.sqrt(np.maximum(docs * (total - docs), 1) * max(off * on, 1))
    return terms, (np.log((1 + total) / (1 + docs)) + 1) * (FLOOR + np.abs(with_on * off - with_off * on) / spread), (math.log(1 + total) + 1) * FLOOR


def build(terms: dict[str, int], idf: np.ndarray, examples: list[tuple[int, Counter, int]], prior: float, block: int = BLOCK, share: tuple[float, float] = (1.0, 1.0), unseen: float = 0.0) -> Index:
    """The index of ``(number, term counts, label)`` examples; those without a known term are left out."""
    none, no = np.zeros(0, np.int64), np.zeros(0)
    index = Index(terms, idf, unseen, none, no, none, no, none, none, none, no, none, np.zeros((0, 0)), block, prior, np.array(share, float), (no, no))
    vectors = [(n, label, *_vector(index, counts)) for n, counts, label in examples]
    vectors = [v for v in vectors if len(v[2])]
    vectors.sort(key=lambda v: (int(v[2][v[3].argmax()]), v[0]))  # alike vectors share a block
    size = len(vectors)
    if not size:
        return index
    at, weight = (np.concatenate([v[i] for v in vectors]) for i in (2, 3))
    place = np.repeat(np.arange(size), [len(v[2]) for v in vectors])
    docs = np.bincount(at, minlength=len(terms))
    frequent = np.argsort(-docs, kind="stable")[:FREQUENT]
    frequent = frequent[docs[frequent] >= max(2, size * FREQUENT_SHARE)]
    row = np.full(len(terms), -1, np.int32)
    row[frequent] = np.arange(len(frequent))
    dense = np.zeros((len(frequent), -(-size // block) * block))
    mine = row[at] >= 0
    dense[row[at[mine]], place[mine]] = weight[mine]
    at, place, weight = at[~mine], place[~mine], weight[~mine]
    order = np.argsort(at, kind="stable")  # by term, then by place
    at, place, weight = at[order], place[order], weight[order]
    of = at * (size // block + 1) + place // block
    firsts = np.flatnonzero(np.diff(of, prepend=-1))
    return index._replace(
        ids=np.array([v[0] for v in vectors], np.int64),
        labels=np.array([v[1] for v in vectors], float),
        places=place.astype(np.int32),
        weights=weight,
        spans=np.r_[0, np.cumsum(np.bincount(at[firsts], minlength=len(terms)))],
        blocks=place[firsts] // block,
        firsts=np.r_[firsts, len(at)],
        largest=np.maximum.reduceat(weight, firsts) if len(firsts) else weight,
        row=row,
        dense=dense,
    )


def nearest(index: Index, at: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
    """Places and cosines of the k nearest examples with a positive cosine; ties to the smaller place."""
    return nearest_all(index, [(at, weight)], k)[0]


def nearest_all(index: Index, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
    """``nearest`` of every vector; the frequent terms' part is one matrix product for ``BATCH`` of them."""
    if not len(index.ids):
        return [(np.zeros(0, np.int64), np.zeros(0))] * len(vectors)
    out = []
    for lo in range(0, len(vectors), BATCH):
        part = vectors[lo : lo + BATCH]
        heavy = np.zeros((len(part), len(index.dense)))
        for q, (at, weight) in enumerate(part):
            frequent = index.row[at] >= 0
            heavy[q, index.row[at[frequent]]] = weight[frequent]
        for (at, weight), frequent in zip(part, heavy @ index.dense, strict=True):
            out.append(_best(index, at, weight, frequent, k)[:2])
    return out


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[i] .. first[i] + n[i] - 1`` for each i, one after another."""
    return np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)


def _best(index: Index, at: np.ndarray, weight: np.ndarray, frequent: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and cosines of the k nearest, and how many blocks were read; ``frequent`` is the frequent terms' part."""
    rare = index.row[at] < 0
    n = index.spans[at[rare] + 1] - index.spans[at[rare]]
    entries, times = _ranges(index.spans[at[rare]], n), np.repeat(weight[rare], n)
    parts = frequent.reshape(-1, index.block)
    bound = parts.max(axis=1) + np.bincount(index.blocks[entries], index.largest[entries] * times, minlength=len(parts)) + SLACK
    order = np.argsort(-bound, kind="stable")
    scores = np.full(parts.shape, -1.0)
    for chosen in (order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]):
        known = scores[scores > 0]
        least = np.partition(known, -k)[-k] if len(known) >= k else SLACK
        chosen = chosen[bound[chosen] > least]
        if not len(chosen):
            continue
        read = np.zeros(len(parts), bool)
        read[chosen] = True
        mine = read[index.blocks[entries]]
        some = entries[mine]
        length = index.firsts[some + 1] - index.firsts[some]
        postings = _ranges(index.firsts[some], length)
        found = np.bincount(index.places[postings], index.weights[postings] * np.repeat(times[mine], length), minlength=parts.size).reshape(parts.shape)
        scores[chosen] = np.round(parts[chosen] + found[chosen], 12)
    flat = scores.ravel()
    known = np.flatnonzero(flat > 0)
    if len(known) > k:
        known = known[flat[known] >= np.partition(flat[known], -k)[-k]]
    place = known[np.lexsort((known, -flat[known]))[:k]]
    return place, flat[place], int((scores[:, 0] >= 0).sum())


def _votes(index: Index, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[float | None, np.ndarray, np.ndarray]]:
    for place, score in nearest_all(index, vectors, k):
        each = score * index.share[index.labels[place].astype(int)]  # labels are sampled at rates of their own
        yield (float((each * index.labels[place]).sum() / each.sum()) if len(place) else None), place, score


def calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: pooled neighbours until the weighted shares of label 1 rise with the vote."""
    weights = np.ones(len(votes)) if weights is None else weights
    pools: list[list[float]] = []
    for vote, label, weight in sorted(zip(votes.tolist(), labels.tolist(), weights.tolist(), strict=True)):
        if pools and pools[-1][0] == vote:
            pools[-1][1] += label * weight
            pools[-1][2] += weight
        else:
            pools.append([vote, label * weight, weight])
    merged: list[list[float]] = []
    for pool in pools:
        merged.append([pool[0] * pool[2], pool[1], pool[2]])
        while len(merged) > 1 and merged[-2][1] * merged[-1][2] >= merged[-1][1] * merged[-2][2]:
            last = merged.pop()
            merged[-1] = [a + b for a, b in zip(merged[-1], last, strict=True)]
    return np.array([m[0] / m[2] for m in merged]), np.array([m[1] / m[2] for m in merged])


def score(index: Index, counts: Counter, k: int = NEIGHBOURS) -> tuple[float, list[int], list[float]]:
    """The calibrated score, the nearest examples' numbers and their cosines."""
    return score_all(index, [counts], k)[0]


def score_all(index: Index, texts: list[Counter], k: int = NEIGHBOURS) -> list[tuple[float, list[int], list[float]]]:
    out = []
    for vote, place, cosine in _votes(index, [_vector(index, counts) for counts in texts], k):
        if vote is None:
            out.append((index.prior, [], []))
            continue
        p = float(np.interp(vote, *index.steps)) if len(index.steps[0]) else vote
        out.append((min(1.0, max(0.0, p)), index.ids[place].tolist(), cosine.tolist()))
    return out


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, k: int = NEIGHBOURS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Index:
    """Learn from the rows of ``docs`` that ``labels`` (id and 0 or 1) names; other labels and null ids are left out.

    All labelled rows decide which texts there are; copies of a text with the
    same label count once. The index and the calibration come from at most
    ``examples`` different texts of each label, all words of each, the first
    by a hash of the text; in frequencies, votes and calibration each stands
    for as many texts as its label's rate says. Texts meet the labels as
    hashes alone; only the chosen ones are fetched, by one more scan.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("key"))
    marks = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    texts = stored(rows.join(marks, "doc_id").groupBy("key", "toxic").agg(F.min("doc_id").alias("doc_id")))
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = lambda seed: F.xxhash64("key", F.lit(seed))
    chosen = [r for label in (0, 1) for r in texts.where(F.col("toxic") == label).orderBy(order(11), "key").limit(examples).select("key", "toxic", "doc_id", (F.pmod(order(12), F.lit(1000)) < 1000 * ASIDE).alias("aside")).collect()]
    wanted = docs.sparkSession.createDataFrame(chosen, "key bigint, toxic int, doc_id bigint, aside boolean")  # twice ``examples`` at most
    whole = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            found = [sorted(terms_of(t).items()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "key", "toxic", "aside")), pa.array([[w for w, _ in x] for x in found], pa.list_(pa.string())), pa.array([[n for _, n in x] for x in found], pa.list_(pa.int64()))],
                ["doc_id", "key", "toxic", "aside", "terms", "n"],
            )

    counted = whole.join(F.broadcast(wanted), ["doc_id", "key"]).mapInArrow(count, "doc_id bigint, key bigint, toxic int, aside boolean, terms array<string>, n array<bigint>")
    found: dict[tuple[int, int], tuple] = {}  # bounded by the examples; rows alike in id and text come once
    for r in counted.toArrow().to_batches(max_chunksize=256):
        for doc, key, label, aside, words, n in zip(*(c.to_pylist() for c in r.columns), strict=True):
            found.setdefault((key, label), (doc, Counter(dict(zip(map(sys.intern, words), n, strict=True))), label, aside))
    examples_ = [found[x] for x in sorted(found)]
    learned, kept = ([(doc, counts, label) for doc, counts, label, aside in examples_ if aside == kind] for kind in (False, True))
    sampled = Counter(label for _, _, label in learned + kept)
    share = tuple(totals.get(label, 0) / max(1, sampled[label]) for label in (0, 1))
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    terms, weight, unseen = term_weights(learned, share)
    index = build(terms, weight, learned, prior, share=share, unseen=unseen)
    votes, truth, blank = [], [], [1.0, prior]
    for (_, _, label), (vote, _, _) in zip(kept, _votes(index, [_vector(index, counts) for _, counts, _ in kept], k), strict=True):
        if vote is None:  # no known term: the share of label 1 among such rows, weighted back to all rows
            blank = [blank[0] + share[label], blank[1] + share[label] * label]
        else:
            votes.append(vote)
            truth.append(label)
    return index._replace(prior=blank[1] / blank[0], steps=calibrate(np.array(votes), np.array(truth), np.array([share[label] for label in truth])))


def classify(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """``doc_id, score, predicted, evidence, cosines`` for every row of ``docs``.

    ``evidence`` lists the ids of the nearest labelled examples, nearest
    first. Null and empty texts, and texts without a known term, have no
    neighbour and take the share of toxic rows among such examples. Rows
    with equal ids stay separate; no other column is read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(index)  # bounded by EXAMPLES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            found = score_all(shared.value, [terms_of(t) for t in batch.column("text").to_pylist()], k)
            p, evidence, cosines = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p, pa.float64()), pa.array([int(x >= PREDICT_AT) for x in p], pa.int32()), pa.array(evidence, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))],
                ["doc_id", "score", "predicted", "evidence", "cosines"],
            )

    return rows.mapInArrow(run, f"doc_id {field_type(rows, 'doc_id')}, score double, predicted int, evidence array<bigint>, cosines array<double>")
