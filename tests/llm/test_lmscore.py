import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescout.llm import lmscore
from tablescout.llm.common import in_fold

SCHEMA = "doc_id bigint, text string, score string, n int"


def corpus(rng, n):
    words = [f"w{i}É" for i in range(30)]
    rows = []
    for i in range(n):
        at, line = rng.randrange(30), []
        for _ in range(rng.randint(0, 60)):
            at = (at + rng.choice([1, 1, 1, 2])) % 30  # words follow each other
            line.append(words[at].upper() if rng.random() < 0.1 else words[at])
            if rng.random() < 0.1:
                line.append(f"rare{rng.randrange(500)}")
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(line)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "w1É " * 30_000), (n + 3, "again"), (None, "w1É")]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [""]


@pytest.mark.parametrize("limits", [{}, {"head": 12, "words": 10}])
def test_counts_and_base_score_against_brute_force(spark, limits):
    rows = corpus(random.Random(2), 200)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    got = lmscore.score(df, ~in_fold(F.col("doc_id"), 10, 0), **limits).collect()
    counts = Counter(w for i, t in rows if not held(i) for w in split(t))
    total, kinds = sum(counts.values()), len(counts)
    want = [
        (str(i), len(split(t)), sum(counts[w] > 0 for w in split(t)), total, sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in split(t)))
        for i, t in rows
    ]
    got_rows = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    for a, b in zip(got_rows, sorted(want), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)
    out = [r for r in got if held(r.doc_id) and r.n_tokens > 5]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 for r in got)


def small(seed=0):
    rng = np.random.default_rng(seed)
    vocab = lmscore.vocabulary([(f"a{i}".encode(), 20 - i) for i in range(10)], 5, 7, classes=4)
    net = lmscore.Network(*[(p + rng.normal(0, 0.3, p.shape)).astype(np.float64) for p in lmscore.initial(vocab, 6)])
    return rng, vocab, net


def test_gradients_against_differences():
    rng, vocab, net = small()
    x, y = rng.integers(0, 12, (4, 3)), rng.integers(0, 12, (4, 3))
    h = rng.normal(0, 0.5, (3, 6))
    _, gradients, _ = lmscore.loss_and_gradients(net, vocab, x, y, h)
    for p, g in zip(net, gradients, strict=True):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p.shape)
            kept = p[at]
            p[at] = kept + 1e-5
            up = lmscore.loss_and_gradients(net, vocab, x, y, h)[0]
            p[at] = kept - 1e-5
            down = lmscore.loss_and_gradients(net, vocab, x, y, h)[0]
            p[at] = kept
            assert math.isclose((up - down) / 2e-5, g[at], rel_tol=1e-4, abs_tol=1e-6)


def test_probabilities_sum_to_one_and_state_is_carried():
    rng, vocab, net = small(1)
    after = [3, 4, 1]
    every = [lmscore.log_likelihoods(net, vocab, [np.array([*after, t])])[0] for t in range(12)]
    assert math.isclose(sum(10**x for x in every), 10 ** lmscore.log_likelihoods(net, vocab, [np.array(after)])[0], rel_tol=1e-5)
    lines = [rng.integers(0, 12, n) for n in (1, 5, 70, 200, 64)]
    whole = lmscore.log_likelihoods(net, vocab, lines, window=1000)
    assert np.allclose(whole, lmscore.log_likelihoods(net, vocab, lines, window=7), rtol=1e-5)
    assert np.allclose(whole, [lmscore.log_likelihoods(net, vocab, [x])[0] for x in lines], rtol=1e-5)


def test_empty_table_and_nothing_to_learn(spark):
    df = spark.createDataFrame([(0, "a b", "x", 1)], SCHEMA)
    assert lmscore.score(df.where("doc_id > 9"), F.lit(True)).collect() == []
    [row] = lmscore.score(df, F.lit(False)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score) and abs(row.base_score) < 1e-9


def test_network_learns_from_every_document(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "TASK_TOKENS", 500)
    monkeypatch.setattr(lmscore, "FAN", 2)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(20)) + (" x y" if i % 20 == 0 else " y x" if i % 20 == 10 else ""), "", 0) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    seen = spark.sparkContext.accumulator(0)
    encode = lmscore._encode

    def counted(text, vocab):
        seen.add(1)
        return encode(text, vocab)

    monkeypatch.setattr(lmscore, "_encode", counted)
    model = lmscore.fit(df.select(F.col("text").cast("binary").alias("text")))
    assert np.isfinite(lmscore._flat(model.net)).all() and seen.value == len(rows)  # each document once, whatever the rounds


def plain_score(model, text):
    """Word by word with scalars: the network's softmax, and an other word's smoothed share of its class."""
    net, vocab = model.net, model.vocab
    counts = {bytes(r.word): r.n for r in model.counts.collect()}
    mass = model.total + 0.1 * (model.distinct + 1)
    named = sum(counts[w] + 0.1 for w in vocab.token) + counts.get(b"", 0) + 0.1
    size, total = net.carry.shape[0], 0.0
    h, last = np.zeros(size), 0
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for word in split(text):
        word = word.encode()
        x, u = net.read[last].astype(float), h @ net.carry
        z, r = sigmoid(x[:size] + u[:size]), sigmoid(x[size : 2 * size] + u[size : 2 * size])
        h = (1 - z) * np.tanh(x[2 * size :] + r * u[2 * size :]) + z * h
        last = 0 if word == b"" else vocab.token.get(word, 1)
        k = int(vocab.klass[last])
        lo, hi = vocab.edges[k], vocab.edges[k + 1]
        c, w = np.exp(h @ net.class_w + net.class_b), np.exp(net.word_w[lo:hi] @ h + net.word_b[lo:hi])
        p = c[k] / c.sum() * w[last - lo] / w.sum()
        total += math.log10(p * ((counts.get(word, 0) + 0.1) / (mass - named) if last == 1 else 1))
    return total


def test_score_against_plain_network(spark, monkeypatch):
    models, fit = [], lmscore.fit
    monkeypatch.setattr(lmscore, "fit", lambda *a, **b: models.append(fit(*a, **b)) or models[0])
    rows = corpus(random.Random(5), 60)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).coalesce(1)
    got = {(r.doc_id, r.n_tokens): r.score for r in lmscore.score(df, F.col("doc_id") % 3 != 0, head=25, words=20).collect()}
    for i, t in rows:
        if len(t or "") < 1000:
            assert math.isclose(got[i, len(split(t))], plain_score(models[0], t), rel_tol=1e-4), (i, t)


def test_network_tells_the_frequent_words_apart(spark):
    """Two vocabularies of 1,500 words, one a text: a network that reads them all learns which one it is in."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.randrange(1500)}" for _ in range(80)), "", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert lmscore.fit(df.select(F.col("text").cast("binary").alias("text")), rounds=1).words == 3000
    got = lmscore.score(df, F.col("doc_id") >= 300, rounds=1).where("doc_id < 300").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (got[0] - got[1]) / got[2] / math.log10(2) > 0.6  # bits a token, of at most 80/81 and what the end gives
