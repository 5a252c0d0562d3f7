import random
from collections import Counter

import numpy as np

from tablescout.llm import toxicity

SCHEMA = "doc_id bigint, text string, toxic int, score string, label int"


def corpus(rng, n, first=0):
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.25
        words = ["".join(rng.choice("abcdef") for _ in range(3)) for _ in range(rng.randint(20, 80))]
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["Grubble", "snark", "VILE!", "wretch"])
        rows.append((first + i, " ".join(words), int(toxic), "x", 0))
    return rows


def test_held_out_accuracy_and_edge_cases(spark):
    rng = random.Random(4)
    df = spark.createDataFrame(corpus(rng, 800) + [(None, None, None, "", 0), (5000, None, 0, "", 0), (5001, "", 0, "", 0)], SCHEMA)
    index = toxicity.fit(df, df)
    test = corpus(rng, 300, 10_000)
    got = {r.doc_id: r for r in toxicity.classify(spark.createDataFrame(test, SCHEMA), index).collect()}
    assert sum(got[i].predicted == toxic for i, _, toxic, _, _ in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and len(r.evidence) == len(r.cosines) for r in got.values())
    odd = [(1, None, 0, "", 0), (1, "", 0, "", 0), (2, "\n 12", 0, "", 0), (None, "snark " * 70_000, 0, "", 0)]
    got = toxicity.classify(spark.createDataFrame(odd, SCHEMA), index).collect()
    assert len(got) == 4 and len({r.score for r in got if r.doc_id is not None}) == 1
    assert next(r for r in got if r.doc_id is None).predicted == 1
    assert toxicity.classify(spark.createDataFrame(odd, SCHEMA).where("doc_id > 9"), index).collect() == []


def test_one_label_or_none(spark):
    for rows in ([], [(1, "a b", 0, "", 0)], [(1, "a b", None, "", 0)]):
        df = spark.createDataFrame(rows, SCHEMA)
        index = toxicity.fit(df, df)
        assert [(r.score, r.predicted) for r in toxicity.classify(spark.createDataFrame([(1, "a b", 0, "", 0)], SCHEMA), index).collect()] == [(0.0, 0)]


def test_nearest_against_brute_force():
    rng = random.Random(7)
    terms = {f"t{i}": i for i in range(40)}
    idf = np.array([1 + rng.random() for _ in terms])
    examples = [(i, Counter(rng.choices(list(terms), k=rng.randint(1, 8))), i % 2) for i in range(500)]
    index = toxicity.build(terms, idf, examples + [(900, Counter(), 1)], 0.5, block=16)
    vectors = {}
    for n, counts, _ in examples:
        v = np.zeros(40)
        at, weight = toxicity._vector(index, counts)
        v[at] = weight
        vectors[n] = v
    for _ in range(50):
        counts = Counter(rng.choices(list(terms), k=rng.randint(1, 8)))
        at, weight = toxicity._vector(index, counts)
        place, cosine = toxicity.nearest(index, at, weight, 10)
        q = np.zeros(40)
        q[at] = weight
        every = sorted(((round(float(q @ vectors[n]), 12), -p) for p, n in enumerate(index.ids.tolist())), reverse=True)
        want = [(s, -p) for s, p in every if s > 0][:10]
        assert np.allclose([s for s, _ in want], cosine) and len(want) == len(place)


def test_calibration_rises():
    votes, p = toxicity.calibrate(np.array([0.1, 0.2, 0.2, 0.5, 0.6, 0.9]), np.array([0, 1, 0, 0, 1, 1]))
    assert (np.diff(votes) > 0).all() and (np.diff(p) >= 0).all() and p[0] == 0 and p[-1] == 1


def test_thinned_labels_give_the_same_scores(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        snark = rng.random() < 0.5
        words = ["".join(rng.choice("abcdef") for _ in range(3)) for _ in range(20)] + ["snark"] * snark
        rows.append((i, " ".join(words), int(rng.random() < (0.2 if snark else 0.01)), "", 0))
    df = spark.createDataFrame(rows, SCHEMA)
    every, thin = (toxicity.fit(df, df, examples=n) for n in (4000, 200))
    test = [Counter([*("".join(rng.choice("abcdef") for _ in range(3)) for _ in range(20)), "snark"]) for _ in range(200)]
    means = [np.mean([toxicity.score(index, counts)[0] for counts in test]) for index in (every, thin)]
    assert abs(means[0] - 0.2) < 0.1 and abs(means[1] - means[0]) < 0.1
    _, p = toxicity.calibrate(np.array([0.5, 0.5]), np.array([0, 1]), np.array([9.0, 1.0]))
    assert np.allclose(p, 0.1)


def test_every_word_finds_copies(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdef") * 3 for _ in range(20)) + " grubble" * (i % 4 == 0), int(i % 4 == 0), "", 0) for i in range(400)]
    lone = [(1000 + i, f"zyx{'abcdefgh'[i]} qwv{'abcdefgh'[i]}", 1, "", 0) for i in range(8)]  # words of one example each
    df = spark.createDataFrame(rows + lone, SCHEMA)
    index = toxicity.fit(df, df)
    found = [toxicity.score(index, toxicity.terms_of(text)) for i, text, *_ in lone if i in index.ids]
    assert found and all(p > 0.9 and ids and np.isclose(cosines[0], 1) for p, ids, cosines in found)
    many = [toxicity.terms_of(text) for _, text, *_ in rows]
    assert [ids for _, ids, _ in toxicity.score_all(index, many)] == [toxicity.score(index, counts)[1] for counts in many]


def test_blocks_below_the_bound_are_not_read():
    """The query's own weights, against every cosine; alike examples share blocks, so most blocks are skipped."""
    rng = random.Random(9)
    topics = [[f"t{i}w{j}" for j in range(12)] for i in range(30)]
    text = lambda i: Counter(rng.choices(topics[i], k=8) + rng.choices(["the", "of", "and"], k=6) + [f"u{rng.randrange(4000)}"])
    examples = [(i, text(i % 30), int(i % 30 < 5)) for i in range(3000)]
    terms, weight, unseen = toxicity.term_weights(examples)
    index = toxicity.build(terms, weight, examples, 0.5, unseen=unseen, block=16)
    vectors = {n: dict(zip(*(x.tolist() for x in toxicity._vector(index, counts)), strict=True)) for n, counts, _ in examples}
    read = []
    for i in range(60):
        at, w = toxicity._vector(index, text(i % 30))
        heavy = np.zeros(len(index.dense))
        frequent = index.row[at] >= 0
        heavy[index.row[at[frequent]]] = w[frequent]
        place, cosine, blocks = toxicity._best(index, at, w, heavy @ index.dense, 15)
        every = [round(sum(x * vectors[n].get(t, 0) for t, x in zip(at.tolist(), w.tolist(), strict=True)), 10) for n in index.ids.tolist()]
        assert np.allclose(sorted(every, reverse=True)[:15], cosine) and np.allclose([every[p] for p in place], cosine)
        read.append(blocks)
    assert max(read) < 188 and np.mean(read) < 188 / 2


def test_copies_count_once_and_rows_alike(spark):
    df = spark.createDataFrame([(i, "vile snark", 1, "", 0) for i in range(300)] + [(500 + i, f"calm word{i}", 0, "", 0) for i in range(60)] + [(900, "x y", 0, "", 0)] * 3, SCHEMA)
    index = toxicity.fit(df, df.union(df.where("doc_id = 900")), examples=50)
    assert np.isclose(index.share[1], 1) and np.isclose(index.share[0] * 50, 61) and len(index.ids) <= 51
