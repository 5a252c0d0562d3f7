import itertools
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tablescout.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, taken int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Shares by weight; what is above twice the size stops there, the excess is shared again."""
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    rest, out = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        free = [x for x in names if x not in out]
        total = sum(weight[x] for x in free)
        above = [x for x in free if rest * weight[x] / total > 2 * sizes[x]]
        if not above:
            return out | {x: rest * weight[x] / total for x in free}
        for x in above:
            out[x] = Fraction(2 * sizes[x])
        rest -= sum(Fraction(2 * sizes[x]) for x in above)


def corpus(rng, n, sources):
    out = []
    for i in range(n):
        text = rng.choice([None, "", " \t\n", "a b c\u0085d", " ".join(["w"] * rng.randint(1, 60)), "one two\x0bthree\x0cfour\x1cfive"])
        out.append((i, text, rng.choice(sources), "clash", 7))
    return out


@pytest.mark.parametrize("sources", [["a"], ["b", "a", None], ["z", "Z", "é", "\U0001f600", "ﬁ", "", None], ["hot"] * 20 + [f"s{i}" for i in range(30)]])
def test_single_sources_against_plain_targets(spark, sources):
    rng = random.Random(len(sources))
    rows = corpus(rng, 600, sources) + [(9000, "x " * 5000, sources[0], "", 0), (9001, "y", sources[0], "", 0), (9001, "y", sources[0], "", 0), (None, "y y", sources[0], "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = lambda parts: sorted(map(tuple, mixing.mix(df.repartition(parts), F.array("source"), buckets=64).collect()), key=str)
    got = once(3)
    assert got == once(5)
    words = [(i, len(WORD.findall(t or "")), s) for i, t, s, _, _ in rows]
    sizes = {s: sum(n for _, n, x in words if x == s) for _, _, s in words}
    goal = plain_targets(sizes)
    assert sorted(words, key=str) == sorted(((i, n, s[0]) for i, n, s, _, _, _ in got), key=str)
    taken = dict.fromkeys(sizes, 0)
    for _, n, (s,), (size,), (target,), t in got:
        assert size == sizes[s] and target == float(goal[s]) and 0 <= t <= 2 * n
        taken[s] += t
    assert all(abs(taken[s] - goal[s]) <= Fraction(1, 2) for s in sizes)
    for s in sizes:  # whole copies, but for one document of a source
        assert sum(t % n > 0 for _, n, (x,), _, _, t in got if x == s and n) <= 1


def test_overlapping_sources(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 9), rng.choice(["a", "b", "a,b", "b,c", "a,b,c", "c,a,c", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, s string")
    got = mixing.mix(df, F.split("s", ",")).collect()
    assert len(got) == 500 and all(r.taken == 0 and r.sources == [] for r in got if not r.sources)
    assert all(r.sources == sorted(set(r.sources)) and r.taken <= 2 * r.size for r in got)
    goal = {s: t for r in got for s, t in zip(r.sources, r.targets, strict=True)}
    assert abs(sum(r.taken for r in got) - sum(goal.values())) <= 2
    for s in goal:  # what a source's documents give covers its target
        assert sum(r.taken for r in got if s in r.sources) >= goal[s] - 1


def cheapest(patterns, sizes, quotas, copies):
    """Every amount of every pattern tried: the largest flow's least cost."""
    best = (0, 0)
    for taken in itertools.product(*(range(s * len(copies) + 1) for s in sizes)):
        if sum(taken) < best[0]:
            continue
        cost = sum(copies[i // s] for x, s in zip(taken, sizes, strict=True) for i in range(x))
        if (sum(taken), -cost) > best and all(  # Hall's condition: each set of patterns fits into its sources
            sum(taken[p] for p in some) <= sum(quotas[s] for s in {s for p in some for s in patterns[p]})
            for k in range(1, len(patterns) + 1) for some in itertools.combinations(range(len(patterns)), k)
        ):
            best = (sum(taken), -cost)
    return best


def test_flow_is_the_cheapest():
    rng = random.Random(11)
    for _ in range(60):
        sources = rng.randint(1, 3)
        patterns = [tuple(sorted(rng.sample(range(sources), rng.randint(1, sources)))) for _ in range(3)]
        sizes = [rng.randint(0, 3) for _ in patterns]
        quotas = [rng.randint(0, 6) for _ in range(sources)]
        copies = rng.choice([(0, 1), (1, 3, 7), (0, 0)])
        taken = mixing.cheapest_flow(patterns, sizes, quotas, copies)
        cost = sum(copies[i // s] for x, s in zip(taken, sizes, strict=True) for i in range(x))
        assert (sum(taken), -cost) == cheapest(patterns, sizes, quotas, copies)
    with pytest.raises(ValueError):
        mixing.cheapest_flow([(0,)], [1], [1], (2, 1))


def test_empty_tables(spark):
    df = spark.createDataFrame(corpus(random.Random(1), 3, ["a"]), SCHEMA)
    assert mixing.mix(df.where("doc_id < 0"), F.array("source")).collect() == []
    assert [r.taken for r in mixing.mix(df.withColumn("text", F.lit(None)), F.array("source")).collect()] == [0, 0, 0]
