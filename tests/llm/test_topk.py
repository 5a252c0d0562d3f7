import math
import random

import pytest
from pyspark.sql import functions as F

from tablescout.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string"


def brute(rows, k=5):
    good = [
        (i, key, [math.floor(256 * x) for x in v])
        for i, (key, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, key, q in good:
        if key is not None and key % 50 == 0:
            scored = [(-sum(a * b for a, b in zip(q, c, strict=False)), j is None, j or 0, j) for n, j, c in good if n != i]
            out += [(key, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [{}, {"candidate_rows": 16, "query_rows": 3}])
def test_against_brute_force(spark, blocks):
    rng = random.Random(2)
    exact = lambda n: [rng.choice([0.0, 0.001, -1.0]) if rng.random() < 0.3 else rng.randint(-4000, 4000) / 1024 for _ in range(n)]
    rows = [(i, exact(8)) for i in range(0, 300)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]  # a group of copies: ties
    rows += [(50, exact(8)), (50, exact(8)), (None, exact(8)), (400, None), (450, []), (500, [1.0, None]), (550, [float("nan")])]
    rows += [(600, [float("inf")]), (650, exact(3)), (700, exact(12)), (-50, exact(8)), (750, [0.0] * 8)]
    df = spark.createDataFrame([(k, v, 1, "clash") for k, v in rows], SCHEMA).repartition(5)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, **blocks).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(brute(rows))


def test_few_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0], 1, ""), (1, [2.0], 1, "")], SCHEMA)
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(df.where("vec_id = 1"), F.col("vec_id") % 50 == 0).collect() == []


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [2e7, 1.0], 1, ""), (1, [1e6, -5.0], 1, ""), (2, [1e6, -6.0], 1, "")], SCHEMA)
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()]
    assert [(r[2], r[3]) for r in sorted(got)] == [(1, 2 * 10**7 * 256 * 10**6 * 256 - 256 * 5 * 256), (2, 2 * 10**7 * 256 * 10**6 * 256 - 256 * 6 * 256)]
