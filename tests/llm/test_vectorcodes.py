import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescout.llm import vectorcodes

SCHEMA = "vec_id bigint, embedding array<float>, label int, codes string, error int"


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain Python integers throughout; ``rows`` are (vec_id, vector, label)."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for _, v, _ in kept:
                mine.setdefault(near(cut(v, p), books[p])[0], []).append(cut(v, p))
            for e, xs in mine.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    coded = []
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), label))
    total = {}
    for _, _, d, label in coded:
        total[label] = total.get(label, 0) + d
    flat = [str(x) for book in books for entry in book for x in entry]
    return [(i, code, d, total[label]) for i, code, d, label in coded], hashlib.sha256(",".join(flat).encode()).hexdigest()


def check(spark, rows, **parameters):
    df = spark.createDataFrame([(i, v, label, "clash", 1) for i, v, label in rows], SCHEMA).repartition(4)
    found, books = vectorcodes.compress(df, **parameters)
    got = sorted(map(tuple, found.select("vec_id", vectorcodes.hex_code(F.col("codes")), "error", "label_error").collect()), key=str)
    want, digest = brute(rows, **{k: v for k, v in parameters.items() if k != "parts"})
    assert got == sorted(want, key=str)
    assert (books is None) == (digest is None) and (books is None or vectorcodes.books_sha256(books) == digest)


def test_against_brute_force(spark):
    rng = random.Random(3)
    spread = lambda: [float(np.float32(rng.choice([rng.gauss(0, 0.5), rng.randint(-3, 3) / 1024, 0.25]))) for _ in range(8)]
    rows = [(i, spread(), rng.choice([None, 1, 1, 1, 2, rng.randint(3, 500)])) for i in rng.sample(range(5000), 290)]
    rows += [(i, rows[0][1], 1) for i in range(6000, 6030)]  # copies and ties
    rows += [(7000, None, 1), (7001, [math.nan] * 8, 1), (7002, [None] * 8, 2), (7003, [math.inf] * 8, 2), (None, spread(), None), (None, spread(), 2), (5, spread(), 2), (5, spread(), 2)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5] * 4, None)], [(1, [0.5, -0.5, 0.125, 8000.0], 1), (1, [0.5, -0.5, 0.125, -8000.0], None), (None, [0.0] * 4, 3)]])
def test_few_vectors(spark, rows):
    check(spark, rows)
    check(spark, rows, entries=2, rounds=1)


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for top in (1, 100, 1 << 12, 1 << 24, 1 << 29):
        a, b = (rng.integers(-top, top + 1, (n, 16)) for n in (40, 30))
        a[0], b[0] = top, -top
        want = [[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in b] for r in a]
        for bits in (4, 8, 20):
            assert vectorcodes.exact_products(a, b, bits).tolist() == want
            for x in (a, b):
                parts = vectorcodes.limbs(x, bits)
                assert all(np.abs(p).max() <= 1 << bits for p in parts)
                assert (sum(p.astype(np.int64) << (bits * i) for i, p in enumerate(parts)) == x).all()
    with pytest.raises(ValueError):
        vectorcodes.exact_products(a, b, 26)


def test_refused(spark):
    for rows in ([(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)], [(1, [0.0] * 6, 1)]):
        with pytest.raises(ValueError):
            vectorcodes.compress(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA))
    with pytest.raises(Exception, match="beyond"):
        vectorcodes.compress(spark.createDataFrame([(1, [1e6] * 4, 1, "", 0)], SCHEMA))
