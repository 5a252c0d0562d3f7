"""Exact and sketched order statistics against sorting in plain Python."""

import math
import random

import pytest

from tablescout.operators import aggregates, discovery, passthrough, ranks


def plain(values, p, interpolate):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    if not values:
        return None
    if not interpolate:
        return float(values[max(1, math.ceil(p * len(values))) - 1])
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return float(low) if low == high else low * (1 - (at - math.floor(at))) + high * (at - math.floor(at))


@pytest.mark.parametrize("interpolate", [False, True])
def test_quantiles_against_sorting(spark, interpolate):
    rng = random.Random(1)
    rows = [(rng.choice([None, float("nan"), 0.0, -0.0, rng.gauss(0, 9)]), rng.choice([None, 7, 7, rng.randint(-50, 50)]), 2**40 + i, None, f"s{i}") for i in range(700)]
    df = spark.createDataFrame(rows, "`d.x` double, i int, b bigint, empty double, s string").repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.731, 1.0]
    got = {(r.column, r.prob): r.value for r in ranks.quantiles(df, ["d.x", "i", "b", "empty"], probs, interpolate).collect()}
    for k, name in enumerate(["d.x", "i", "b", "empty"]):
        for p in probs:
            want = plain([r[k] for r in rows], p, interpolate)
            assert got[name, p] == want if want is None else got[name, p] == pytest.approx(want, rel=1e-12, abs=1e-12)
    with pytest.raises(TypeError):
        ranks.quantiles(df, ["s"], [0.5])
    with pytest.raises(ValueError):
        ranks.quantiles(df, ["i"], [1.5])


def test_more_distinct_values_than_a_sketch_keeps_apart(spark):
    n = 2_500_001
    df = spark.range(n).selectExpr("id * 3 + 1 AS x")
    assert [r.value for r in passthrough.quantiles(df, "x", [0.5, 0.9999999], 0).collect()] == [3.0 * (n // 2) + 1, 3.0 * (n - 1) + 1]
    assert aggregates.aggregate(df, "median", "x").first()[0] == 3.0 * (n // 2) + 1


def test_medians(spark):
    df = spark.createDataFrame([(1, None, 2.5), (4, None, 2.5), (2, None, None)], "a int, b int, c double")
    assert tuple(aggregates.aggregate(df, "median").first()) == (2.0, None, 2.5)
    assert tuple(aggregates.aggregate(df.where("a > 9"), "median", ["a"]).first()) == (None,)


def test_sketched_quantiles_are_within_their_error(spark):
    df = spark.range(200_000).selectExpr("id % 1000 AS few", "pow(id, 1.5) AS skewed", "CAST(NULL AS DOUBLE) AS none")
    found = ranks.approximate_quantiles(df, ["few", "skewed", "none"], [0.0, 0.1, 0.5, 0.99, 1.0], 0.02)
    assert {(r.column, r.prob) for r in found.where("value IS NULL").collect()} == {("none", p) for p in (0.0, 0.1, 0.5, 0.99, 1.0)}
    errors = ranks.rank_errors(df, found, ["few", "skewed"]).collect()
    assert len(errors) == 10 and max(r.error for r in errors) <= 0.02
    with pytest.raises(ValueError):
        passthrough.quantiles(df, "few", [0.5], -0.1)


def test_frequent_items_are_exact(spark):
    rng = random.Random(2)
    values = ["hot"] * 400 + ["warm"] * 60 + [None] * 300 + [f"v{rng.randrange(5000)}" for _ in range(4000)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "`a.b` string, m int").repartition(7)
    got = {(r.column, r.value): r["count"] for r in passthrough.frequent_items(df, ["a.b", "m"], 0.01).collect()}
    want = {("a.b", v): values.count(v) for v in set(values) - {None} if values.count(v) > 0.01 * len(values)}
    want |= {("m", str(k)): sum(i % 3 == k for i in range(len(values))) for k in range(3)}
    assert got == want and ("a.b", "hot") in got
    assert passthrough.PASS_THROUGH["freqItems"](df, ["a.b"]).columns == ["a.b_freqItems"]
    assert passthrough.PASS_THROUGH["describe"](df, ["a.b"]).columns == ["summary", "a.b"]
    assert passthrough.PASS_THROUGH["summary"](df, ["m"], "count").first()["m"] == str(len(values))


def test_three_hundred_columns(spark):
    df = spark.range(200).selectExpr(*[f"id % {k % 17 + 1} AS c{k}" for k in range(300)])
    mode = aggregates.aggregate(df, "mode").first()
    assert len(mode) == 300 and all(v == 0 for v in mode)
    from tablescout.operators import profile

    assert list(profile.distinct_count(df, None).first()) == [k % 17 + 1 for k in range(300)]


def containments(tables):
    sets = {(t, c): {r[c] for r in df.select(c).collect()} - {None} for t, df in enumerate(tables) for c in df.columns}
    return {(a, b): len(x & y) / len(x) for a, x in sets.items() for b, y in sets.items() if a[0] != b[0] and x and x & y}


def test_small_columns_are_found_in_large_ones(spark):
    big = spark.range(40_000).selectExpr("CAST(id AS STRING) AS k", "CAST(id % 100 AS STRING) AS r")
    small = spark.createDataFrame([(str(i), f"x{i}" if i % 2 else str(i)) for i in range(25)] + [(None, None)], "k string, half string")
    want = containments([big, small])
    for sample in (64, 1 << 17):
        got = {((r.at_ind, r.ac_name), (r.bt_ind, r.bc_name)): r for r in discovery.containment_paths([big, small], 0.4, sample=sample).collect()}
        assert got[(1, "k"), (0, "k")].containment == 1.0 and got[(1, "k"), (0, "k")].error == 0.0
        assert got[(1, "half"), (0, "k")].containment == pytest.approx(13 / 25)
        assert {k: r.containment for k, r in got.items() if r.error == 0.0}.items() <= {k: pytest.approx(v) for k, v in want.items()}.items() or all(
            r.containment == pytest.approx(want[k]) for k, r in got.items() if r.error == 0.0
        )
    errors = discovery.containment_errors([big, small], sample=64, confidence=0.999999).collect()
    assert {((r.at_ind, r.ac_name), (r.bt_ind, r.bc_name)): r.exact for r in errors} == want and all(r.within for r in errors)


def test_join_sizes_are_within_their_error(spark):
    a = spark.range(6000).selectExpr("CAST(id % 700 AS STRING) AS k", "CAST(pow(id, 0.5) AS INT) || '' AS skewed")
    b = spark.range(9000).selectExpr("CAST(id % 900 AS STRING) AS k", "'none' || id AS other")
    got = {(r.ac_name, r.bc_name): r for r in discovery.join_sizes([a, b]).collect()}
    exact = {(x, y): a.select(x).join(b.select(y), a[x] == b[y]).count() for x in a.columns for y in b.columns}
    for pair, size in exact.items():
        assert abs(got[pair].size - size) <= got[pair].error, pair
    errors = discovery.join_size_errors([a, b]).collect()
    assert {(r.ac_name, r.bc_name): r.exact for r in errors} == {k: v for k, v in exact.items() if v} and all(r.within for r in errors)


def test_wide_family_against_big_integers(spark):
    import hashlib

    from pyspark.sql import functions as F

    from tablescout.functions import hashing

    co = hashing.hash_coefficients(40, 5, wide=True)
    words = ["", "a", "é", "x" * 1000] + [f"v{i}" for i in range(60)]
    df = spark.createDataFrame([(w,) for w in words], "v string").select("v", hashing.wide_key(F.col("v")).alias("x"), F.inline(hashing.coefficient_array(co)))
    extreme = spark.createDataFrame([(f"edge{x}", x) for x in (0, 1, 2**31 - 1, 2**31, 2**60 - 1)], "v string, x bigint").select("v", "x", F.inline(hashing.coefficient_array(co)))
    got = df.union(extreme).select("v", "x", "hash_index", hashing.wide_hash(F.col("x"), F.col("a_hi"), F.col("a_lo"), F.col("b")).alias("h")).collect()
    for r in got:
        if not r.v.startswith("edge"):
            assert r.x == int(hashlib.md5(r.v.encode()).hexdigest()[:15], 16)
        assert r.h == (co.a[r.hash_index] * r.x + co.b[r.hash_index]) % (2**61 - 1)
    top = hashing.HashCoefficients((2**61 - 2, 1), (2**61 - 2, 0), 0, True)
    rows = spark.createDataFrame([(2**60 - 1,), (0,)], "x bigint").select("x", F.inline(hashing.coefficient_array(top)))
    for r in rows.select("x", "hash_index", hashing.wide_hash(F.col("x"), F.col("a_hi"), F.col("a_lo"), F.col("b")).alias("h")).collect():
        assert r.h == (top.a[r.hash_index] * r.x + top.b[r.hash_index]) % (2**61 - 1)


def test_modes_of_long_texts_with_equal_beginnings(spark):
    from tablescout.operators import profile

    rows = [("same beginning " + c * 3, None if c == "b" else c) for c in "abcz"] + [("same beginning z", "zz"), ("", "zz"), (None, None)]
    df = spark.createDataFrame(rows, "s string, t string").repartition(3)
    got = {r.column: tuple(r)[1:] for r in profile.cat_describe(df).collect()}
    assert got["s"] == (7, 7, "same beginning zzz", 1) and got["t"] == (7, 5, "zz", 2)
    assert tuple(profile.cat_describe(df.where("t IS NULL"), ["t"]).first()) == ("t", 2, 1, None, 2)
