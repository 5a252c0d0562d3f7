import binascii
import math
import random

import pytest

from tablescout.functions.hashing import PRIME, hash_coefficients
from tablescout.operators import joinpaths as jp
from tablescout.operators import signature as sg


def brute_signature(values, coeffs):
    """Reference semantics: per hash, min over rows and the number of rows at the min."""
    out = []
    crcs = [binascii.crc32(v.encode("utf-8")) & 0xFFFFFFFF for v in values if v is not None]
    for i, a, b in coeffs.rows():
        hs = [(a * x + b) % PRIME for x in crcs]
        m = min(hs)
        out.append((i, m, hs.count(m)))
    return out


def test_coefficients_are_seeded_and_in_range():
    c1, c2 = hash_coefficients(100, 7), hash_coefficients(100, 7)
    assert c1 == c2
    assert len(set(c1.a)) == 100 and len(set(c1.b)) == 100
    assert all(1 <= a < 2**32 for a in c1.a) and all(0 <= b < 2**32 for b in c1.b)
    assert hash_coefficients(3, 1).hashnum == 3
    with pytest.raises(ValueError):
        hash_coefficients(0)


def test_signature_matches_brute_force(spark, g0):
    coeffs = hash_coefficients(25, 3)
    sig = sg.multiple_table_signature(g0, coeffs).collect()
    got = {}
    for r in sig:
        got.setdefault((r.table_index, r.col_name), []).append((r.hash_index, r.hash_value, r.min_hash_count))
    got = {k: sorted(v) for k, v in got.items()}
    rows0 = [("foo", "lst"), ("max", "lst"), ("lst", "dt"), ("foo", "show")]
    rows1 = [("foo", "max"), ("foo", "vs"), ("lst", "re")]
    expect = {
        (0, "k"): brute_signature([r[0] for r in rows0], coeffs),
        (0, "t"): brute_signature([r[1] for r in rows0], coeffs),
        (1, "l"): brute_signature([r[0] for r in rows1], coeffs),
        (1, "m"): brute_signature([r[1] for r in rows1], coeffs),
    }
    for key, rows in expect.items():
        assert sorted(rows) == got[key]


def test_universal_hash_is_exact_for_large_operands(spark):
    from pyspark.sql import functions as F

    from tablescout.functions.hashing import universal_hash

    rng = random.Random(5)
    triples = [(rng.randrange(1, 2**32), rng.randrange(0, 2**32), rng.randrange(0, 2**32)) for _ in range(300)]
    df = spark.createDataFrame(triples, "a long, b long, x long")
    got = df.select(
        "a", "b", "x",
        universal_hash(F.col("x"), F.floor(F.col("a") / 65536), F.pmod(F.col("a"), F.lit(65536)), F.col("b")).alias("h"),
    ).collect()
    for r in got:
        assert r.h == (r.a * r.x + r.b) % PRIME


def test_joining_path_hash_g0(spark, g0):
    rows = jp.joining_path_hash(g0, hashnum=100, seed=1).collect()
    pairs = {(r.ac_name, r.bc_name): r for r in rows}
    # t/m share nothing; every reported pair is cross-table and has similarity > 0.
    assert ("t", "m") not in pairs
    assert all(r.at_ind == 0 and r.bt_ind == 1 and r.similarity > 0 for r in rows)
    assert abs(pairs[("k", "l")].similarity - 2 / 3) < 4 * math.sqrt(2 / 9 / 100) + 0.01
    # Ordered by similarity, descending.
    sims = [r.similarity for r in rows]
    assert sims == sorted(sims, reverse=True)
    assert [f for f in rows[0].asDict()] == ["at_ind", "ac_name", "bt_ind", "bc_name", "aj_contribution", "similarity"]


def test_containment_shares_add_to_one(spark, g0):
    rows = jp.joining_path_hash(g0, containing_check=True, seed=2).collect()
    assert rows
    for r in rows:
        assert abs(r.similarity + r.A_contain_B_sim + r.B_contain_A_sim - 1.0) < 1e-9


def test_superset_never_has_larger_minimum(spark):
    big = spark.createDataFrame([(str(i),) for i in range(200)], "a string")
    small = spark.createDataFrame([(str(i),) for i in range(0, 200, 7)], "b string")
    r = jp.joining_path_hash([big, small], containing_check=True, seed=3).first()
    # A contains B: min(A) <= min(B) on every hash, so B_contain_A_sim is 0.
    assert r.B_contain_A_sim == 0.0
    assert r.A_contain_B_sim > 0.5


def test_aj_size_g0_exact_case(spark, g0):
    """With a hash family where the sample is exact the estimate equals the true join size."""
    rows = jp.multi_set_resemble(g0, threshold=0, seed=1).collect()
    by = {(r.ac_name, r.bc_name): r for r in rows}
    r = by[("k", "l")]
    expected = r.similarity / (1 + r.similarity) * r.aj_contribution * (3 + 2)
    assert r.aj_size == pytest.approx(expected)
    assert set(rows[0].asDict()) >= {"aj_size"}


def test_specific_keeps_true_table_index(spark, g0):
    rows = jp.joining_path_hash_specific(g0, 1, "l", seed=1).collect()
    assert rows and all(r.at_ind == 1 and r.ac_name == "l" and r.bt_ind == 0 for r in rows)
    # single-table set: empty, with the schema
    empty = jp.multi_set_resemble_specific([g0[0]], 0, "k")
    assert empty.count() == 0 and "aj_size" in empty.columns


def test_specific_rejects_non_string(spark, g0):
    with pytest.raises(ValueError):
        jp.joining_path_hash_specific(g0, 0, "v")


def test_naive_g0(spark, g0):
    rows = jp.joining_path_naive(g0).collect()
    got = {(r.ac_name, r.bc_name): r.similarity for r in rows}
    assert got == pytest.approx({("k", "l"): 2 / 3, ("t", "l"): 1 / 4, ("k", "m"): 1 / 5})
    assert [r.similarity for r in rows] == sorted(got.values(), reverse=True)


def test_naive_rounding_and_threshold(spark, g0):
    rows = jp.joining_path_naive(g0, threshold=0.2, round_digits=2).collect()
    assert {(r.ac_name, r.bc_name): r.similarity for r in rows} == {("k", "l"): 0.67, ("t", "l"): 0.25}


def test_naive_null_handling(spark):
    a = spark.createDataFrame([("x",), (None,)], "a string")
    b = spark.createDataFrame([("y",), (None,)], "b string")
    assert jp.joining_path_naive([a, b]).count() == 0
    r = jp.joining_path_naive([a, b], null_as_value=True).first()
    assert r.similarity == pytest.approx(1 / 3)


def test_jaccard_two_columns(spark, g0):
    assert jp.get_jaccard_similarity(g0, 0, 1, "k", "l", option="naive") == pytest.approx(2 / 3)
    assert jp.get_jaccard_similarity(g0, 0, 1, "k", "l", option="naive", round_digits=2) == 0.67
    assert jp.get_jaccard_similarity(g0, 0, 1, "t", "m", option="min_hash") == 0.0
    assert jp.get_jaccard_similarity(g0, 0, 0, "k", "k", option="min_hash") == 1.0
    e = g0[0].where("false")
    assert jp.get_jaccard_similarity([e, e], 0, 1, "k", "k", option="naive") is None
    with pytest.raises(ValueError):
        jp.get_jaccard_similarity(g0, 0, 1, "k", "l", option="other")


def test_no_categorical_is_a_clear_error(spark):
    t = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="categorical"):
        jp.joining_path_hash([t, t])


def test_all_null_column_has_no_signature(spark):
    a = spark.createDataFrame([(None,), (None,)], "a string")
    b = spark.createDataFrame([(None,)], "b string")
    assert jp.joining_path_hash([a, b]).count() == 0


def test_collision_check(spark, g0):
    rows = jp.hash_collision_check(g0, hashnum=4).collect()
    assert len(rows) == 4 * 4
    assert all(r.collisions == 0 and r.n_values == r.n_hashes for r in rows)
    assert {(r.col_name, r.n_values) for r in rows} == {("k", 3), ("t", 3), ("l", 2), ("m", 3)}


def test_naive_more_than_64_columns(spark):
    """Column sets span several 64-bit mask words."""
    n = 70
    a = spark.createDataFrame([tuple(str(j) for j in range(n))], ",".join(f"a{j} string" for j in range(n)))
    b = spark.createDataFrame([("69",), ("0",), ("5",)], "b string")
    rows = jp.joining_path_naive([a, b]).collect()
    got = {(r.ac_name, r.bc_name): r.similarity for r in rows}
    # a_j holds the single value str(j); b holds {69, 0, 5}.
    assert got == pytest.approx({("a69", "b"): 1 / 3, ("a0", "b"): 1 / 3, ("a5", "b"): 1 / 3})


def test_same_dataframe_twice(spark, g0):
    """A table listed twice (self-union in the long form) matches itself exactly."""
    t = g0[0]
    rows = jp.multi_set_resemble([t, t], threshold=0, seed=4).collect()
    same = {(r.ac_name, r.bc_name): r for r in rows if r.ac_name == r.bc_name}
    assert set(same) == {("k", "k"), ("t", "t")}
    assert all(r.similarity == 1.0 for r in same.values())
    # k = {foo x2, max, lst}: 3 distinct values; 1/2 * mean(mult^2) * 6 is the self-join size 4+1+1=6
    assert same[("k", "k")].aj_size == pytest.approx(0.5 * same[("k", "k")].aj_contribution * 6)
    naive = {(r.ac_name, r.bc_name): r.similarity for r in jp.joining_path_naive([t, t]).collect()}
    assert naive[("k", "k")] == 1.0 and naive[("t", "t")] == 1.0


def test_jaccard_of_two_empty_columns_is_null(spark):
    from tablescout.operators import joinpaths

    empty = spark.createDataFrame([(None,), (None,)], "k string")
    full = spark.createDataFrame([("a",)], "k string")
    for option in ("min_hash", "naive"):
        assert joinpaths.get_jaccard_similarity([empty, empty], 0, 1, "k", "k", option=option) is None
        assert joinpaths.get_jaccard_similarity([empty, full], 0, 1, "k", "k", option=option) == 0.0
