"""Pairs above a threshold against all pairs, and the work that is done for them."""

import random

import pytest

from tablescout.functions.hashing import hash_coefficients
from tablescout.operators import joinpaths as jp
from tablescout.operators import signature, similarity


def sets_of(seed, columns=14, values=60):
    """Column sets that overlap by anything from nothing to all, some equal, one empty."""
    rng = random.Random(seed)
    base = [f"v{i}" for i in range(values)]
    out = []
    for k in range(columns):
        if k % 5 == 4:
            out.append(list(out[-1]))
        elif k == 7:
            out.append([])
        else:
            low = rng.randrange(values // 2)
            out.append(rng.sample(base[low:low + 30], rng.randint(1, 28)) + [f"own{k}-{j}" for j in range(rng.randint(0, 4))])
    return out


def tables_of(spark, sets, tables=2):
    """The sets dealt out as columns of tables, short ones filled with NULLs and repeats."""
    frames = []
    for t in range(tables):
        mine = [(k, s) for k, s in enumerate(sets) if k % tables == t]
        height = max(len(s) for _, s in mine) + 3
        rows = [[(s[i] if i < len(s) else (s[0] if s and i % 2 else None)) for _, s in mine] for i in range(height)]
        frames.append(spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`c.{k}` string" for k, _ in mine)))
    return frames


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("threshold", [0.01, 0.3, 0.5, 0.9, 0.999, 1.0, 3])
def test_exact_pairs_against_all_pairs(spark, threshold):
    sets = sets_of(1)
    tables = tables_of(spark, sets)
    want = []
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            union = set(x) | set(y)
            if a % 2 < b % 2 and union and len(set(x) & set(y)) / len(union) > threshold:
                want.append((0, f"c.{a}", 1, f"c.{b}", len(set(x) & set(y)) / len(union)))
    assert rows(jp.joining_path_naive(tables, threshold=threshold)) == sorted(want)


def test_similarities_that_equal_the_threshold_are_not_above_it(spark):
    t = [spark.createDataFrame([(v,) for v in vs], "x string") for vs in ("abcd", "cdef", "abce")]
    assert [(r.at_ind, r.bt_ind, r.similarity) for r in jp.joining_path_naive(t, threshold=0.6).collect()] == []
    found = jp.joining_path_naive(t, threshold=0.33).collect()
    assert sorted((r.at_ind, r.bt_ind, round(r.similarity, 3)) for r in found) == [(0, 1, 0.333), (0, 2, 0.6), (1, 2, 0.333)]
    assert jp.joining_path_naive(t, threshold=1 / 3).count() == 1
    assert jp.joining_path_naive(t, threshold=0.33, round_digits=2).count() == 1
    assert jp.joining_path_naive(t, threshold=0.595, round_digits=2).count() == 1  # 0.6


@pytest.mark.parametrize("null_as_value", [False, True])
def test_nulls_empty_and_single_tables(spark, null_as_value):
    a = spark.createDataFrame([(None, "x"), (None, "y")], "n string, s string")
    b = spark.createDataFrame([(None,)], "n string")
    empty = spark.createDataFrame([], "e string")
    found = [(r.ac_name, r.bc_name, r.similarity) for r in jp.joining_path_naive([a, b, empty], threshold=0.5, null_as_value=null_as_value).collect()]
    assert found == ([("n", "n", 1.0)] if null_as_value else [])
    assert jp.joining_path_naive([a], threshold=0.5).count() == 0
    assert jp.joining_path_hash([a, empty], threshold=0.5).count() == 0


@pytest.mark.parametrize("threshold", [0.02, 0.3, 0.5, 0.8, 0.99, 1, 2])
@pytest.mark.parametrize("wide", [False, True])
def test_signature_pairs_against_all_pairs(spark, threshold, wide):
    tables = tables_of(spark, sets_of(2), 3)
    coeffs = hash_coefficients(40, 3, wide)
    sig = jp.table_set_signature(tables, coeffs=coeffs)
    for check in (False, True):
        every = jp.match_pairs(sig, sig, 40, threshold, True, check)
        some = similarity.pairs_above(sig, 40, threshold, check)
        assert some.columns == every.columns and rows(some) == rows(every)


@pytest.mark.parametrize("hashnum", [1, 2, 7, 100])
def test_bands_leave_no_pair_out(hashnum):
    for threshold in (0.01, 0.2, 0.5, 0.77, 0.99, 1):
        bands, met = similarity.bands_of(hashnum, threshold)
        least = similarity.least_agreement(hashnum, threshold)
        count = bands[-1] + 1
        assert len(bands) == hashnum and bands == sorted(bands) and set(bands) == set(range(count))
        if least <= hashnum:
            differences = hashnum - least
            assert count > differences and met >= differences + 1  # all but these agree, one of them among those met


def test_two_tables_of_a_thousand_columns(spark):
    """Each column has 8 values of its own, one that all share and, in pairs, 11 of a twin: only twins are met."""
    n = 1000
    sides = []
    for side in "ab":
        names = ", ".join(f"{side}{k} string" for k in range(n))
        data = [tuple(f"{k}-{i}" if i < 11 else "everywhere" if i == 11 else f"{side}{k}-{i}" for k in range(n)) for i in range(20)]
        sides.append(spark.createDataFrame(data, names))
    long = signature.string_long_form(sides)
    counted = signature.materialize(similarity.counted_sets(similarity.column_postings(jp._value_keys(long, False))))
    prefix, _ = similarity.prefixes(counted, 0.4)
    # 20 - 8 + 1 values each, 8 of them of no other column; the one that all share is not among them.
    assert prefix.count() <= 2 * n * 11 and prefix.where("size(cols) > 2").count() == 0
    found = jp.joining_path_naive(sides, threshold=0.4).collect()
    assert len(found) == n and all(r.ac_name[1:] == r.bc_name[1:] and r.similarity == 12 / 28 for r in found)
    sig = signature.materialize(signature.signature(long, hash_coefficients(50, 1)))
    columns = similarity.column_signatures(sig)
    # In one of 20 places a column's minimum is that of the value that all share: it is met by none.
    assert similarity.candidate_classes(columns.select("id", "minima"), 50, 0.4).count() < 2 * n  # of 1,999,000 pairs
