"""Property tests on random small columns."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablescout.operators import histogram, joinpaths

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.integers(min_value=0, max_value=60).map(str), min_size=1, max_size=120)


@SETTINGS
@given(a=values, b=values, seed=st.integers(0, 1000))
def test_minhash_close_to_exact_and_shares_add_up(spark, a, b, seed):
    ta = spark.createDataFrame([(v,) for v in a], "a string")
    tb = spark.createDataFrame([(v,) for v in b], "b string")
    sa, sb = set(a), set(b)
    exact = len(sa & sb) / len(sa | sb)
    est = joinpaths.get_jaccard_similarity([ta, tb], 0, 1, "a", "b", hashnum=200, seed=seed)
    assert abs(est - exact) <= 4 * math.sqrt(exact * (1 - exact) / 200) + 1e-9
    naive = joinpaths.get_jaccard_similarity([ta, tb], 0, 1, "a", "b", option="naive")
    assert naive == exact
    rows = joinpaths.joining_path_hash([ta, tb], containing_check=True, hashnum=50, seed=seed).collect()
    for r in rows:
        assert abs(r.similarity + r.A_contain_B_sim + r.B_contain_A_sim - 1) < 1e-9
        if sb <= sa:
            assert r.B_contain_A_sim == 0.0


@SETTINGS
@given(
    xs=st.lists(
        st.one_of(st.none(), st.just(float("nan")), st.floats(min_value=-1e6, max_value=1e6)), min_size=1, max_size=80
    ),
    bins=st.integers(1, 12),
)
def test_histogram_counts_sum_to_valid_rows(spark, xs, bins):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    valid = [x for x in xs if x is not None and not math.isnan(x)]
    if not valid:
        return
    rows = histogram.histogram(df, "x", bins).collect()
    assert sum(r["count"] for r in rows) == len(valid)
    expect = spark.sparkContext.parallelize(valid).histogram(bins)
    assert [r["count"] for r in rows] == expect[1]


cells = st.one_of(st.none(), st.integers(min_value=0, max_value=12).map(str))


@SETTINGS
@given(
    widths=st.lists(st.integers(1, 4), min_size=2, max_size=3),
    rows=st.integers(1, 25),
    data=st.data(),
)
def test_exact_paths_match_brute_force(spark, widths, rows, data):
    tables, cols = [], []
    for t, w in enumerate(widths):
        values = [tuple(data.draw(cells) for _ in range(w)) for _ in range(rows)]
        names = [f"t{t}c{j}" for j in range(w)]
        tables.append(spark.createDataFrame(values, ", ".join(f"{n} string" for n in names)))
        cols.append((names, values))
    expect = {}
    for ta in range(len(cols)):
        for tb in range(ta + 1, len(cols)):
            for ja, na in enumerate(cols[ta][0]):
                for jb, nb in enumerate(cols[tb][0]):
                    sa = {r[ja] for r in cols[ta][1] if r[ja] is not None}
                    sb = {r[jb] for r in cols[tb][1] if r[jb] is not None}
                    if sa & sb:
                        expect[(ta, na, tb, nb)] = len(sa & sb) / len(sa | sb)
    got = {(r.at_ind, r.ac_name, r.bt_ind, r.bc_name): r.similarity for r in joinpaths.joining_path_naive(tables).collect()}
    assert got.keys() == expect.keys()
    for k, v in expect.items():
        assert got[k] == v


@SETTINGS
@given(data=st.data(), width=st.integers(1, 3), rows=st.integers(0, 30))
def test_cat_describe_and_mode_match_brute_force(spark, data, width, rows):
    from collections import Counter

    from tablescout.operators import aggregates, profile

    small = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "dd"]))
    values = [tuple(data.draw(small) for _ in range(width)) for _ in range(rows)]
    names = [f"c{j}" for j in range(width)]
    df = spark.createDataFrame(values, ", ".join(f"{n} string" for n in names))
    got = {r.column: tuple(r)[1:] for r in profile.cat_describe(df).collect()}
    modes = aggregates.aggregate(df, "mode", names).first()
    for j, n in enumerate(names):
        counts = Counter(v[j] for v in values)
        if counts:
            top = max(counts.values())
            tied = [v for v, c in counts.items() if c == top]
            non_null = [v for v in tied if v is not None]
            mode = max(non_null) if non_null else None
            expect = (rows, len(counts), mode, top)
        else:
            expect = (0, 0, None, 0)
        assert got[n] == expect
        present = Counter(v[j] for v in values if v[j] is not None)
        if present:
            best = max(present.values())
            assert modes[f"mode({n})"] == min(v for v, c in present.items() if c == best)
        else:
            assert modes[f"mode({n})"] is None
