import math

import pytest

from tablescout.operators import aggregates, histogram, profile
from tablescout.plans import registry


def test_cat_describe_g0(spark, g0):
    rows = profile.cat_describe(g0[0], None).collect()
    assert [tuple(r) for r in rows] == [("k", 4, 3, "foo", 2), ("t", 4, 3, "lst", 2)]


def test_cat_describe_ties_nulls_and_types(spark):
    df = spark.createDataFrame(
        [("a", None, True, bytearray(b"\x01")), ("a", None, True, bytearray(b"\x01")),
         ("b", "x", False, bytearray(b"\xff")), ("b", "y", None, None)],
        "s string, n string, f boolean, bin binary",
    )
    rows = {r.column: r for r in profile.cat_describe(df, ["bin", "s", "n", "f"]).collect()}
    assert rows["s"].mode == "b" and rows["s"].mode_count == 2  # tie -> largest
    assert rows["n"].mode is None and rows["n"].mode_count == 2 and rows["n"].uniques == 3  # NULL most frequent
    assert rows["f"].mode == "true" and rows["f"].uniques == 3
    assert rows["bin"].mode == "01"
    # table order, not request order
    assert [r.column for r in profile.cat_describe(df, ["bin", "s"]).collect()] == ["s", "bin"]


def test_cat_describe_empty_and_none(spark):
    empty = spark.createDataFrame([], "s string")
    assert [tuple(r) for r in profile.cat_describe(empty, None).collect()] == [("s", 0, 0, None, 0)]
    nums = spark.createDataFrame([(1,)], "x int")
    with pytest.warns(UserWarning):
        assert profile.cat_describe(nums, None) is None


def test_value_count(spark, g0):
    (vc,) = profile.value_count(g0[0], ["t"])
    assert {tuple(r) for r in vc.collect()} == {("lst", 2), ("dt", 1), ("show", 1)}
    with pytest.warns(UserWarning):
        assert len(profile.value_count(g0[0], ["t", "nope"])) == 1
    long = profile.value_count_long(g0[0], ["k", "v"]).collect()
    assert ("v", "1", 2) in {tuple(r) for r in long}


def test_describe_long(spark, g0):
    (r,) = profile.describe_long(g0[0]).collect()
    assert r.column == "v" and r["count"] == 4 and r["mean"] == pytest.approx(1.75)
    assert r.stddev == pytest.approx(math.sqrt(11 / 12)) and r["min"] == 1 and r["max"] == 3
    assert profile.describe_table(g0[0]).count() == 5
    mixed = spark.sql("select 1 as a, 'x' as s, current_timestamp() as ts, true as b")
    assert profile.describe_table(mixed).columns == mixed.describe().columns == ["summary", "a", "s"]


def test_counts(spark):
    df = spark.createDataFrame(
        [(1.0, "a", 1), (float("nan"), None, None), (None, "b", 2), (float("inf"), "b", 2)], "d double, s string, i int"
    )
    assert tuple(profile.nan_count(df, ["d", "s", "i"]).first()) == (1, 0, 0)
    assert tuple(profile.null_count(df, ["d", "s", "i"]).first()) == (1, 1, 1)
    assert tuple(profile.missing_count(df, ["d", "s", "i"]).first()) == (2, 1, 1)
    assert tuple(profile.distinct_count(df, ["d", "s", "i"]).first()) == (3, 2, 2)
    assert tuple(profile.distinct_count(df, ["s"], "approx").first()) == (2,)
    with pytest.raises(ValueError):
        profile.distinct_count(df, ["s"], "other")
    with pytest.raises(ValueError):
        profile.null_count(df, ["missing"])


def hist(df, col, bins):
    return [tuple(r) for r in histogram.histogram(df, col, bins).collect()]


def test_histogram_g0(spark, g0):
    assert hist(g0[0], "v", 2) == [(1.0, 2.0, 2), (2.0, 3.0, 2)]
    assert hist(g0[0], ["v"], [0, 2, 3]) == [(0.0, 2.0, 2), (2.0, 3.0, 2)]


def test_histogram_matches_rdd_rules(spark):
    import random

    rng = random.Random(0)
    vals = [rng.uniform(-5, 17) for _ in range(500)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    expect = spark.sparkContext.parallelize([v for v in vals if v is not None and not math.isnan(v)]).histogram(7)
    got = hist(df, "x", 7)
    assert [g[2] for g in got] == expect[1]
    assert [g[0] for g in got] + [got[-1][1]] == pytest.approx(expect[0])
    edges = [-5, -1, 0, 3.5, 20]
    expect = spark.sparkContext.parallelize([v for v in vals if v is not None and not math.isnan(v)]).histogram(edges)
    assert [g[2] for g in hist(df, "x", edges)] == expect[1]


def test_histogram_edge_cases(spark):
    const = spark.createDataFrame([(4,), (4,), (None,)], "x int")
    assert hist(const, "x", 5) == [(4.0, 4.0, 2)]
    ints = spark.createDataFrame([(i,) for i in range(11)], "x int")
    assert hist(ints, "x", 5) == [(0.0, 2.0, 2), (2.0, 4.0, 2), (4.0, 6.0, 2), (6.0, 8.0, 2), (8.0, 10.0, 3)]
    with pytest.raises(ValueError):
        hist(spark.createDataFrame([(None,)], "x double"), "x", 3)
    with pytest.raises(ValueError):
        hist(spark.createDataFrame([(1.0,), (float("inf"),)], "x double"), "x", 3)
    with pytest.raises(ValueError):
        hist(ints, "x", [3, 1])
    with pytest.raises(ValueError):
        hist(ints, ["x", "x"], 3)
    with pytest.raises(TypeError):
        hist(spark.createDataFrame([("a",)], "s string"), "s", 3)


def test_aggregates(spark):
    df = spark.createDataFrame([(1, 2.0, True, "a"), (3, 4.0, False, "b"), (3, None, True, "b")], "i int, d double, b boolean, s string")
    r = aggregates.aggregate(df, "avg", ["i", "d"]).first()
    assert r["avg(i)"] == pytest.approx(7 / 3) and r["avg(d)"] == pytest.approx(3.0)
    assert aggregates.aggregate(df, "bit_or", ["i"]).first()[0] == 3
    assert aggregates.aggregate(df, "bool_and", ["b"]).first()[0] is False
    assert tuple(aggregates.aggregate(df, "mode", ["i", "s", "d"]).first()) == (3, "b", 2.0)
    with pytest.raises(TypeError, match="'s'"):
        aggregates.aggregate(df, "avg", ["s"])
    with pytest.raises(ValueError):
        aggregates.aggregate(df, "collect_list", ["s"])


def test_registry_dispatch(spark, g0):
    out = registry.single_column_evaluate(g0, "histogram", [0, 1], [["v"], ["n"]], bins=2)
    assert len(out) == 2 and out[1].count() == 2
    out = registry.single_column_evaluate(g0, "max", [0], [["v"]])
    assert out[0].first()[0] == 3
    out = registry.single_column_evaluate(g0, "cube", [0], [["k", "t"]])
    assert out[0].where("k is null and t is null").first()["count"] == 4
    out = registry.single_column_evaluate(g0, "approxQuantile", [0], [["v"]], probabilities=[0.5], relativeError=0.0)
    assert out[0].first().value == 1.0
    out = registry.single_column_evaluate(g0, "histogram", [0], [["v"]], 2)
    assert [tuple(r) for r in out[0].collect()] == [(1.0, 2.0, 2), (2.0, 3.0, 2)]
    out = registry.single_column_evaluate(g0, "distinct_count", [0], [["k", "t"]], "approx")
    assert tuple(out[0].first()) == (3, 3)
    with pytest.raises(ValueError):
        registry.single_column_evaluate(g0, "nope", [0])
    with pytest.raises(ValueError):
        registry.single_column_evaluate(g0, "max", [0, 1], [["v"]])
    with pytest.raises(TypeError):
        registry.single_column_evaluate(g0, "max", 0)


def test_histogram_many_uneven_edges_and_many_bins(spark):
    import random

    rng = random.Random(3)
    vals = [rng.uniform(0, 1000) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    edges = sorted({round(rng.uniform(0, 1000), 3) for _ in range(300)})
    expect = spark.sparkContext.parallelize(vals).histogram(edges)
    assert [g[2] for g in hist(df, "x", edges)] == expect[1]
    expect = spark.sparkContext.parallelize(vals).histogram(500)
    got = hist(df, "x", 500)
    assert [g[2] for g in got] == expect[1]
    assert [g[0] for g in got] + [got[-1][1]] == expect[0]


def test_dotted_and_spaced_column_names(spark, tmp_path):
    from tablescout.operators import joinpaths, outliers
    from tablescout.sources import readers

    csv = tmp_path / "odd.csv"
    csv.write_text("summons.number,plate id,amount.usd\n1,AB,1.5\n2,CD,2.5\n2,CD,\n")
    t = readers.read_table(spark, str(csv), ["summons.number"])
    assert dict(t.dtypes)["summons.number"] == "string"
    assert tuple(profile.null_count(t, ["amount.usd", "plate id"]).first()) == (1, 0)
    assert tuple(profile.distinct_count(t, ["summons.number"]).first()) == (2,)
    rows = {r.column: tuple(r)[1:] for r in profile.cat_describe(t).collect()}
    assert rows["summons.number"] == (3, 2, "2", 2) and rows["plate id"] == (3, 2, "CD", 2)
    assert [r["count"] for r in histogram.histogram(t, "amount.usd", 2).collect()] == [1, 1]
    assert aggregates.aggregate(t, "mode", ["plate id"]).first()[0] == "CD"
    assert aggregates.aggregate(t, "max", ["amount.usd"]).columns == ["max(amount.usd)"]
    from tablescout.operators.passthrough import PASS_THROUGH

    assert PASS_THROUGH["select"](t, ["amount.usd"]).columns == ["amount.usd"]
    assert profile.describe_table(t, ["amount.usd"]).columns == ["summary", "amount.usd"]
    (vc,) = profile.value_count(t, ["summons.number"])
    assert vc.columns == ["summons.number", "count"] and vc.count() == 2
    assert PASS_THROUGH["cube"](t, ["plate id", "summons.number"]).count() == 7
    assert PASS_THROUGH["orderBy"](t, ["amount.usd"]).first()["amount.usd"] is None
    other = spark.createDataFrame([("2",), ("9",)], "`x.y` string")
    res = joinpaths.joining_path_naive([t, other]).collect()
    assert [(r.ac_name, r.bc_name, r.similarity) for r in res] == [("summons.number", "x.y", 1 / 3)]
    assert joinpaths.multi_set_resemble([t, other], seed=1).count() == 1
    far = outliers.outliers_given_centers(t, ["amount.usd"], [[0.0]], 2.0).collect()
    assert len(far) == 1


def test_histogram_of_whole_numbers_and_decimals_is_exact(spark):
    from decimal import Decimal
    from fractions import Fraction

    big = 2**53
    df = spark.createDataFrame([(big,), (big + 1,), (big + 1,), (big + 2,), (-big,), (None,)], "x bigint")
    assert [n for _, _, n in hist(df, "x", [big, big + 1, big + 2, 2**60])] == [1, 2, 1]
    near = df.where("x > 0")
    assert [n for _, _, n in hist(near, "x", 2)] == [1, 3]
    assert [n for _, _, n in hist(df, "x", [float("-inf"), 0, Fraction(2 * big + 1, 2), float("inf")])] == [1, 1, 3]
    wide = spark.createDataFrame([(Decimal("0.1"),), (Decimal("0.3"),), (Decimal("99999999999999999999.9"),), (None,)], "x decimal(38,1)")
    assert [n for _, _, n in hist(wide, "x", [Decimal("0.1"), Decimal("0.3"), Decimal("99999999999999999999.9")])] == [1, 2]
    small = spark.createDataFrame([(Decimal(i) / 100,) for i in range(-50, 51)], "x decimal(9,2)")
    assert [n for _, _, n in hist(small, "x", 10)] == [10] * 9 + [11]
    assert [n for _, _, n in hist(small, "x", [-1, Decimal("-0.005"), Decimal("0.005"), 1])] == [50, 1, 50]
    for edges in ([1], [1, 1], [1, float("nan")], [1, None], [1, "2"]):
        with pytest.raises(ValueError):
            hist(small, "x", edges)
