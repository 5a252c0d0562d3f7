"""Kept column sketches: parts add up to the whole, a repeated part counts once."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tablescout.operators import sketches
from tablescout.session import checkpoint_dir

COLUMNS = ["table_name", "column", "n_rows", "n_nulls", "n_distinct", "error"]


def by_column(df):
    return {r.column: r for r in df.collect()}


def test_parts_add_up(spark, tmp_path):
    whole = spark.range(60_000).select(
        "id", (F.col("id") % 700).alias("few"), F.concat(F.lit("k"), F.col("id") % 9000).alias("text.x"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 7).alias("part_null"),
    ).repartition(7)
    store = str(tmp_path / "store")
    for k in range(3):
        sketches.add_part(store, whole.where((F.col("id") / 20_000).cast("int") == k), "t", f"p{k}")
    sketches.add_part(store, whole.where("id < 20000"), "t", "p0")  # again: replaced, not added
    kept = sketches.read_store(spark, store, ["t"])
    assert kept.count() == 12
    merged, once = by_column(sketches.distinct_estimates(kept)), by_column(sketches.distinct_estimates(sketches.column_sketches(whole, "t")))
    exact = {"id": 60_000, "few": 700, "text.x": 9000, "part_null": 20_000}
    assert set(merged) == set(once) == set(exact)
    for name, n in exact.items():
        assert abs(merged[name].n_distinct - n) <= merged[name].error and abs(once[name].n_distinct - n) <= once[name].error
        assert abs(merged[name].n_distinct - once[name].n_distinct) <= 0.01 * n
        assert (merged[name].n_rows, merged[name].n_nulls) == (60_000, 40_000 if name == "part_null" else 0)
    added = by_column(sketches.new_values(kept, "p2"))
    assert added["few"].added == 0 and abs(added["id"].added - 20_000) <= 3_000
    assert added["id"].without < added["id"].n_distinct


def test_types_nulls_and_empty(spark):
    day, at = datetime.date(2020, 1, 1), datetime.datetime(2020, 1, 1, 3)
    df = spark.createDataFrame(
        [(1, 0.0, True, day, at, decimal.Decimal("1.50"), b"\x00\xff", "", None, [1]), (1, -0.0, False, day, at, decimal.Decimal("2"), b"\x00", "a", None, [2]),
         (None, float("nan"), None, None, None, None, None, None, None, None)],
        "i tinyint, d double, b boolean, day date, at timestamp, dec decimal(9,2), raw binary, s string, void string, nested array<int>",
    )
    found = by_column(sketches.distinct_estimates(sketches.column_sketches(df, "t")))
    assert {k: r.n_distinct for k, r in found.items()} == {"i": 1, "d": 2, "b": 2, "day": 1, "at": 1, "dec": 2, "raw": 2, "s": 2, "void": 0}
    assert {k: r.n_nulls for k, r in found.items() if r.n_nulls != 1} == {"d": 0, "void": 3}
    none = sketches.distinct_estimates(sketches.column_sketches(df.where("false"), "t", columns=["i", "s"]))
    assert none.columns == COLUMNS
    assert sorted((r.column, r.n_rows, r.n_distinct) for r in none.collect()) == [("i", 0, 0), ("s", 0, 0)]
    with pytest.raises(TypeError):
        sketches.column_sketches(df, "t", columns=["nested"])
    with pytest.raises(ValueError):
        sketches.add_part(checkpoint_dir(spark), df, "t", "../x")


def test_sketches_of_different_sizes_merge(spark):
    a = sketches.column_sketches(spark.range(5000).toDF("x"), "t", "a", lg_k=10)
    b = sketches.column_sketches(spark.range(2500, 9000).toDF("x"), "t", "b", lg_k=14)
    r = sketches.distinct_estimates(a.unionByName(b)).first()
    assert r.n_rows == 11_500 and abs(r.n_distinct - 9000) <= r.error <= 0.11 * r.n_distinct


def test_one_scan_whatever_the_columns(spark):
    df = spark.range(1000).select(*[(F.col("id") % (k + 1)).alias(f"c{k}") for k in range(60)])
    plan = sketches.column_sketches(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Expand" not in plan
