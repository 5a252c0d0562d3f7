"""Join discovery beyond MinHash: containment of small columns, and join sizes with an error bound.

Both start from one row per column and distinct value, a 64-bit hash with its
row count (text never shuffles), written once to the checkpoint folder.

*Containment.* A column's values of least hash, ``k`` of them, are an unbiased
sample of its distinct values; a column of up to ``k`` values is its own
sample. The share of the sample that another column holds estimates the share
of the column that it contains, whatever the sizes of the two: this finds 25
keys among a million, which a similarity cannot show. With m sampled values
the estimate is off by more than ``sqrt(ln(2 / (1 - confidence)) / 2m)`` with
the remaining probability at most (Hoeffding); with all values, by nothing.

*Join size.* A count sketch of a column adds each value's row count, with a
random sign, to one of ``width`` cells in each of ``depth`` rows. The product of
two columns' cells, added up over a row, estimates the size of their join
without bias, with a variance of ``2 * F2 * F2' / width`` at most, F2 being the
sum of squared row counts; the median over the rows misses
``sqrt(8 * F2 * F2' / width)`` with a probability that falls exponentially in
the depth (each row does with 1/4 at most).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescout.operators.signature import LongForm, materialize, string_long_form

SAMPLE = 1024
CONFIDENCE = 0.99
WIDTH, DEPTH = 1024, 9
PAIR = ["at_ind", "ac_name", "bt_ind", "bc_name"]


def value_table(tables: Sequence[DataFrame], table_ind: Sequence[int] | None = None) -> tuple[DataFrame, LongForm]:
    """``col_id, h, cnt``: the distinct values of all string columns and their row counts, materialised."""
    long = string_long_form(tables, table_ind)
    if long is None:
        raise ValueError("no table has a categorical column, that is one of strings")
    keyed = long.df.where(F.col("value").isNotNull()).select("col_id", F.xxhash64("value").alias("h"))
    return materialize(keyed.groupBy("col_id", "h").agg(F.count(F.lit(1)).alias("cnt"))), long


def least_hashes(values: DataFrame, k: int, shares: int = 64) -> DataFrame:
    """``col_id, h`` of each column's ``k`` least hashes: first within shares of the hashes, then over them."""
    order = F.xxhash64("h", F.lit(7))  # not the hash by which rows are dealt out
    for keys in (["col_id", "share"], ["col_id"]):
        values = values.withColumn("share", F.pmod("h", F.lit(shares))).withColumn("place", order)
        values = values.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("place", "h"))).where(F.col("nth") <= k).select("col_id", "h")
    return values


def _tables_of(long: LongForm, col_id: str) -> Column:
    return long.named(F.col(col_id))[0]


def _named(pairs: DataFrame, long: LongForm, *columns: str) -> DataFrame:
    a, b = long.named(F.col("a")), long.named(F.col("b"))
    return pairs.select(a[0].alias("at_ind"), a[1].alias("ac_name"), b[0].alias("bt_ind"), b[1].alias("bc_name"), *columns)


def containment_of(sample: DataFrame, values: DataFrame, long: LongForm) -> DataFrame:
    """``a, b, shared``: how many sampled values of column a column b of another table holds, where it holds any."""
    a = sample.select(F.col("col_id").alias("a"), "h")
    b = values.select(F.col("col_id").alias("b"), "h")
    both = a.join(b, "h").where(_tables_of(long, "a") != _tables_of(long, "b"))
    return both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def containment_paths(
    tables: Sequence[DataFrame], threshold: float = 0.5, table_ind: Sequence[int] | None = None, sample: int = SAMPLE, confidence: float = CONFIDENCE
) -> DataFrame:
    """Pairs ``(A, B)`` of string columns of different tables where B holds at least ``threshold`` of A's distinct values.

    Columns: ``at_ind, ac_name, bt_ind, bc_name, containment, sampled,
    error``, highest containment first. ``sampled`` is how many of A's values
    were looked up, ``error`` the bound of the estimate at ``confidence``, 0
    if A was looked up whole. NULL is no value. Runs the value count.
    """
    values, long = value_table(tables, table_ind)
    kept = materialize(least_hashes(values, sample))  # columns x sample rows
    sizes = values.groupBy(F.col("col_id").alias("a")).agg(F.count(F.lit(1)).alias("distinct"))
    m = F.least(F.col("distinct"), F.lit(sample))
    scored = containment_of(kept, values, long).join(sizes, "a").select(
        "a", "b", (F.col("shared") / m).alias("containment"), m.cast("bigint").alias("sampled"),
        F.when(F.col("distinct") <= sample, 0.0).otherwise(F.sqrt(F.lit(math.log(2 / (1 - confidence)) / 2) / m)).alias("error"),
    )
    found = _named(scored.where(F.col("containment") >= threshold), long, "containment", "sampled", "error")
    return found.orderBy(F.desc("containment"), *PAIR)


def containment_errors(tables: Sequence[DataFrame], sample: int = SAMPLE, confidence: float = CONFIDENCE) -> DataFrame:
    """``at_ind, ac_name, bt_ind, bc_name, exact, within``: every pair that shares a value, its exact containment, and whether the estimate is within its error."""
    values, long = value_table(tables)
    exact = containment_of(values, values, long).withColumnRenamed("shared", "all_shared")
    kept = least_hashes(values, sample)
    sizes = values.groupBy(F.col("col_id").alias("a")).agg(F.count(F.lit(1)).alias("distinct"))
    both = exact.join(containment_of(kept, values, long), ["a", "b"], "left").join(sizes, "a")
    m = F.least(F.col("distinct"), F.lit(sample))
    error = F.when(F.col("distinct") <= sample, 0.0).otherwise(F.sqrt(F.lit(math.log(2 / (1 - confidence)) / 2) / m))
    true = F.col("all_shared") / F.col("distinct")
    off = F.abs(true - F.coalesce("shared", F.lit(0)) / m)
    return _named(both.select("a", "b", true.alias("exact"), (off <= error).alias("within")), long, "exact", "within")


# ------------------------------------------------------------------ join sizes


def count_sketches(values: DataFrame, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``col_id, r, cell, weight``: columns x depth x width rows at most; sketches of parts of a table add up."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(depth - 1)), lambda r: F.struct(r.alias("r"), F.xxhash64("h", r).alias("x")))
    spread = values.select("col_id", "cnt", F.inline(rows))
    sign = F.when(F.col("x") < 0, -1.0).otherwise(1.0)
    cell = F.pmod(F.shiftright("x", 8), F.lit(width)).cast("int")
    return spread.groupBy("col_id", "r", cell.alias("cell")).agg(F.sum(sign * F.col("cnt")).alias("weight"))


def join_sizes(tables: Sequence[DataFrame], table_ind: Sequence[int] | None = None, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``at_ind, ac_name, bt_ind, bc_name, size, error`` for all pairs of string columns of different tables.

    ``size`` estimates the rows of the inner join on the pair, ``error`` is
    its bound (see the module). Beyond the value count everything is of the
    size of the sketches: pairs x depth x width products.
    """
    values, long = value_table(tables, table_ind)
    return _named(_estimates(values, long, width, depth), long, "size", "error").orderBy(F.desc("size"), *PAIR)


def _estimates(values: DataFrame, long: LongForm, width: int, depth: int) -> DataFrame:
    sketch = materialize(count_sketches(values, width, depth))
    side = lambda name: sketch.select(F.col("col_id").alias(name), "r", "cell", F.col("weight").alias(f"w{name}"))
    products = side("a").join(side("b"), ["r", "cell"]).where(_tables_of(long, "a") < _tables_of(long, "b"))
    rows = products.groupBy("a", "b", "r").agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    # A row without a common cell estimates 0; the depth is small and fixed.
    dots = rows.groupBy("a", "b").agg(F.array_sort(F.collect_list("dot")).alias("dots"))
    filled = F.array_sort(F.concat("dots", F.array_repeat(F.lit(0.0), F.lit(depth) - F.size("dots"))))
    squares = values.groupBy("col_id").agg(F.sum(F.col("cnt").cast("double") * F.col("cnt")).alias("f2"))
    f2 = lambda name: squares.select(F.col("col_id").alias(name), F.col("f2").alias(f"f{name}"))
    error = F.sqrt(F.lit(8.0 / width) * F.col("fa") * F.col("fb"))
    size = F.greatest(F.lit(0.0), F.get(filled, F.lit(depth // 2)))
    return dots.join(f2("a"), "a").join(f2("b"), "b").select("a", "b", size.alias("size"), error.alias("error"))


def join_size_errors(tables: Sequence[DataFrame], width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``at_ind, ac_name, bt_ind, bc_name, exact, within``: exact join sizes of the pairs that share a value, and whether the estimate is within its error."""
    values, long = value_table(tables)
    side = lambda name: values.select(F.col("col_id").alias(name), "h", F.col("cnt").alias(f"c{name}"))
    shared = side("a").join(side("b"), "h").where(_tables_of(long, "a") < _tables_of(long, "b"))
    exact = shared.groupBy("a", "b").agg(F.sum(F.col("ca") * F.col("cb")).alias("exact"))
    both = exact.join(_estimates(values, long, width, depth), ["a", "b"])
    return _named(both.select("a", "b", "exact", (F.abs(F.col("size") - F.col("exact")) <= F.col("error")).alias("within")), long, "exact", "within")
