"""Any one-argument aggregate over chosen columns: ``table.agg({col: func})``.

The function name is checked against an allow-list and the column types
are checked before Spark sees them, so a bad pairing fails with the
column named instead of an analysis error deep in a plan.

Left out on purpose: aggregates whose buffer holds every value of the
column (``collect_list``, ``collect_set``, ``array_agg``, ``listagg``),
since a global aggregate would gather the whole column into one task.
``median`` is found by distributed rank selection, and ``mode`` by a
distributed value count followed by a max, not with Spark's per-group maps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.longform import one_row, present, typed_long_form
from tablescout.functions.schema import INTEGRAL_TYPES, field_type, is_numeric
from tablescout.operators import ranks

ANY_TYPE = {
    "count", "min", "max", "first", "last", "first_value", "last_value", "any_value",
    "approx_count_distinct",
}
NUMERIC = {
    "avg", "mean", "sum", "try_sum", "try_avg",
    "stddev", "std", "stddev_samp", "stddev_pop",
    "variance", "var_samp", "var_pop", "skewness", "kurtosis",
}
INTEGRAL = {"bit_and", "bit_or", "bit_xor"}
BOOLEAN = {"count_if", "bool_and", "every", "bool_or", "some", "any"}
AGGREGATES = ANY_TYPE | NUMERIC | INTEGRAL | BOOLEAN | {"mode", "median"}


def _check(table: DataFrame, func: str, name: str) -> None:
    dt = field_type(table, name)
    if func in NUMERIC and not is_numeric(dt):
        raise TypeError(f"{func} needs a numeric column; {name!r} is {dt.simpleString()}")
    if func in INTEGRAL and not isinstance(dt, INTEGRAL_TYPES):
        raise TypeError(f"{func} needs an integral column; {name!r} is {dt.simpleString()}")
    if func in BOOLEAN and not isinstance(dt, T.BooleanType):
        raise TypeError(f"{func} needs a boolean column; {name!r} is {dt.simpleString()}")


def aggregate(table: DataFrame, func: str, col_names: Sequence[str] | str | None = None) -> DataFrame:
    """One row; column ``func(col)`` per input column, as Spark names it."""
    if func not in AGGREGATES:
        raise ValueError(f"unknown aggregate {func!r}; supported: {sorted(AGGREGATES)}")
    names = list(table.columns) if col_names is None else ([col_names] if isinstance(col_names, str) else list(col_names))
    for n in names:
        _check(table, func, n)
    if func == "mode":
        return mode(table, names)
    if func == "median":
        return ranks.median(table, names)
    # Quoted keys resolve names with dots; Spark still names the output ``func(name)``.
    return table.agg({"`" + n.replace("`", "``") + "`": func for n in names})


def mode(table: DataFrame, col_names: Sequence[str]) -> DataFrame:
    """One row, column ``mode(col)``: most frequent non-NULL value, ties to the lowest.

    All columns share one plan: a long form with one field per data type, one
    map-side-combined value count, the top count per column, and the lowest
    value among the tied rows. No task holds a whole column, and a row costs
    as much per column for 300 columns as for three.
    """
    names = list(col_names)
    if not names:
        raise ValueError("mode needs at least one column")
    long, fields, lane_of = typed_long_form(table, names)
    counts = long.where(present(fields)).groupBy("k", *fields).agg(F.count(F.lit(1)).alias("n"))
    # Highest count per column (fixed-width HashAggregate), then only the tied rows
    # (a broadcast of one row per column) feed the lowest-value pick.
    top = counts.groupBy("k").agg(F.max("n").alias("n"))
    ties = counts.join(F.broadcast(top), ["k", "n"])
    least = ties.groupBy("k").agg(*[F.min(f).alias(f) for f in fields])  # one row per column
    return one_row(least, [f"mode({n})" for n in names], lambda k: F.first(F.when(F.col("k") == k, F.col(fields[lane_of[k]])), ignorenulls=True))
