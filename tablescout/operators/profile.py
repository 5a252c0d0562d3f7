"""Per-column profiling: describe, value counts, categorical summary,
distinct / NULL / NaN counts.

Each function returns a lazy DataFrame computed in one aggregation pass
(plus one shuffle keyed by value where values must be grouped). Wide
inputs are handled in long form ``(column, value)`` so the job count
does not grow with the number of columns.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.longform import one_row, present, typed_long_form
from tablescout.functions.schema import (
    FLOATING_TYPES,
    categorical_columns,
    col,
    field_type,
    is_numeric,
    require_columns,
)

DESCRIBE_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("stddev", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
    ]
)

CAT_DESCRIBE_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("uniques", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("mode_count", T.LongType()),
    ]
)


def _columns(table: DataFrame, col_names: Sequence[str] | str | None) -> list[str]:
    if col_names is None:
        return list(table.columns)
    if isinstance(col_names, str):
        return [col_names]
    return list(col_names)


def _as_text(table: DataFrame, name: str) -> Column:
    """The column rendered as text: binary as hex, everything else cast."""
    dt = field_type(table, name)
    if isinstance(dt, T.BinaryType):
        return F.hex(col(name))
    return col(name).cast("string")


def _text_long_form(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, value)`` with every value rendered as text (NULL kept)."""
    pairs = [F.struct(F.lit(n).alias("column"), _as_text(table, n).alias("value")) for n in names]
    return table.select(F.inline(F.array(*pairs)))


def describe_table(table: DataFrame, col_names: Sequence[str] | None = None) -> DataFrame:
    """Spark's own ``describe`` (string cells: count, mean, stddev, min, max)."""
    # describe() covers numeric and string columns only.
    names = [
        n for n in _columns(table, col_names)
        if is_numeric(field_type(table, n)) or isinstance(field_type(table, n), T.StringType)
    ]
    # Spark's describe cannot resolve names with dots: describe plain aliases, rename back.
    plain = table.select(*[col(n).alias(f"_c{i}") for i, n in enumerate(names)])
    return plain.describe().toDF("summary", *names)


def describe_long(table: DataFrame, col_names: Sequence[str] | None = None) -> DataFrame:
    """Typed long form ``(column, count, mean, stddev, min, max)`` for numeric columns.

    One aggregation pass for all columns; ``stddev`` is the sample standard deviation.
    """
    names = [n for n in _columns(table, col_names) if is_numeric(field_type(table, n))]
    if not names:
        return table.sparkSession.createDataFrame([], DESCRIBE_SCHEMA)
    aggs = []
    for i, n in enumerate(names):
        x = col(n).cast("double")
        aggs += [
            F.count(col(n)).alias(f"c{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    wide = table.agg(*aggs)
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.col(f"c{i}").alias("count"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("stddev"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
        )
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def value_count(table: DataFrame, col_names: Sequence[str] | str | None, arg_str=None) -> list[DataFrame]:
    """One ``(col, count)`` frame per column; NULL is a group of its own.

    Unknown columns are reported with a warning and skipped.
    """
    out = []
    for c in _columns(table, col_names):
        if c not in table.columns:
            warnings.warn(f"the table has no column {c!r}; it is left out", stacklevel=2)
            continue
        out.append(table.groupBy(col(c)).count())
    return out


def value_count_long(table: DataFrame, col_names: Sequence[str] | str | None = None) -> DataFrame:
    """All requested columns at once: ``(column, value, count)`` with values as text."""
    names = _columns(table, col_names)
    require_columns(table, names)
    return _text_long_form(table, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def cat_describe(table: DataFrame, col_names: Sequence[str] | str | None = None, arg_str=None) -> DataFrame | None:
    """``(column, count, uniques, mode, mode_count)`` for string/binary/boolean columns.

    ``count`` includes NULLs, ``uniques`` counts NULL as a value, the mode
    is the most frequent value with ties going to the largest value and
    NULL losing ties. Columns are taken in table order. Returns None when
    none of the requested columns is categorical.
    """
    requested = None if col_names is None else _columns(table, col_names)
    names = categorical_columns(table, requested)
    if not names:
        warnings.warn(
            "none of the columns holds text, binary or boolean values, so there is nothing to describe",
            stacklevel=2,
        )
        return None
    # Values are counted by a 128-bit key and their first bytes as a number, never by their text.
    value = F.col("value")
    first = F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    long = _text_long_form(table, names)
    keyed = long.select("column", F.xxhash64(value).alias("h"), F.when(value.isNotNull(), F.xxhash64(value, F.lit(1))).alias("g"), first.alias("first"))
    counts = keyed.groupBy("column", "h", "g", "first").agg(F.count(F.lit(1)).alias("n"))
    # Count and first bytes in one number, so that one fixed-width aggregation finds the most frequent values
    # and among them the greatest beginning. NULL has no first bytes, so it loses ties.
    counts = counts.select("column", "h", "g", "n", (F.col("n").cast("decimal(19,0)") * F.lit(1 << 57) + F.coalesce(F.col("first") + 1, F.lit(0))).cast("decimal(38,0)").alias("place"))
    stats = counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("uniques"), F.max("n").alias("mode_count"), F.max("place").alias("place")
    )
    # One row per column: a schema-bounded broadcast.
    ties = counts.join(F.broadcast(stats.select("column", "place")), ["column", "place"]).select("column", "h", "g")
    stats = stats.drop("place")
    # Their texts, taken from the rows and reduced to the largest before the shuffle.
    texts = long.where(value.isNotNull()).select("column", F.xxhash64(value).alias("h"), F.xxhash64(value, F.lit(1)).alias("g"), "value")
    modes = texts.join(ties, ["column", "h", "g"], "left_semi").groupBy("column").agg(F.max("value").alias("mode"))
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("column"))
    listed = table.sparkSession.createDataFrame([(n,) for n in names], "column string")
    return (
        listed.join(stats, "column", "left")
        .join(modes, "column", "left")
        .select(
            "column",
            F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
            F.coalesce(F.col("uniques"), F.lit(0)).cast("bigint").alias("uniques"),
            F.col("mode"),
            F.coalesce(F.col("mode_count"), F.lit(0)).cast("bigint").alias("mode_count"),
        )
        .orderBy(order)
    )


def distinct_count(table: DataFrame, col_names: Sequence[str] | str | None, method: str | None = "exact") -> DataFrame:
    """One row, one column per input: distinct non-NULL values, exact or HLL++ approximate."""
    names = _columns(table, col_names)
    require_columns(table, names)
    if method in ("exact", None):
        # One short row per column and distinct value; the counts then meet in one row.
        long, fields, _ = typed_long_form(table, names)
        values = long.where(present(fields)).groupBy("k", *fields).agg(F.lit(1).alias("one"))
        per_column = values.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        return one_row(per_column, names, lambda k: F.coalesce(F.sum(F.when(F.col("k") == k, F.col("n"))), F.lit(0)).cast("bigint"))
    if method == "approx":
        return table.agg(*[F.approx_count_distinct(col(c)).alias(c) for c in names])
    raise ValueError(f"method is 'exact' or 'approx', not {method!r}")


def _is_floating(table: DataFrame, name: str) -> bool:
    return isinstance(field_type(table, name), FLOATING_TYPES)


def nan_count(table: DataFrame, col_names: Sequence[str] | str | None, arg_str=None) -> DataFrame:
    """NaN values per column (0 for types that cannot hold NaN)."""
    names = _columns(table, col_names)
    require_columns(table, names)
    return table.agg(
        *[
            (F.count_if(F.isnan(col(c))) if _is_floating(table, c) else F.lit(0).cast("bigint")).alias(c)
            for c in names
        ]
    )


def null_count(table: DataFrame, col_names: Sequence[str] | str | None, arg_str=None) -> DataFrame:
    """NULL values per column."""
    names = _columns(table, col_names)
    require_columns(table, names)
    return table.agg(*[F.count_if(col(c).isNull()).alias(c) for c in names])


def missing_count(table: DataFrame, col_names: Sequence[str] | str | None, arg_str=None) -> DataFrame:
    """NULL or NaN values per column."""
    names = _columns(table, col_names)
    require_columns(table, names)

    def missing(c):
        cond = col(c).isNull()
        return cond | F.isnan(col(c)) if _is_floating(table, c) else cond

    return table.agg(*[F.count_if(missing(c)).alias(c) for c in names])
