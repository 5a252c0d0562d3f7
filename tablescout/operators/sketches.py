"""Column profiles that are kept and added to: a HyperLogLog sketch per column and part of a table.

A table that grows by parts is profiled once per part: the part's sketches go
as rows into a Parquet folder, and distinct counts of the whole are those of
the merged rows. Neither the old parts nor their values are read again.
A sketch has a size fixed by ``lg_k`` (2^lg_k cells), whatever it counts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.schema import FLOATING_TYPES, INTEGRAL_TYPES, col, field_type, require_columns

LG_K = 12
SHARES = 32
STORE = "table_name string, part string, column string, n_rows bigint, n_nulls bigint, lg_k int, sketch binary"
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _value(table: DataFrame, name: str) -> Column:
    """The value in a type that sketches take; equal values stay equal, others stay different."""
    kind, value = field_type(table, name), col(name)
    if isinstance(kind, _NESTED):
        raise TypeError(f"column {name!r} is nested; its values cannot be counted")
    if isinstance(kind, INTEGRAL_TYPES):
        return value.cast("bigint")
    if isinstance(kind, T.TimestampType):  # text would depend on the session's time zone
        return F.unix_micros(value)
    text = F.base64(value) if isinstance(kind, T.BinaryType) else value.cast("string")
    if isinstance(kind, FLOATING_TYPES):  # 0.0 and -0.0 are one value
        text = F.when(value == 0, "0").otherwise(text)
    return F.concat(F.lit("="), text)  # sketches pass over empty text


def sketched_columns(table: DataFrame) -> list[str]:
    """The columns whose values can be counted: all that are not nested."""
    return [f.name for f in table.schema.fields if not isinstance(f.dataType, _NESTED)]


def column_sketches(
    table: DataFrame, table_name: str, part: str = "", columns: Sequence[str] | None = None, lg_k: int = LG_K
) -> DataFrame:
    """One row per column, as in ``STORE``: row and NULL counts and the sketch of its values, in one scan.

    Sketches of tasks are merged within 32 shares before they meet in one
    task. A column without values has a NULL sketch; an empty table has rows
    with counts of 0.
    """
    names = sketched_columns(table) if columns is None else list(columns)
    require_columns(table, names)
    if not names:
        return table.sparkSession.createDataFrame([], STORE)
    values = table.select(
        F.pmod(F.spark_partition_id(), F.lit(SHARES)).alias("share"), *[_value(table, n).alias(f"v{k}") for k, n in enumerate(names)]
    )
    shares = values.groupBy("share").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(f"v{k}").alias(f"n{k}") for k in range(len(names))],
        *[F.when(F.count(f"v{k}") > 0, F.hll_sketch_agg(f"v{k}", lg_k)).alias(f"s{k}") for k in range(len(names))],
    )
    whole = shares.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        *[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(len(names))],
        *[F.when(F.sum(f"n{k}") > 0, F.hll_union_agg(f"s{k}")).alias(f"s{k}") for k in range(len(names))],
    )
    rows = [
        F.struct(
            F.lit(n).alias("column"), F.col("n_rows"), (F.col("n_rows") - F.col(f"n{k}")).alias("n_nulls"),
            F.lit(lg_k).alias("lg_k"), F.col(f"s{k}").alias("sketch"),
        )
        for k, n in enumerate(names)
    ]
    return whole.select(F.lit(table_name).alias("table_name"), F.lit(part).alias("part"), F.inline(F.array(*rows)))


def add_part(
    store: str, table: DataFrame, table_name: str, part: str, columns: Sequence[str] | None = None, lg_k: int = LG_K
) -> None:
    """Profile one part of a table into the folder ``store``; a part that is there is replaced, so a repeated run is safe.

    Each part has a folder of its own: parts can be added by several jobs at
    once, and an addition reads no other part.
    """
    if not all(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name) for name in (table_name, part)):
        raise ValueError("table and part names are folder names: letters, digits, '_', '-' and '.', the first a letter or digit")
    sketches = column_sketches(table, table_name, part, columns, lg_k)
    sketches.write.mode("overwrite").parquet(f"{store}/{table_name}/{part}")


def read_store(spark: SparkSession, store: str, tables: Sequence[str]) -> DataFrame:
    """All rows of the given tables in a store."""
    frames = [spark.read.schema(STORE).parquet(f"{store}/{t}/*") for t in tables]
    return reduce(DataFrame.unionByName, frames)


def merged(sketches: DataFrame) -> DataFrame:
    """Rows of parts as one row per table and column: sums of the counts, union of the sketches.

    Sketches of different ``lg_k`` merge to the smaller one.
    """
    return sketches.groupBy("table_name", "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.min("lg_k").alias("lg_k"),
        F.when(F.count("sketch") > 0, F.hll_union_agg(F.col("sketch"), F.lit(True))).alias("sketch"),
    )


def relative_error(lg_k: Column) -> Column:
    """Three standard errors of a merged sketch of ``2^lg_k`` cells, each ``1.04 / sqrt(cells)``."""
    return F.lit(3 * 1.04) / F.sqrt(F.pow(F.lit(2.0), lg_k))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``table_name, column, n_rows, n_nulls, n_distinct, error``: the estimate and its bound in values (three standard errors)."""
    whole = merged(sketches)
    estimate = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("bigint")
    return whole.select(
        "table_name", "column", "n_rows", "n_nulls", estimate.alias("n_distinct"),
        (relative_error(F.col("lg_k")) * estimate).alias("error"),
    )


def new_values(sketches: DataFrame, part: str) -> DataFrame:
    """``table_name, column, n_distinct, without, added``: the estimate with and without one part, and what the part added (0 at least)."""
    rest = distinct_estimates(sketches.where(F.col("part") != part)).select("table_name", "column", F.col("n_distinct").alias("without"))
    both = distinct_estimates(sketches).join(rest, ["table_name", "column"], "left")
    without = F.coalesce("without", F.lit(0)).cast("bigint")
    added = F.greatest(F.lit(0).cast("bigint"), F.col("n_distinct") - without)
    return both.select("table_name", "column", "n_distinct", without.alias("without"), added.alias("added"))
