"""MinHash signatures of string columns, computed as one Spark plan.

Plan per table set (one scan per table, whatever the column count):

1. ``unpivot`` every string column of every table into the long form
   ``(col_id, value)``; NULL is never a value.
2. Replace the value by ``crc32`` (and, when distinct counts are wanted,
   a 64-bit xxhash) right after the scan, so text never shuffles.
3. ``groupBy(col_id, crc)`` with map-side partial
   aggregation: one row per distinct crc, carrying its row count.
   A hot value costs one row per map task, not one per input row.
4. ``inline`` the (literal, ``hashnum``-sized) coefficient array, hash,
   and ``groupBy(col_id, hash_index)`` with
   ``min(h)`` and ``min_by(cnt, h)``: both HashAggregate with partial
   aggregation, so at most columns x hashnum rows per task are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.functions.hashing import (
    HashCoefficients,
    coefficient_array,
    crc32_of,
    family_hash,
    fingerprint_of,
    wide_key,
)
from tablescout.functions.schema import col, string_columns
from tablescout.session import checkpoint_dir

SIGNATURE_COLUMNS = ["table_index", "col_name", "hash_index", "hash_value", "min_hash_count"]


@dataclass(frozen=True)
class LongForm:
    """``df`` is ``(col_id int, value string)``; ``columns[col_id] = (table_index, col_name)``.

    Rows are keyed by a small int instead of the column name: every
    per-row hash-map probe and shuffle record is cheaper, and the
    (schema-sized) mapping back to names happens once, on the result.
    """

    df: DataFrame
    columns: tuple[tuple[int, str], ...]

    def named(self, col_id: Column | None = None) -> list[Column]:
        """``table_index`` and ``col_name`` for a col_id column (literal lookups)."""
        col_id = F.col("col_id") if col_id is None else col_id
        tables = F.expr("array(" + ", ".join(str(t) for t, _ in self.columns) + ")")
        names = F.array(*[F.lit(c) for _, c in self.columns])
        return [
            F.element_at(tables, col_id + 1).cast("int").alias("table_index"),
            F.element_at(names, col_id + 1).alias("col_name"),
        ]


def long_form(
    tables: Sequence[tuple[int, DataFrame, Sequence[str]]],
    value_expr=None,
) -> LongForm | None:
    """Long form over ``(table_index, table, column_names)`` triples (tables without columns skipped)."""
    parts, columns = [], []
    for index, table, cols in tables:
        if not cols:
            continue
        values = []
        for c in cols:
            values.append(
                F.struct(
                    F.lit(len(columns)).alias("col_id"),
                    (value_expr(c) if value_expr else col(c)).alias("value"),
                )
            )
            columns.append((index, c))
        parts.append(table.select(F.inline(F.array(*values))))
    if not parts:
        return None
    return LongForm(reduce(DataFrame.unionByName, parts), tuple(columns))


def string_long_form(
    tables: Sequence[DataFrame], table_ind: Sequence[int] | None = None, columns: dict | None = None
) -> LongForm | None:
    """Long form of the string columns of the chosen tables (all, by default).

    ``columns`` optionally maps a table index to the columns to use.
    """
    chosen = range(len(tables)) if table_ind is None else table_ind
    spec = []
    for i in chosen:
        cols = string_columns(tables[i])
        if columns is not None and i in columns:
            wanted = set(columns[i])
            cols = [c for c in cols if c in wanted]
        spec.append((i, tables[i], cols))
    return long_form(spec)


def column_digest(long: LongForm, with_values: bool = False, wide: bool = False) -> DataFrame:
    """Per ``(col_id, crc)``: the row count ``cnt`` of non-NULL values.

    With ``wide`` the column ``crc`` holds the 60-bit key; a key is then a
    value, and ``n_values`` costs no second grouping.

    With ``with_values`` also ``n_values``, the number of distinct values
    sharing that crc (values are keyed by crc and a 64-bit xxhash, so
    distinct counts cost a 12-byte key per value, never the text).
    """
    if wide:
        keyed = long.df.where(F.col("value").isNotNull()).select("col_id", wide_key(F.col("value")).alias("crc"))
        counts = keyed.groupBy("col_id", "crc").agg(F.count(F.lit(1)).alias("cnt"))
        return counts.withColumn("n_values", F.lit(1)) if with_values else counts
    keyed = long.df.where(F.col("value").isNotNull()).select(
        "col_id", crc32_of(F.col("value")).alias("crc"),
        *([fingerprint_of(F.col("value")).alias("fp")] if with_values else []),
    )
    if not with_values:
        return keyed.groupBy("col_id", "crc").agg(F.count(F.lit(1)).alias("cnt"))
    per_value = keyed.groupBy("col_id", "crc", "fp").agg(F.count(F.lit(1)).alias("cnt"))
    return per_value.groupBy("col_id", "crc").agg(F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("n_values"))


def hashed_digest(digest: DataFrame, coeffs: HashCoefficients) -> DataFrame:
    """One row per (column, crc, hash function): ``col_id, hash_index, h, cnt``."""
    extra = ["n_values"] if "n_values" in digest.columns else []
    return digest.select("col_id", "cnt", "crc", *extra, F.inline(coefficient_array(coeffs))).select(
        "col_id",
        "hash_index",
        family_hash(coeffs, F.col("crc"), F.col("a_hi"), F.col("a_lo"), F.col("b")).alias("h"),
        "cnt",
        *extra,
    )


def signature_from_digest(digest: DataFrame, coeffs: HashCoefficients, long: LongForm) -> DataFrame:
    """MinHash signature: per column and hash function, the minimum and its row count.

    A digest made ``with_values`` also yields ``n_distinct`` (every crc row
    appears once per hash function, so summing its ``n_values`` there counts
    the column's distinct values without another pass).
    """
    aggs = [F.min("h").alias("hash_value"), F.min_by("cnt", F.col("h")).alias("min_hash_count")]
    if "n_values" in digest.columns:
        aggs.append(F.sum("n_values").cast("bigint").alias("n_distinct"))
    out = hashed_digest(digest, coeffs).groupBy("col_id", "hash_index").agg(*aggs)
    extra = ["n_distinct"] if "n_values" in digest.columns else []
    return out.select(*long.named(), "hash_index", "hash_value", "min_hash_count", *extra)


def materialize(df: DataFrame) -> DataFrame:
    """Run ``df`` once and cut its lineage into the shared checkpoint folder.

    Used for signatures (columns x hashnum rows), which several later joins
    read with different column pruning; without this each of them would
    rescan the tables. The checkpoint survives executor loss.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def signature(long: LongForm, coeffs: HashCoefficients) -> DataFrame:
    """Signature of every column in a long form."""
    return signature_from_digest(column_digest(long, wide=coeffs.wide), coeffs, long)


def multiple_table_signature(
    tables: Sequence[DataFrame], coeffs: HashCoefficients, table_ind: Sequence[int] | None = None
) -> DataFrame:
    """Signatures of all string columns of the chosen tables (one union, one aggregation)."""
    long = string_long_form(tables, table_ind)
    if long is None:
        raise ValueError("no table has a categorical column, that is one of strings")
    return signature(long, coeffs)


def single_table_signature(table: DataFrame, table_ind: int, coeffs: HashCoefficients) -> DataFrame:
    long = long_form([(table_ind, table, string_columns(table))])
    if long is None:
        raise ValueError(f"table {table_ind} has no categorical (string) fields")
    return signature(long, coeffs)
