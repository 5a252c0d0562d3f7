"""Several columns as rows ``(k, value)``, one nullable field per data type."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.schema import col, field_type


def typed_long_form(
    table: DataFrame, names: Sequence[str], lane_type: Callable[[T.DataType], T.DataType] = lambda t: t
) -> tuple[DataFrame, list[str], list[int]]:
    """``table`` in long form, its fields ``v0, v1 ..`` and the field of each column.

    Row ``k`` holds column ``names[k]`` in the field of its type (cast to
    ``lane_type`` of it); the other fields are NULL. A row of the table costs
    one short row per column, however many columns there are.
    """
    types = [lane_type(field_type(table, n)) for n in names]
    lanes: list[T.DataType] = []
    for t in types:
        if t not in lanes:
            lanes.append(t)
    lane_of = [lanes.index(t) for t in types]
    fields = [f"v{j}" for j in range(len(lanes))]
    items = [
        F.struct(
            F.lit(k).alias("k"),
            *[(col(n).cast(lanes[j]) if j == lane_of[k] else F.lit(None).cast(lanes[j])).alias(f"v{j}") for j in range(len(lanes))],
        )
        for k, n in enumerate(names)
    ]
    return table.select(F.inline(F.array(*items))), fields, lane_of


def present(fields: Sequence[str]) -> Column:
    """Whether a row of the long form holds a value."""
    return F.coalesce(*[F.when(F.col(f).isNotNull(), True) for f in fields], F.lit(False))


def one_row(long: DataFrame, names: Sequence[str], aggregate: Callable[[int], Column]) -> DataFrame:
    """One row with a field per name: ``aggregate(k)`` over the rows of column k."""
    return long.agg(*[aggregate(k).alias(n) for k, n in enumerate(names)])
