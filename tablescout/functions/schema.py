"""Schema-level column selectors (no Spark job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING_TYPES = (T.FloatType, T.DoubleType)
CATEGORICAL_TYPES = (T.StringType, T.BinaryType, T.BooleanType)


def col(name: str) -> Column:
    """A column by its exact name, even with dots or backticks in it (CSV headers)."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(table: DataFrame) -> list[str]:
    """Names of the string columns, in table order (join-discovery candidates)."""
    return [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]


def has_categorical(table: DataFrame) -> bool:
    return bool(string_columns(table))


def categorical_columns(table: DataFrame, requested: list[str] | None = None) -> list[str]:
    """Requested string/binary/boolean columns, in table order (not request order)."""
    wanted = None if requested is None else set(requested)
    return [
        f.name
        for f in table.schema.fields
        if isinstance(f.dataType, CATEGORICAL_TYPES) and (wanted is None or f.name in wanted)
    ]


def field_type(table: DataFrame, name: str) -> T.DataType:
    for f in table.schema.fields:
        if f.name == name:
            return f.dataType
    raise ValueError(f"cannot resolve column {name!r}; columns are {table.columns}")


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def require_columns(table: DataFrame, names: list[str]) -> None:
    missing = [n for n in names if n not in table.columns]
    if missing:
        raise ValueError(f"cannot resolve column(s) {missing}; columns are {table.columns}")
