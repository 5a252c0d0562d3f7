"""Load a list of files as DataFrames, forcing chosen columns to string.

Format comes from the extension after the last dot (a trailing
compression suffix is skipped), or from an explicit ``format=``.
Reading is lazy; only schema inference runs a job, and passing
``schema=`` avoids even that (the right choice on large inputs).
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.schema import col

_COMPRESSION = {"gz", "bz2", "deflate", "lz4", "snappy", "zst", "zstd", "xz"}
FORMATS = ("csv", "json", "txt", "parquet")


def format_of(path: str) -> str:
    """Format from the file (or directory) extension."""
    parts = os.path.basename(path.rstrip("/")).split(".")
    while len(parts) > 1 and parts[-1].lower() in _COMPRESSION:
        parts.pop()
    if len(parts) < 2:
        raise ValueError(f"cannot tell the format of {path!r}: no extension; pass format=")
    ext = parts[-1].lower()
    if ext in ("tsv", "tab"):
        ext = "txt"
    if ext == "jsonl":
        ext = "json"
    if ext not in FORMATS:
        raise ValueError(f"unsupported extension {ext!r} in {path!r}; supported: {FORMATS}")
    return ext


def cast_categorical(table: DataFrame, categorical_cols: Iterable[str] = ()) -> DataFrame:
    """Cast the listed columns to string; names the table lacks are ignored."""
    present = set(table.columns)
    casts = {c: col(c).cast(T.StringType()) for c in categorical_cols if c in present}
    return table.withColumns(casts) if casts else table


def read_table(
    spark: SparkSession,
    path: str,
    categorical_cols: Iterable[str] = (),
    format: str | None = None,
    sep: str = "\t",
    schema: T.StructType | str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Read one table. ``txt`` is header'd delimited text (``sep``, tab by default).

    ``options`` go to the Spark reader as they are (for example
    ``samplingRatio`` to infer a JSON schema from a sample, or ``multiLine``
    for quoted newlines); an explicit ``schema`` skips inference entirely.
    """
    fmt = format or format_of(path)
    reader = spark.read
    if options:
        reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    infer = schema is None
    if fmt == "csv":
        table = reader.csv(path, header=True, inferSchema=infer)
    elif fmt == "txt":
        table = reader.csv(path, sep=sep, header=True, inferSchema=infer)
    elif fmt == "json":
        table = reader.json(path)
    elif fmt == "parquet":
        table = reader.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}; supported: {FORMATS}")
    return cast_categorical(table, categorical_cols)


def handle_input(
    spark: SparkSession,
    input_list: Sequence[str],
    categorical_dictionary: Mapping[int, Sequence[str]] | None = None,
    **read_options,
) -> list[DataFrame]:
    """One DataFrame per path, in input order; ``categorical_dictionary`` maps index -> columns."""
    cats = categorical_dictionary or {}
    return [read_table(spark, p, cats.get(i, ()), **read_options) for i, p in enumerate(input_list)]
