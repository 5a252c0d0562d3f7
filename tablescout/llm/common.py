"""Helpers shared by the operators: scratch tables, Arrow slicing, folds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.session import checkpoint_dir

#: Bytes of text that one numpy pass works on at a time.
SLICE_BYTES = 1 << 21
#: Bytes of an Arrow batch where memory is short.
ARROW_BYTES = 1 << 22


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new table in the shared checkpoint folder and read it back.

    Cuts the lineage: what follows does not recompute what came before, also
    not when executors are lost.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def small_arrow_batches(spark: SparkSession) -> None:
    """Bound the bytes of the batches that tasks exchange with Python.

    By default a batch holds 10,000 rows of up to 64 MB, which a task keeps on
    both sides, and in the JVM twice while its buffers double.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        spark, path = df.sparkSession, df._stored_at
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids have no fold (NULL)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(modulus)


def in_fold(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether the id is in the fold; False for null ids."""
    return F.coalesce(fold(id_col, modulus) == F.lit(remainder), F.lit(False))


def field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def arrow_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds at most ``limit`` bytes in each (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, empty for null."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]
