"""Exact quantiles and medians of many columns by distributed rank selection.

Values are first counted per (column, value), so what follows grows with the
distinct values. The counts are range-partitioned in the order of column and
value, and each partition's total is known after one aggregation: the running
totals say in which partition a rank lies, and only those partitions are
searched, each by a running sum over its own rows. No task sees a whole
column, and nothing data-sized reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.longform import present, typed_long_form
from tablescout.functions.schema import FLOATING_TYPES, INTEGRAL_TYPES, field_type, is_numeric
from tablescout.operators.signature import materialize

QUANTILE_SCHEMA = "column string, prob double, value double"


def check_probabilities(probabilities: Sequence[float]) -> list[float]:
    probs = [float(p) for p in probabilities]
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"probability {p} is outside 0 to 1")
    return probs


def _lane(kind: T.DataType) -> T.DataType:
    if isinstance(kind, INTEGRAL_TYPES):
        return T.LongType()
    return T.DoubleType() if isinstance(kind, FLOATING_TYPES) else kind


def ordered_counts(table: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``part, k, v.., n``: value counts in range partitions ordered by column and value; NULL and NaN left out.

    Written once to the checkpoint folder: a range partitioning that is
    computed twice may be cut at other places.
    """
    for n in names:
        if not is_numeric(field_type(table, n)):
            raise TypeError(f"column {n!r} is {field_type(table, n).simpleString()}; quantiles need numbers")
    long, fields, _ = typed_long_form(table, names, _lane)
    long = long.where(present(fields))
    for f in fields:
        if isinstance(field_type(long, f), T.DoubleType):
            long = long.where(F.col(f).isNull() | ~F.isnan(f))
    counts = materialize(long.groupBy("k", *fields).agg(F.count(F.lit(1)).alias("n")))
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(parts, "k", *fields).select(F.spark_partition_id().alias("part"), "*")
    return materialize(ranged), fields


def select_ranks(counts: DataFrame, fields: Sequence[str], wanted: Column) -> DataFrame:
    """``k, rank, value`` of the ranks (from 1) that ``wanted``, an array over a column's row count ``total``, names."""
    sums = counts.groupBy("k", "part").agg(F.sum("n").alias("held"))  # partitions + columns rows
    by_part = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(by_part), F.lit(0))).withColumn("total", F.sum("held").over(Window.partitionBy("k")))
    asked = sums.select("k", "part", "before", "held", F.explode(F.array_distinct(wanted)).alias("rank"))
    asked = F.broadcast(asked.where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("held"))).drop("held"))
    searched = counts.join(asked.groupBy("k", "part").agg(F.first("before").alias("before")), ["k", "part"])
    upto = Window.partitionBy("k", "part").orderBy(*fields).rowsBetween(Window.unboundedPreceding, 0)
    placed = searched.select("k", "part", "n", *fields, (F.col("before") + F.sum("n").over(upto)).alias("upto"))
    hit = placed.join(asked.select("k", "part", "rank"), ["k", "part"]).where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
    return hit.select("k", "rank", F.coalesce(*[F.col(f).cast("double") for f in fields]).alias("value"))


def quantiles(table: DataFrame, names: Sequence[str], probabilities: Sequence[float], interpolate: bool = False) -> DataFrame:
    """``(column, prob, value)``, exact at any size; NULL for a column without values.

    Without interpolation the value is that of rank ``ceil(prob * rows)``, the
    least one for 0; with it, the two values around ``prob * (rows - 1)`` are
    weighted by their distance, as ``percentile`` does.
    """
    names, probs = list(names), check_probabilities(probabilities)
    spark = table.sparkSession
    if not names or not probs:
        return spark.createDataFrame([], QUANTILE_SCHEMA)
    counts, fields = ordered_counts(table, names)
    total = F.col("total")
    where = lambda p: F.lit(p) * (total - 1)
    low = lambda p: (F.floor(where(p)) + 1 if interpolate else F.greatest(F.lit(1), F.ceil(F.lit(p) * total))).cast("bigint")
    high = lambda p: (F.ceil(where(p)) + 1 if interpolate else F.greatest(F.lit(1), F.ceil(F.lit(p) * total))).cast("bigint")
    found = select_ranks(counts, fields, F.array(*[f(p) for p in probs for f in (low, high)]))
    # One row per column and probability from here on.
    totals = counts.groupBy("k").agg(F.sum("n").alias("total"))
    listed = spark.createDataFrame([(k, n, j, p) for k, n in enumerate(names) for j, p in enumerate(probs)], "k int, column string, j int, prob double")
    spots = totals.select("k", F.posexplode(F.array(*[F.struct(low(p).alias("low"), high(p).alias("high"), (where(p) - F.floor(where(p))).alias("far")) for p in probs])).alias("j", "s")).select("k", "j", "s.*")
    at = lambda name: found.select("k", F.col("rank").alias(name), F.col("value").alias(f"{name}_value"))
    spots = spots.join(at("low"), ["k", "low"]).join(at("high"), ["k", "high"])
    between = F.col("low_value") * (1 - F.col("far")) + F.col("high_value") * F.col("far")
    value = F.when(F.col("low") == F.col("high"), F.col("low_value")).otherwise(between)
    return listed.join(spots.select("k", "j", value.alias("value")), ["k", "j"], "left").select("column", "prob", "value")


def median(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row, a field ``median(column)`` per column."""
    found = quantiles(table, names, [0.5], interpolate=True)
    return found.agg(*[F.max(F.when(F.col("column") == n, F.col("value"))).alias(f"median({n})") for n in names])


def _kll_size(relative_error: float) -> int:
    # Published bound of the sketch at 99 % confidence: rank error 2.296 / k ** 0.9021.
    return max(8, -int(-((2.296 / relative_error) ** (1 / 0.9021)) // 1))


#: Fixed value: the largest size that the sketch takes; a smaller error is answered exactly.
MAX_KLL = 65535


def sketches(table: DataFrame, names: Sequence[str], relative_error: float, shares: int = 32) -> DataFrame:
    """``column, sketch``: a mergeable quantile sketch per column whose ranks are off by ``relative_error`` of the rows at most.

    Each share of the partitions is sketched on its own and the sketches are
    merged, so that no task reads more than its share. Sketches of several
    tables or days merge by ``kll_merge_agg_double``.
    """
    size = _kll_size(relative_error)
    long, fields, _ = typed_long_form(table, names, lambda kind: T.DoubleType())
    rows = long.where(F.col(fields[0]).isNotNull() & ~F.isnan(fields[0])).withColumn("share", F.spark_partition_id() % shares)
    parts = rows.groupBy("k", "share").agg(F.kll_sketch_agg_double(fields[0], size).alias("sketch"))
    merged = parts.groupBy("k").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    listed = table.sparkSession.createDataFrame(list(enumerate(names)), "k int, column string")
    return listed.join(merged, "k", "left").select("column", "sketch")


def approximate_quantiles(table: DataFrame, names: Sequence[str], probabilities: Sequence[float], relative_error: float) -> DataFrame:
    """``(column, prob, value)`` within ``relative_error`` of the rows in rank; 0 is exact."""
    if relative_error < 0:
        raise ValueError(f"relative error {relative_error} is negative")
    names, probs = list(names), check_probabilities(probabilities)
    if not names or not probs or relative_error == 0 or _kll_size(relative_error) > MAX_KLL:
        return quantiles(table, names, probs)
    for n in names:
        if not is_numeric(field_type(table, n)):
            raise TypeError(f"column {n!r} is {field_type(table, n).simpleString()}; quantiles need numbers")
    found = materialize(sketches(table, names, relative_error))  # one row a column: all probabilities come from one sketch
    rows = [F.struct(F.lit(p).alias("prob"), F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias("value")) for p in probs]
    return found.select("column", F.inline(F.array(*rows)))


def rank_errors(table: DataFrame, found: DataFrame, names: Sequence[str]) -> DataFrame:
    """``column, prob, error``: how far each value of ``found`` (column, prob, value) is from its exact rank, as a share of the rows.

    A value that stands for several ranks is right for all of them. One
    aggregation over the value counts, beside the few values.
    """
    long, fields, _ = typed_long_form(table, names, lambda kind: T.DoubleType())
    v = F.col(fields[0])
    listed = table.sparkSession.createDataFrame(list(enumerate(names)), "k int, column string")
    values = F.broadcast(found.join(listed, "column"))  # columns x probabilities
    rows = long.where(v.isNotNull() & ~F.isnan(v)).groupBy("k", v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    counted = rows.join(values, "k").groupBy("column", "prob").agg(
        F.sum(F.when(F.col("v") < F.col("value"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("value"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum("n").alias("total"),
    )
    target = F.col("prob") * F.col("total")
    off = F.greatest(F.lit(0.0), F.col("below") - target, target - F.col("upto"))
    return counted.select("column", "prob", (off / F.col("total")).alias("error"))
