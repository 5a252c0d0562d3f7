"""Histograms of one numeric column, as DataFrame plans.

NULL and NaN never count. With a number of bins, the range from the least to
the greatest value is cut evenly; with a list of edges, values outside are
left out. A bin holds its lower edge, and the last bin its upper edge as well.
If all values are equal, there is one bin.

Integers and decimals are binned in exact arithmetic on whole numbers (a
decimal by its digits without the point), so large neighbours never fall
together. Doubles use the division ``(v - min) / width``, also between edges
that are evenly spaced to 1e-10. For all other edges a binary search counts the
edges that are not greater, whatever their number.

Only the extremes and the row count reach the driver; counting is one
map-side-combined aggregation over at most ``bins`` keys, joined to the list of
bins so that empty ones show up.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.schema import FLOATING_TYPES, col, field_type, is_numeric

SCHEMA = "bin_start_value double, bin_end_value double, count bigint"
#: Fixed value: steps between edges that differ by less count as even.
EVEN = 1e-10


class _Lane(NamedTuple):
    """The column as it is compared: ``v`` a double, or a whole number of units of ``10 ** -scale``."""

    rows: DataFrame
    scale: int | None  # None: double

    def units(self, x) -> Fraction:
        return Fraction(x) * 10**self.scale

    def shown(self, x) -> float:
        return float(x) + 0.0 if self.scale is None else float(Fraction(int(x), 10**self.scale))  # + 0.0: never -0.0


def _lane(table: DataFrame, name: str) -> _Lane:
    kind = field_type(table, name)
    if not is_numeric(kind):
        raise TypeError(f"column {name!r} is {kind.simpleString()}; only numeric columns have a histogram")
    value = col(name)
    if isinstance(kind, FLOATING_TYPES):
        value = value.cast("double")
        return _Lane(table.select(value.alias("v")).where(value.isNotNull() & ~F.isnan(value)), None)
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    if scale:  # the digits alone: a shift of the point that cannot round
        value = F.replace(value.cast("string"), F.lit(".")) if kind.precision == 38 else value * F.lit(Decimal(10**scale))
    return _Lane(table.select(value.cast("decimal(38,0)").alias("v")).where(value.isNotNull()), scale)


def _only_name(col_name) -> str:
    names = [col_name] if isinstance(col_name, str) else list(col_name) if isinstance(col_name, (list, tuple)) else []
    if len(names) != 1 or not isinstance(names[0], str):
        raise ValueError(f"a histogram takes the name of one column, not {col_name!r}")
    return names[0]


def even_width(low: float, high: float, bins: int) -> float:
    """The width of ``bins`` even bins; where whole numbers divide without rest it is one of them."""
    width = (high - low) / bins
    if not math.isfinite(width):
        raise ValueError(f"values from {low} to {high} cannot be cut into bins of a finite width")
    whole = float(math.trunc(width))
    return whole if whole * bins == high - low else width


def given_edges(edges: Sequence) -> list[Fraction | float]:
    """The edges, checked: two or more numbers that rise."""
    if len(edges) < 2:
        raise ValueError("two edges are needed at least")
    for e in edges:
        if e is None or isinstance(e, bool) or not isinstance(e, (int, float, Decimal, Fraction)) or e != e:
            raise ValueError(f"{e!r} cannot be an edge")
    for a, b in zip(edges, edges[1:]):
        if not a < b:
            raise ValueError(f"edges must rise: {a!r} comes before {b!r}")
    return list(edges)


def _at_most(v: Column, edges: str, n: int) -> Column:
    """How many of ``n`` rising edges (a SQL array) are not greater than ``v``: a binary search by halving steps."""
    steps = [1 << k for k in range(n.bit_length() - 1, -1, -1)]
    array = F.expr(edges)

    def further(at: Column, step: Column) -> Column:
        probe = at + step
        return F.when((probe <= n) & (F.get(array, F.least(probe, F.lit(n)) - 1) <= v), probe).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def _counted(index: DataFrame, starts: DataFrame) -> DataFrame:
    counts = index.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    found = starts.join(counts, "bin", "left")
    return found.select("bin_start_value", "bin_end_value", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")).orderBy("bin_start_value")


def _into_even(lane: _Lane, low, high, bins: int) -> DataFrame:
    """Bins between the extremes; edges come from the executors, so their number costs the driver nothing."""
    low_shown, high_shown = lane.shown(low), lane.shown(high)
    width = even_width(low_shown, high_shown, bins)
    v = F.col("v")
    if lane.scale is None:
        at = F.floor((v - F.lit(low_shown)) / F.lit(width)).cast("int")
    else:  # exact: up to 38 digits
        at = F.expr(f"CAST((v - {low}BD) * {bins}BD div {int(high) - int(low)}BD AS INT)")
    index = lane.rows.select(F.least(at, F.lit(bins - 1)).alias("bin"))
    i = F.col("id")
    edge = lambda k: k.cast("double") * F.lit(width) + F.lit(low_shown)
    starts = lane.rows.sparkSession.range(bins).select(
        i.cast("int").alias("bin"), edge(i).alias("bin_start_value"), F.when(i == bins - 1, F.lit(high_shown)).otherwise(edge(i + 1)).alias("bin_end_value")
    )
    return _counted(index, starts)


def _into_given(lane: _Lane, edges: list) -> DataFrame:
    shown = [float(e) + 0.0 for e in edges]
    bins = len(edges) - 1
    v = F.col("v")
    steps = [b - a for a, b in zip(shown, shown[1:])]
    if lane.scale is None:
        inside = lane.rows.where((v >= F.lit(shown[0])) & (v <= F.lit(shown[-1])))
        if max(steps) - min(steps) < EVEN:
            at = F.floor((v - F.lit(shown[0])) / F.lit((shown[-1] - shown[0]) / bins)).cast("int")
        else:
            at = _at_most(v, "array(" + ", ".join(f"CAST('{e!r}' AS DOUBLE)" for e in shown) + ")", len(shown)) - 1
    else:
        # A whole number reaches an edge if it reaches the next whole number from there.
        top = Fraction(10**38 - 1)
        exact = [max(-top, min(top + 1, lane.units(e))) if math.isfinite(e) else (top + 1 if e > 0 else -top) for e in edges]
        first, last = math.ceil(exact[0]), math.floor(min(exact[-1], top))
        literal = lambda x: f"CAST('{x}' AS DECIMAL(38,0))"
        inside = lane.rows.where(F.expr(f"v >= {literal(first)} AND v <= {literal(last)}"))
        reach = [math.ceil(e) for e in exact if math.ceil(e) <= top]
        at = _at_most(v, "array(" + ", ".join(map(literal, reach)) + ")", len(reach)) - 1
    index = inside.select(F.least(at, F.lit(bins - 1)).alias("bin"))
    starts = lane.rows.sparkSession.createDataFrame(
        [(i, shown[i], shown[i + 1]) for i in range(bins)], "bin int, bin_start_value double, bin_end_value double"
    )
    return _counted(index, starts)


def histogram(table: DataFrame, col_name, bins: int | Sequence | None = 10) -> DataFrame:
    """``(bin_start_value, bin_end_value, count)`` for one numeric column.

    ``bins`` is the number of even bins or a list of edges. No value at all, a
    range without a finite width, and edges that do not rise are errors.
    Edges are shown as doubles, whatever they are compared as.
    """
    lane = _lane(table, _only_name(col_name))
    bins = 10 if bins is None else bins
    if isinstance(bins, (list, tuple)):
        return _into_given(lane, given_edges(bins))
    if isinstance(bins, bool) or not isinstance(bins, int):
        raise TypeError(f"bins are a number or a list of edges, not {bins!r}")
    if bins < 1:
        raise ValueError("one bin is needed at least")
    low, high, n = lane.rows.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("no value to make bins from")
    if low == high or bins == 1:
        return table.sparkSession.createDataFrame([(lane.shown(low), lane.shown(high), n)], SCHEMA)
    return _into_even(lane, low, high, bins)
