"""Euclidean distance to the nearest of a fixed set of centres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablescout.functions.schema import col


def nearest_center_distance(features: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """``sqrt(min_k sum_j (x_j - c_kj)^2)``; NULL if any feature is NULL, NaN if any is NaN."""
    if not centers:
        raise ValueError("at least one centre is required")
    dims = len(features)
    for c in centers:
        if len(c) != dims:
            raise ValueError(f"centre {list(c)} has {len(c)} coordinates, expected {dims}")
    xs = [col(f).cast("double") for f in features]
    table = F.expr("array(" + ", ".join("array(" + ", ".join(f"CAST('{float(v)!r}' AS DOUBLE)" for v in c) + ")" for c in centers) + ")")
    # One short sum per centre, whatever their number. A NULL coordinate makes
    # every sum NULL, and with it the least.
    square = lambda x, c: (x - c) * (x - c)
    per_center = F.transform(table, lambda c: sum((square(x, F.get(c, F.lit(j))) for j, x in enumerate(xs)), F.lit(0.0)))
    return F.sqrt(F.array_min(per_center))
