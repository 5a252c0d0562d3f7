"""Distance-to-nearest-centre outliers on numeric columns.

Fit: ``pyspark.ml`` k-means on the assembled features, with rows holding
NULL or NaN skipped. Scoring: the distance to the nearest fitted centre
as a column expression with the centres as literals, then a filter, so
the result keeps the table's own columns and schema. Rows with NULL or
NaN features are never outliers (Spark orders NaN above every number,
so ``NaN > cutoff`` would otherwise be true).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.functions.distance import nearest_center_distance
from tablescout.functions.schema import col, field_type, is_numeric, require_columns

_LOG = logging.getLogger(__name__)


def _features(table: DataFrame, col_names: Sequence[str]) -> list[str]:
    names = [col_names] if isinstance(col_names, str) else list(col_names)
    require_columns(table, names)
    for n in names:
        if not is_numeric(field_type(table, n)):
            raise ValueError(f"outlier features must be numeric; {n!r} is {field_type(table, n).simpleString()}")
    return names


def fit_centers(
    table: DataFrame,
    col_names: Sequence[str],
    num_clusters: int,
    maxIterations: int = 10,
    initializationMode: str = "random",
    seed: int | None = None,
) -> list[list[float]]:
    """k-means centres (``num_clusters`` x features; the only eager step)."""
    names = _features(table, col_names)
    assembled = VectorAssembler(inputCols=names, outputCol="_features", handleInvalid="skip").transform(
        table.select(*[col(n).cast("double").alias(n) for n in names])
    )
    km = KMeans(
        k=num_clusters, maxIter=maxIterations, initMode=initializationMode, featuresCol="_features"
    )
    if seed is not None:
        km = km.setSeed(seed)
    model = km.fit(assembled)
    return [[float(v) for v in c] for c in model.clusterCenters()]


def distance_column(col_names: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    return nearest_center_distance(list(col_names), centers)


def outliers_given_centers(
    table: DataFrame, col_names: Sequence[str], centers: Sequence[Sequence[float]], cutoff_distance: float
) -> DataFrame:
    """Rows farther than ``cutoff_distance`` (strictly) from every centre, original columns."""
    names = _features(table, col_names)
    d = distance_column(names, centers)
    return table.where(d.isNotNull() & ~F.isnan(d) & (d > F.lit(float(cutoff_distance))))


def sum_distance(table: DataFrame, col_names: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """One row: ``sum_distance`` (what the profiled toolkit printed as WSSSE) and
    ``sum_squared_distance`` (the true within-set sum of squares), over complete rows."""
    names = _features(table, col_names)
    d = distance_column(names, centers)
    scored = table.select(d.alias("d")).where(F.col("d").isNotNull() & ~F.isnan("d"))
    return scored.agg(F.sum("d").alias("sum_distance"), F.sum(F.col("d") * F.col("d")).alias("sum_squared_distance"))


def outliers(
    table: DataFrame,
    col_names: Sequence[str],
    num_clusters: int,
    cutoff_distance: float,
    maxIterations: int = 10,
    initializationMode: str = "random",
    wssse: bool = False,
    seed: int | None = None,
) -> DataFrame:
    """Fit k-means on ``col_names``, return the rows beyond ``cutoff_distance``."""
    centers = fit_centers(table, col_names, num_clusters, maxIterations, initializationMode, seed)
    if wssse:
        total = sum_distance(table, col_names, centers).first()
        _LOG.info("distances to the nearest of %d centres add up to %s", num_clusters, total["sum_distance"])
    return outliers_given_centers(table, col_names, centers, cutoff_distance)
