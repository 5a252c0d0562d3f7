"""DataFrame methods that take a column list, callable by name.

Grouping methods finish with ``.count()`` so every entry returns a
DataFrame; ``approxQuantile`` returns rows instead of a driver list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.functions.schema import col
from tablescout.operators import ranks


def _names(table: DataFrame, col_names) -> list[str]:
    if col_names is None:
        return list(table.columns)
    return [col_names] if isinstance(col_names, str) else list(col_names)


def _cols(table: DataFrame, col_names):
    """Columns by exact name (names with dots or spaces included)."""
    return [col(n) for n in _names(table, col_names)]


def quantiles(
    table: DataFrame, col_names, probabilities: Sequence[float] = (0.25, 0.5, 0.75), relative_error: float = 0.01
) -> DataFrame:
    """``(column, prob, value)``, off by ``relative_error`` of the rows in rank at most; 0 is exact at any size."""
    return ranks.approximate_quantiles(table, _names(table, col_names), probabilities, relative_error)


def frequent_items(table: DataFrame, col_names, support: float = 0.01) -> DataFrame:
    """``(column, value, count)``: exactly the values of more than ``support`` of a column's rows, as text.

    A bounded set of counters per task names the candidates and misses none;
    the candidates alone are then counted, so no other value is shuffled.
    NULL counts as a row but not as a value.
    """
    names = _names(table, col_names)
    if not 0 < support <= 1:
        raise ValueError(f"support {support} is not above 0 and at most 1")
    plain = table.select(*[col(n).cast("string").alias(f"c{k}") for k, n in enumerate(names)])
    found = plain.freqItems(plain.columns, support)
    listed = found.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"c{k}_freqItems").alias("values")) for k in range(len(names))])).alias("x"))
    candidates = F.broadcast(listed.select("x.k", F.explode("x.values").alias("value")).where("value IS NOT NULL"))  # 1 / support a column at most
    pairs = [F.struct(F.lit(k).alias("k"), F.col(f"c{k}").alias("value")) for k in range(len(names))]
    counts = plain.select(F.inline(F.array(*pairs))).join(candidates, ["k", "value"]).groupBy("k", "value").agg(F.count(F.lit(1)).alias("count"))
    rows = plain.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("k"), "rows")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("k") + 1)
    return counts.join(F.broadcast(rows), "k").where(F.col("count") > F.lit(support) * F.col("rows")).select(name.alias("column"), "value", "count")


def _plain(table: DataFrame, col_names, method, suffix: str = "") -> DataFrame:
    """A method that reads names as paths, called on plain aliases; its result has the exact names again."""
    names = _names(table, col_names)
    found = method(table.select(*[col(n).alias(f"_c{i}") for i, n in enumerate(names)]))
    back = {f"_c{i}{suffix}": n + suffix for i, n in enumerate(names)}
    return found.toDF(*[back.get(c, c) for c in found.columns])


def _grouping_sets(table: DataFrame, sets, cols=None) -> DataFrame:
    cols = cols or sorted({c for s in sets for c in s}, key=table.columns.index)
    return table.groupingSets([list(s) for s in sets], *cols).count()


PASS_THROUGH = {
    "select": lambda t, c: t.select(*_cols(t, c)),
    "selectExpr": lambda t, c: t.selectExpr(*_names(t, c)),
    "describe": lambda t, c: _plain(t, c, lambda p: p.describe()),
    "summary": lambda t, c, *stats: _plain(t, c, lambda p: p.summary(*stats)),
    "dropDuplicates": lambda t, c: t.dropDuplicates(_names(t, c)),
    "drop_duplicates": lambda t, c: t.dropDuplicates(_names(t, c)),
    "orderBy": lambda t, c, ascending=True: t.orderBy(*_cols(t, c), ascending=ascending),
    "sort": lambda t, c, ascending=True: t.sort(*_cols(t, c), ascending=ascending),
    "sortWithinPartitions": lambda t, c, ascending=True: t.sortWithinPartitions(*_cols(t, c), ascending=ascending),
    "groupBy": lambda t, c: t.groupBy(*_cols(t, c)).count(),
    "groupby": lambda t, c: t.groupBy(*_cols(t, c)).count(),
    "cube": lambda t, c: t.cube(*_cols(t, c)).count(),
    "rollup": lambda t, c: t.rollup(*_cols(t, c)).count(),
    "groupingSets": _grouping_sets,
    "freqItems": lambda t, c, support=None: _plain(t, c, lambda p: p.freqItems(p.columns, support), "_freqItems"),
    "frequentItems": lambda t, c, support=0.01: frequent_items(t, c, support),
    "percentile": lambda t, c, probabilities=(0.25, 0.5, 0.75): ranks.quantiles(t, _names(t, c), probabilities, interpolate=True),
    "approxQuantile": lambda t, c, probabilities=(0.25, 0.5, 0.75), relativeError=0.01: quantiles(
        t, c, probabilities, relativeError
    ),
    "unpivot": lambda t, ids, values, variableColumnName="variable", valueColumnName="value": t.unpivot(
        _names(t, ids), values if values is None else _names(t, values), variableColumnName, valueColumnName
    ),
    "melt": lambda t, ids, values, variableColumnName="variable", valueColumnName="value": t.unpivot(
        _names(t, ids), values if values is None else _names(t, values), variableColumnName, valueColumnName
    ),
}
