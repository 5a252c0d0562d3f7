"""Pairs of columns above a threshold, without forming the pairs below it.

*Signatures.* Two signatures of n minima that agree in more than a share t of
them differ in at most d places. Dealt out over more than d bands, at most d
bands hold a difference, so the signatures agree in all but d bands. Let all bands
of all signatures be in one order, those found in few signatures first: then
the two share a band among the first d + 1 of each (prefix filter), and columns
that do not are below the threshold. Twice d + 1 bands are made, so that a
minimum that very many columns share comes last and is not met, and the higher
the threshold, the longer the bands. Columns with equal signatures are one class;
a hundred copies of a column meet as one, and are listed one by one only in
pairs that are part of the result.

*Exact sets.* Let the values be in one order, those held by few columns first.
Sets with a Jaccard similarity of t or more share at least ``ceil(t * |A|)``
values, so their first common value is among the first ``|A| - ceil(t * |A|) + 1``
of A, and likewise of B (prefix filter). Values of one column only fill
prefixes and never meet anything. Where a prefix ends is read off a count per
column, column frequency and slice of the hashes, and whole slices are taken,
so no column is ever sorted and a longer prefix loses nothing. The candidates are
then counted exactly over the distinct sets of columns that hold a value.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 256


# ------------------------------------------------------------------ signatures


def least_agreement(hashnum: int, threshold: float) -> int:
    """The smallest number of agreeing minima that is above the threshold (``hashnum + 1``: none is)."""
    return next((m for m in range(hashnum + 1) if m / float(hashnum) > threshold), hashnum + 1)


def bands_of(hashnum: int, threshold: float) -> tuple[list[int], int]:
    """The band of every hash function, and how many of a signature's bands are met."""
    met = min(hashnum, hashnum - least_agreement(hashnum, threshold) + 1)
    bands = min(hashnum, 2 * max(1, met))
    return [i * bands // hashnum for i in range(hashnum)], met


def column_signatures(sig: DataFrame) -> DataFrame:
    """One row per column: ``minima`` and their row counts ``cnts`` in order of the hash function, and 128 bits of the minima, ``id``."""
    listed = F.array_sort(F.collect_list(F.struct("hash_index", "hash_value", "min_hash_count")))
    rows = sig.groupBy("table_index", "col_name").agg(listed.alias("s"))
    minima = F.col("s.hash_value")
    return rows.select(
        "table_index", "col_name", minima.alias("minima"), F.col("s.min_hash_count").alias("cnts"),
        F.struct(F.xxhash64(minima).alias("x"), F.xxhash64(minima, F.lit(1)).alias("y")).alias("id"),
    )


def candidate_classes(classes: DataFrame, hashnum: int, threshold: float) -> DataFrame:
    """``a_id, b_id``: pairs of different signatures that share one of their rarest bands."""
    bands, met = bands_of(hashnum, threshold)
    keys = [
        F.struct(F.lit(k).alias("band"), F.xxhash64(F.slice("minima", bands.index(k) + 1, bands.count(k))).alias("key"))
        for k in range(bands[-1] + 1)
    ]
    banded = classes.select("id", F.inline(F.array(*keys)))
    held = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("id").orderBy("df", "band", "key")  # a row per band
    ranked = banded.join(held, ["band", "key"]).withColumn("nth", F.row_number().over(order))
    first = ranked.where((F.col("nth") <= met) & (F.col("df") > 1))
    a = first.select(F.col("id").alias("a_id"), "band", "key")
    b = first.select(F.col("id").alias("b_id"), "band", "key")
    return a.join(b, ["band", "key"]).where(F.col("a_id") < F.col("b_id")).select("a_id", "b_id").distinct()


def agreement(x, y):
    """How many places of two arrays of equal length are equal."""
    return F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda e: e))


def _share(x, y, test, hashnum: int):
    return F.size(F.filter(F.zip_with(x, y, test), lambda e: e)) / F.lit(float(hashnum))


def pairs_above(sig: DataFrame, hashnum: int, threshold: float, containing_check: bool = False) -> DataFrame:
    """Pairs of columns of different tables (``at_ind < bt_ind``) with a signature similarity above ``threshold``.

    The columns and values of ``match_pairs``; pairs at or below the threshold
    are formed only where they share one of their rarest bands.
    """
    columns = column_signatures(sig)
    classes = columns.groupBy("id").agg(F.any_value("minima").alias("minima"))
    of = lambda p: classes.select(F.col("id").alias(f"{p}_id"), F.col("minima").alias(f"{p}_minima"))
    x, y = F.col("a_minima"), F.col("b_minima")
    met = candidate_classes(classes, hashnum, threshold).join(of("a"), "a_id").join(of("b"), "b_id")
    near = met.where(agreement(x, y) >= least_agreement(hashnum, threshold)).select("a_id", "b_id")
    # Columns of two classes come in either order of their tables; a class is also met with itself.
    both = near.unionByName(near.select(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id")))
    if threshold < 1:
        both = both.unionByName(classes.select(F.col("id").alias("a_id"), F.col("id").alias("b_id")))
    side = lambda p: columns.select(
        F.col("id").alias(f"{p}_id"), F.col("table_index").alias(f"{p}t_ind"), F.col("col_name").alias(f"{p}c_name"),
        F.col("minima").alias(f"{p}_minima"), F.col("cnts").alias(f"{p}_cnts"),
    )
    pairs = both.join(side("a"), "a_id").join(side("b"), "b_id").where(F.col("at_ind") < F.col("bt_ind"))
    products = F.zip_with(
        F.arrays_zip("a_minima", "a_cnts"), F.arrays_zip("b_minima", "b_cnts"),
        lambda p, q: F.when(p["a_minima"] == q["b_minima"], (p["a_cnts"] * q["b_cnts"]).cast("double")),
    )
    held = F.filter(products, lambda e: e.isNotNull())
    total = F.aggregate(held, F.lit(0.0), lambda s, e: s + e)
    out = [
        "at_ind", "ac_name", "bt_ind", "bc_name",
        (total / F.size(held)).alias("aj_contribution"),
        (agreement(x, y) / F.lit(float(hashnum))).alias("similarity"),
    ]
    if containing_check:
        out += [
            _share(x, y, lambda p, q: p < q, hashnum).alias("A_contain_B_sim"),
            _share(x, y, lambda p, q: p > q, hashnum).alias("B_contain_A_sim"),
        ]
    return pairs.select(*out)


# ------------------------------------------------------------------ exact sets


def column_postings(keys: DataFrame) -> DataFrame:
    """``cols, place``: per distinct value the ascending ids of the columns that hold it, and its slice of the hashes.

    The value and column are made distinct before the shuffle on the value, so
    a hot value costs a row per column; a list is as long as there are columns.
    """
    held = keys.groupBy("crc", "fp", "col_id").agg(F.lit(1).alias("one"))
    lists = held.groupBy("crc", "fp").agg(F.array_sort(F.collect_list("col_id")).alias("cols"))
    return lists.select("cols", F.pmod(F.xxhash64("crc", "fp"), F.lit(SLICES)).cast("int").alias("place"))


def counted_sets(postings: DataFrame) -> DataFrame:
    """``cols, place, n``: values per set of columns and slice; all later steps read only these."""
    return postings.groupBy("cols", "place").agg(F.count(F.lit(1)).alias("n"))


def prefixes(counted: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(col_id, cols, place)`` of each column's prefix, and ``(col_id, size)``.

    The order of the values is (number of columns, slice); the prefix ends with
    the slice that holds value ``size - ceil(threshold * size) + 1``.
    """
    member = counted.select(F.explode("cols").alias("col_id"), F.size("cols").alias("df"), "cols", "place", "n")
    steps = member.groupBy("col_id", "df", "place").agg(F.sum("n").alias("n"))
    sizes = steps.groupBy("col_id").agg(F.sum("n").cast("bigint").alias("size"))
    # A row per column, frequency and slice: of the size of the schema, not of the data.
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("col_id").orderBy("df", "place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # A rounding error may only make the prefix longer.
    needed = F.ceil(F.col("size") * F.lit(threshold) * F.lit(1 - 1e-12))
    within = steps.withColumn("before", before).join(sizes, "col_id").where(F.col("before") < F.col("size") - needed + 1)
    ends = within.select("col_id", "df", "place")
    return member.where("df > 1").join(ends, ["col_id", "df", "place"]).select("col_id", "cols", "place"), sizes


def exact_pairs_above(counted: DataFrame, threshold: float, table_of) -> DataFrame:
    """``a_id, b_id, n_inter, _na, _nb`` of the pairs of columns with a Jaccard similarity of ``threshold`` or more.

    ``counted`` is ``counted_sets``, ``table_of`` gives the table of a column
    id; only pairs of different tables are met. ``threshold`` is above 0.
    """
    if not threshold > 0:
        raise ValueError("the prefix filter needs a threshold above 0")
    prefix, sizes = prefixes(counted, threshold)
    a = prefix.select(F.col("col_id").alias("a_id"), "cols", "place")
    b = prefix.select(F.col("col_id").alias("b_id"), "cols", "place")
    na = sizes.select(F.col("col_id").alias("a_id"), F.col("size").alias("_na"))
    nb = sizes.select(F.col("col_id").alias("b_id"), F.col("size").alias("_nb"))
    met = a.join(b, ["cols", "place"]).where(table_of(F.col("a_id")) < table_of(F.col("b_id"))).select("a_id", "b_id").distinct()
    low, high = F.least("_na", "_nb"), F.greatest("_na", "_nb")
    slack = F.lit(math.nextafter(threshold * (1 - 1e-12), 0))
    candidates = met.join(na, "a_id").join(nb, "b_id").where(low >= high * slack)
    sets = counted.groupBy("cols").agg(F.sum("n").alias("n")).where(F.size("cols") > 1)
    shared = (
        sets.select("cols", "n", F.explode("cols").alias("a_id"))
        .join(candidates, "a_id")
        .where(F.array_contains("cols", F.col("b_id")))
        .groupBy("a_id", "b_id", "_na", "_nb")
        .agg(F.sum("n").cast("bigint").alias("n_inter"))
    )
    return shared.where(F.col("n_inter") >= (F.col("_na") + F.col("_nb") - F.col("n_inter")) * slack)


def smallest_kept(threshold: float, round_digits: int | None) -> float:
    """The similarity from which pairs can still be above ``threshold`` once rounded."""
    return threshold if round_digits is None else threshold - 0.5 * 10.0**-round_digits
