"""Join-path discovery between string columns of different tables.

Signatures are columns x hashnum rows whatever the data size, so every
join here is between schema-sized frames; Spark (AQE) decides at run
time whether a side is small enough to broadcast. The only data-sized
steps are the signature scan and, for the exact paths, one aggregation
over distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.hashing import (
    DEFAULT_HASHNUM,
    DEFAULT_SEED,
    HashCoefficients,
    crc32_of,
    fingerprint_of,
    hash_coefficients,
)
from tablescout.functions.schema import col, field_type, string_columns
from tablescout.operators import similarity as similar
from tablescout.operators.signature import (
    column_digest,
    LongForm,
    long_form,
    materialize,
    signature_from_digest,
    string_long_form,
)

PAIR_KEYS = ["at_ind", "ac_name", "bt_ind", "bc_name"]

_PAIR_FIELDS = [
    T.StructField("at_ind", T.IntegerType()),
    T.StructField("ac_name", T.StringType()),
    T.StructField("bt_ind", T.IntegerType()),
    T.StructField("bc_name", T.StringType()),
]


def path_schema(containing_check: bool = False, with_size: bool = False) -> T.StructType:
    fields = list(_PAIR_FIELDS) + [
        T.StructField("aj_contribution", T.DoubleType()),
        T.StructField("similarity", T.DoubleType()),
    ]
    if containing_check:
        fields += [T.StructField("A_contain_B_sim", T.DoubleType()), T.StructField("B_contain_A_sim", T.DoubleType())]
    if with_size:
        fields.append(T.StructField("aj_size", T.DoubleType()))
    return T.StructType(fields)


NAIVE_SCHEMA = T.StructType(list(_PAIR_FIELDS) + [T.StructField("similarity", T.DoubleType())])


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _side(sig: DataFrame, p: str) -> DataFrame:
    return sig.select(
        F.col("table_index").alias(f"{p}t_ind"),
        F.col("col_name").alias(f"{p}c_name"),
        F.col("hash_index").alias(f"{p}h_ind"),
        F.col("hash_value").alias(f"{p}h_val"),
        F.col("min_hash_count").alias(f"{p}h_mincount"),
    )


def _ordered(result: DataFrame) -> DataFrame:
    """Most similar first; ties broken by the pair keys so the order is total."""
    return result.orderBy(F.desc("similarity"), *PAIR_KEYS)


def match_pairs(
    sig_a: DataFrame,
    sig_b: DataFrame,
    hashnum: int,
    threshold: float = 0,
    cross_table: bool = True,
    containing_check: bool = False,
) -> DataFrame:
    """Pairs (A, B) whose signatures share at least one minimum, with their scores.

    ``similarity`` = share of hash functions whose minima agree;
    ``aj_contribution`` = mean product of the multiplicities at agreeing minima.
    With ``containing_check`` the surviving pairs are compared on all
    hash functions: ``A_contain_B_sim`` = share where min(A) < min(B),
    ``B_contain_A_sim`` the reverse (the three shares add up to 1).
    """
    a = _side(sig_a, "a")
    b = _side(sig_b, "b")
    cond = (a.ah_ind == b.bh_ind) & (a.ah_val == b.bh_val)
    if cross_table:
        cond = cond & (a.at_ind < b.bt_ind)
    matched = a.join(b, cond)
    n = F.lit(float(hashnum))
    if not containing_check:
        scored = matched.groupBy(*PAIR_KEYS).agg(
            F.avg(F.col("ah_mincount") * F.col("bh_mincount")).alias("aj_contribution"),
            (F.count(F.lit(1)) / n).alias("similarity"),
        )
        return scored.where(F.col("similarity") > F.lit(threshold))
    # Candidate pairs only (at least one agreeing minimum): never all column pairs.
    candidates = matched.select(*PAIR_KEYS).distinct()
    with_a = candidates.join(a, ["at_ind", "ac_name"])
    # hash_index is part of the equi-join key: one b row per (pair, hash function).
    detail = with_a.join(
        b,
        (with_a.bt_ind == b.bt_ind) & (with_a.bc_name == b.bc_name) & (with_a.ah_ind == b.bh_ind),
    ).select(*[with_a[k] for k in PAIR_KEYS], "ah_val", "bh_val", "ah_mincount", "bh_mincount")
    eq = F.col("ah_val") == F.col("bh_val")
    scored = detail.groupBy(*PAIR_KEYS).agg(
        F.avg(F.when(eq, F.col("ah_mincount") * F.col("bh_mincount"))).alias("aj_contribution"),
        (F.count_if(eq) / n).alias("similarity"),
        (F.count_if(F.col("ah_val") < F.col("bh_val")) / n).alias("A_contain_B_sim"),
        (F.count_if(F.col("ah_val") > F.col("bh_val")) / n).alias("B_contain_A_sim"),
    )
    return scored.where(F.col("similarity") > F.lit(threshold))


def _with_size(result: DataFrame, sig: DataFrame) -> DataFrame:
    """Add ``aj_size = J/(1+J) * aj_contribution * (nA + nB)``.

    ``n_distinct`` rides on every signature row; one row per column is kept.
    """
    counts = sig.where(F.col("hash_index") == 0).select("table_index", "col_name", "n_distinct")
    na = counts.select(
        F.col("table_index").alias("at_ind"), F.col("col_name").alias("ac_name"), F.col("n_distinct").alias("_na")
    )
    nb = counts.select(
        F.col("table_index").alias("bt_ind"), F.col("col_name").alias("bc_name"), F.col("n_distinct").alias("_nb")
    )
    j = F.col("similarity")
    sized = result.join(na, ["at_ind", "ac_name"], "left").join(nb, ["bt_ind", "bc_name"], "left")
    return sized.withColumn(
        "aj_size", j / (F.lit(1.0) + j) * F.col("aj_contribution") * (F.col("_na") + F.col("_nb")).cast("double")
    ).drop("_na", "_nb")


def _finish(result: DataFrame, containing_check: bool, with_size: bool) -> DataFrame:
    cols = PAIR_KEYS + ["aj_contribution", "similarity"]
    if containing_check:
        cols += ["A_contain_B_sim", "B_contain_A_sim"]
    if with_size:
        cols.append("aj_size")
    return _ordered(result.select(*cols))


def joining_path_hash(
    tables: Sequence[DataFrame],
    threshold: float = 0,
    table_ind: Sequence[int] | None = None,
    hashnum: int = DEFAULT_HASHNUM,
    containing_check: bool = False,
    seed: int | None = DEFAULT_SEED,
    with_size: bool = False,
    coeffs: HashCoefficients | None = None,
    materialized: bool = True,
    signature: DataFrame | None = None,
) -> DataFrame:
    """All cross-table string-column pairs ranked by MinHash Jaccard similarity.

    At threshold 0 that is every pair that shares a minimum: the result itself
    can hold as many rows as there are pairs of columns. Above 0 the pairs
    below the threshold are not formed (``similarity.pairs_above``).

    ``signature`` may be a precomputed ``table_set_signature`` of the same
    tables and hash family (with ``n_distinct`` when sizes are wanted).
    """
    coeffs = coeffs or hash_coefficients(hashnum, seed)
    chosen = list(range(len(tables)) if table_ind is None else table_ind)
    chosen = [i for i in chosen if string_columns(tables[i])]
    if not chosen:
        raise ValueError("no table has a categorical column, that is one of strings")
    if signature is not None:
        sig = signature.where(F.col("table_index").isin(chosen)) if table_ind is not None else signature
    else:
        long = string_long_form(tables, chosen)
        sig = signature_from_digest(column_digest(long, with_values=with_size, wide=coeffs.wide), coeffs, long)
        if materialized:
            sig = materialize(sig)
    if threshold > 0:
        result = similar.pairs_above(sig, coeffs.hashnum, threshold, containing_check)
    else:
        result = match_pairs(sig, sig, coeffs.hashnum, threshold, True, containing_check)
    if with_size:
        result = _with_size(result, sig)
    return _finish(result, containing_check, with_size)


def joining_path_hash_specific(
    tables: Sequence[DataFrame],
    table_ind: int,
    col_name: str,
    threshold: float = 0,
    hashnum: int = DEFAULT_HASHNUM,
    containing_check: bool = False,
    seed: int | None = DEFAULT_SEED,
    with_size: bool = False,
    coeffs: HashCoefficients | None = None,
    materialized: bool = True,
    signature: DataFrame | None = None,
) -> DataFrame:
    """Candidates in every other table for one string column ``tables[table_ind][col_name]``."""
    if not isinstance(field_type(tables[table_ind], col_name), T.StringType):
        raise ValueError(f"join paths start from a string column; {col_name!r} is none")
    coeffs = coeffs or hash_coefficients(hashnum, seed)
    others = [i for i in range(len(tables)) if i != table_ind and string_columns(tables[i])]
    spark = tables[table_ind].sparkSession
    if not others:
        return _empty(spark, path_schema(containing_check, with_size))
    if signature is not None:
        sig = signature
    else:
        spec = [(table_ind, tables[table_ind], [col_name])] + [
            (i, tables[i], string_columns(tables[i])) for i in others
        ]
        long = long_form(spec)
        sig = signature_from_digest(column_digest(long, with_values=with_size, wide=coeffs.wide), coeffs, long)
        if materialized:
            sig = materialize(sig)
    is_a = (F.col("table_index") == F.lit(table_ind)) & (F.col("col_name") == F.lit(col_name))
    # The A side is exactly hashnum rows: a proven bound, so broadcast it.
    sig_a = F.broadcast(sig.where(is_a))
    sig_b = sig.where(F.col("table_index") != F.lit(table_ind))
    result = match_pairs(sig_a, sig_b, coeffs.hashnum, threshold, False, containing_check)
    if with_size:
        result = _with_size(result, sig)
    return _finish(result, containing_check, with_size)


def multi_set_resemble(
    tables: Sequence[DataFrame],
    threshold: float = 0,
    table_ind: Sequence[int] | None = None,
    hashnum: int = DEFAULT_HASHNUM,
    containing_check: bool = False,
    seed: int | None = DEFAULT_SEED,
    coeffs: HashCoefficients | None = None,
    signature: DataFrame | None = None,
) -> DataFrame:
    """``joining_path_hash`` plus ``aj_size``, the estimated inner-join row count."""
    return joining_path_hash(
        tables, threshold, table_ind, hashnum, containing_check, seed, True, coeffs, signature=signature
    )


def multi_set_resemble_specific(
    tables: Sequence[DataFrame],
    table_ind: int,
    col_name: str,
    threshold: float = 0,
    hashnum: int = DEFAULT_HASHNUM,
    containing_check: bool = False,
    seed: int | None = DEFAULT_SEED,
    coeffs: HashCoefficients | None = None,
    signature: DataFrame | None = None,
) -> DataFrame:
    return joining_path_hash_specific(
        tables, table_ind, col_name, threshold, hashnum, containing_check, seed, True, coeffs, signature=signature
    )


def table_set_signature(
    tables: Sequence[DataFrame],
    hashnum: int = DEFAULT_HASHNUM,
    seed: int | None = DEFAULT_SEED,
    coeffs: HashCoefficients | None = None,
    materialized: bool = True,
) -> DataFrame:
    """Signature (with ``n_distinct``) of every string column of every table.

    One scan per table; reusable by all the path functions above through
    ``signature=``, so a session exploring one table set scans it once.
    """
    coeffs = coeffs or hash_coefficients(hashnum, seed)
    long = string_long_form(tables)
    if long is None:
        raise ValueError("no table has a categorical column, that is one of strings")
    sig = signature_from_digest(column_digest(long, with_values=True, wide=coeffs.wide), coeffs, long)
    return materialize(sig) if materialized else sig


# ---------------------------------------------------------------- exact paths


def _value_keys(long: LongForm, null_as_value: bool) -> DataFrame:
    """``(col_id, crc, fp)`` per non-NULL value (NULL is its own value, crc -1, when ``null_as_value``)."""
    v = F.col("value")
    if null_as_value:
        crc = F.when(v.isNull(), F.lit(-1).cast("bigint")).otherwise(crc32_of(v))
        fp = F.when(v.isNull(), F.lit(0).cast("bigint")).otherwise(fingerprint_of(v))
        src = long.df
    else:
        crc, fp = crc32_of(v), fingerprint_of(v)
        src = long.df.where(v.isNotNull())
    return src.select("col_id", crc.alias("crc"), fp.alias("fp"))


def column_sets(keys: DataFrame, n_columns: int) -> DataFrame:
    """``(cols, n_values)``: how many distinct values are held by exactly the columns ``cols``.

    One shuffle keyed by the value (crc, xxhash). The set of columns holding
    a value is built as bit masks, one ``bigint`` per 64 columns, with
    ``bit_or``: a fixed-width HashAggregate buffer with map-side partial
    aggregation, so a hot value costs one row per map task and no object
    aggregation is needed. A second, much smaller aggregation counts values
    per distinct mask; the masks are then expanded to sorted column-id arrays.
    """
    words = max(1, (n_columns + 63) // 64)
    cid = F.col("col_id")
    masks = [
        F.bit_or(
            F.when((cid >= 64 * k) & (cid < 64 * (k + 1)), F.expr(f"shiftleft(1L, col_id - {64 * k})"))
            .otherwise(F.lit(0).cast("bigint"))
        ).alias(f"w{k}")
        for k in range(words)
    ]
    per_value = keys.groupBy("crc", "fp").agg(*masks)
    per_set = per_value.groupBy(*[f"w{k}" for k in range(words)]).agg(F.count(F.lit(1)).alias("n_values"))
    ids = [
        F.expr(f"transform(filter(sequence(0, 63), i -> (shiftright(w{k}, i) & 1) = 1), i -> i + {64 * k})")
        for k in range(words)
    ]
    return per_set.select((F.concat(*ids) if len(ids) > 1 else ids[0]).alias("cols"), "n_values")


def pair_counts(sets: DataFrame) -> DataFrame:
    """``(a_id, b_id, n)`` for a_id <= b_id: shared distinct values; the diagonal is each column's count.

    Pairs are emitted once per distinct column set, never once per value, and
    row by row: no row holds all pairs of a set.
    """
    firsts = sets.select("n_values", "cols", F.posexplode("cols").alias("at", "a_id"))
    later = F.slice("cols", F.col("at") + 1, F.size("cols"))  # a_id itself included
    pairs = firsts.select("n_values", "a_id", F.explode(later).alias("b_id"))
    return pairs.groupBy("a_id", "b_id").agg(F.sum("n_values").cast("bigint").alias("n"))


def exact_pair_counts(long: LongForm, null_as_value: bool = False, materialized: bool = True) -> DataFrame:
    """``(a_id, b_id, n)`` shared distinct values per column pair (diagonal: distinct count).

    At most columns²/2 + columns rows; checkpointed so later branches (and
    later calls, see ``TableSet``) never rescan the tables.
    """
    counts = pair_counts(column_sets(_value_keys(long, null_as_value), len(long.columns)))
    return materialize(counts) if materialized else counts


def exact_jaccard(
    long: LongForm, null_as_value: bool, materialized: bool = True, counts: DataFrame | None = None
) -> DataFrame:
    """``(a_id, b_id, n_inter, _na, _nb)`` for every pair of distinct columns sharing a value."""
    if counts is None:
        counts = exact_pair_counts(long, null_as_value, materialized)
    diag = counts.where(F.col("a_id") == F.col("b_id"))
    na = diag.select(F.col("a_id"), F.col("n").alias("_na"))
    nb = diag.select(F.col("b_id"), F.col("n").alias("_nb"))
    inter = counts.where(F.col("a_id") < F.col("b_id")).withColumnRenamed("n", "n_inter")
    return inter.join(na, "a_id").join(nb, "b_id")


def joining_path_naive(
    tables: Sequence[DataFrame],
    threshold: float = 0,
    table_ind: Sequence[int] | None = None,
    null_as_value: bool = False,
    round_digits: int | None = None,
    materialized: bool = True,
    pair_counts_of: tuple[LongForm, DataFrame] | None = None,
) -> DataFrame:
    """Exact Jaccard |A∩B|/|A∪B| of every cross-table string-column pair that shares a value.

    Above threshold 0 the pairs below it are not formed (``similarity.exact_pairs_above``).
    ``pair_counts_of`` may hold a precomputed ``(long form, exact_pair_counts)``
    of all string columns of ``tables`` with the same ``null_as_value``.
    """
    chosen = list(range(len(tables)) if table_ind is None else table_ind)
    chosen = [i for i in chosen if string_columns(tables[i])]
    if not chosen:
        raise ValueError("no table has a categorical column, that is one of strings")
    if pair_counts_of is not None:
        long, counts = pair_counts_of
        scored = exact_jaccard(long, null_as_value, counts=counts)
        if table_ind is not None:
            keep = F.array(*[F.lit(i) for i in chosen])
            a_t, _ = long.named(F.col("a_id"))
            b_t, _ = long.named(F.col("b_id"))
            scored = scored.where(F.array_contains(keep, a_t) & F.array_contains(keep, b_t))
    else:
        long = string_long_form(tables, chosen)
        least = similar.smallest_kept(threshold, round_digits)
        if least > 0:
            counted = similar.counted_sets(similar.column_postings(_value_keys(long, null_as_value)))
            counted = materialize(counted) if materialized else counted
            scored = similar.exact_pairs_above(counted, least, lambda c: long.named(c)[0])
        else:
            scored = exact_jaccard(long, null_as_value, materialized)
    a_t, a_c = long.named(F.col("a_id"))
    b_t, b_c = long.named(F.col("b_id"))
    sim = F.col("n_inter") / (F.col("_na") + F.col("_nb") - F.col("n_inter")).cast("double")
    if round_digits is not None:
        sim = F.round(sim, round_digits)
    result = (
        scored.select(
            a_t.alias("at_ind"), a_c.alias("ac_name"), b_t.alias("bt_ind"), b_c.alias("bc_name"), sim.alias("similarity")
        )
        .where((F.col("at_ind") < F.col("bt_ind")) & (F.col("similarity") != 0) & (F.col("similarity") > F.lit(threshold)))
    )
    return _ordered(result)


def _two_column_long(tables, t1, t2, cname1, cname2) -> LongForm:
    for t, c in ((t1, cname1), (t2, cname2)):
        if c not in tables[t].columns:
            raise ValueError(f"cannot resolve column {c!r} in table {t}")
    # Tag the sides 0 and 1 so a column compared with itself still works.
    return long_form([(0, tables[t1], [cname1]), (1, tables[t2], [cname2])], value_expr=lambda c: col(c).cast("string"))


def jaccard_exact_frame(tables, t1, t2, cname1, cname2, null_as_value: bool = False) -> DataFrame:
    """One row ``similarity`` = |A∩B| / |A∪B| (NULL when both are empty)."""
    # col_id is the side (0 or 1); a value's set is [0], [1] or [0, 1].
    sets = column_sets(_value_keys(_two_column_long(tables, t1, t2, cname1, cname2), null_as_value), 2)
    return sets.agg(
        (
            F.sum(F.when(F.size("cols") == 2, F.col("n_values")).otherwise(0))
            / F.nullif(F.sum("n_values"), F.lit(0)).cast("double")
        ).alias("similarity")
    )


def jaccard_minhash_frame(
    tables, t1, t2, cname1, cname2, hashnum: int = DEFAULT_HASHNUM, seed: int | None = DEFAULT_SEED
) -> DataFrame:
    """One row ``similarity`` = share of hash functions whose minima agree; NULL if both columns are empty."""
    coeffs = hash_coefficients(hashnum, seed)
    long = _two_column_long(tables, t1, t2, cname1, cname2)
    sig = signature_from_digest(column_digest(long), coeffs, long)
    # Both sides' minima meet in one group per hash function: no join needed.
    per_hash = sig.groupBy("hash_index").agg(
        ((F.count(F.lit(1)) == 2) & (F.min("hash_value") == F.max("hash_value"))).alias("agree"),
        F.count("hash_value").alias("seen"),
    )
    share = F.count_if("agree") / F.lit(float(coeffs.hashnum))
    return per_hash.agg(F.when(F.sum("seen") > 0, share).alias("similarity"))


def get_jaccard_similarity(
    tables, t1, t2, cname1, cname2, hashnum: int = DEFAULT_HASHNUM, option: str = "min_hash",
    seed: int | None = DEFAULT_SEED, null_as_value: bool = False, round_digits: int | None = None,
) -> float | None:
    """Scalar Jaccard of two columns (``option`` is ``'min_hash'`` or ``'naive'``).

    ``round_digits=2`` reproduces the original display rounding (Python's ``round``).
    """
    if option == "min_hash":
        frame = jaccard_minhash_frame(tables, t1, t2, cname1, cname2, hashnum, seed)
    elif option == "naive":
        frame = jaccard_exact_frame(tables, t1, t2, cname1, cname2, null_as_value)
    else:
        raise ValueError(f"unknown option {option!r}; choose 'min_hash' or 'naive'")
    value = frame.first()["similarity"]
    return value if value is None or round_digits is None else round(value, round_digits)


def hash_collision_check(
    tables: Sequence[DataFrame],
    hashnum: int = DEFAULT_HASHNUM,
    table_ind: Sequence[int] | None = None,
    seed: int | None = DEFAULT_SEED,
) -> DataFrame:
    """Per column and hash function: distinct values vs distinct hash values.

    ``collisions = n_values - n_hashes``; any collision comes from crc32
    itself, since each hash is injective on crc values.
    """
    coeffs = hash_coefficients(hashnum, seed)
    chosen = list(range(len(tables)) if table_ind is None else table_ind)
    long = string_long_form(tables, [i for i in chosen if string_columns(tables[i])])
    if long is None:
        raise ValueError("no table has a categorical column, that is one of strings")
    # A hash function maps different crcs to different values, so each one has as many as there are crcs:
    # they are counted once, and the hash index is attached to the one row per column.
    per_column = column_digest(long, with_values=True).groupBy("col_id").agg(
        F.sum("n_values").cast("bigint").alias("n_values"), F.count(F.lit(1)).alias("n_hashes")
    )
    counted = per_column.select("*", F.explode(F.sequence(F.lit(0), F.lit(coeffs.hashnum - 1))).alias("hash_index"))
    return counted.select(
        *long.named(), "hash_index", "n_values", "n_hashes", (F.col("n_values") - F.col("n_hashes")).alias("collisions")
    )
