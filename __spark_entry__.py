"""

Every query reads the driver's tables whole (keys cast to string where
join discovery needs them, as FIXTURES.md suggests). The oracle SQL is an
independent formulation in DuckDB: MinHash there recomputes crc32 over
UTF-8 bytes with a list_reduce and the hash with HUGEINT arithmetic, and
the containment shares follow the original three-join formulation.
Floating results whose value depends on summation order are rounded to
6 decimals in both engines; everything else is compared as computed.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.functions.hashing import PRIME, WIDE_PRIME, hash_coefficients
from tablescout.operators import aggregates, discovery, histogram, joinpaths, outliers, passthrough, profile, ranks, sketches
from tablescout.operators import signature as sig_ops
from tablescout.plans.tableset import TableProfiler
from tablescout.session import checkpoint_dir
from tablescout.sources.readers import cast_categorical, handle_input, read_table

SEED = 42
HASHNUM = 100

# Join-discovery table set: (table, key columns cast to string). Position = table index.
TABLE_SET = [
    ("region", ["r_regionkey"]),
    ("nation", ["n_nationkey", "n_regionkey"]),
    ("customer", ["c_custkey", "c_nationkey"]),
    ("supplier", ["s_suppkey", "s_nationkey"]),
    ("part", ["p_partkey"]),
    ("orders", ["o_orderkey", "o_custkey"]),
    ("lineitem", ["l_orderkey", "l_partkey", "l_suppkey"]),
    ("events", []),
    ("documents", []),
    ("pages", []),
    ("benchmark", []),
    ("labels", []),
    ("conversations", []),
    ("embeddings", []),
]
# Native string columns of each table (the parquet schemas in FIXTURES.md).
STRING_COLUMNS = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "labels": [],
    "conversations": ["role", "text"],
    "embeddings": [],
}
TPCH = 7  # the first seven tables: the star schema


_READ: dict[tuple, tuple[SparkSession, DataFrame]] = {}


def _read(spark: SparkSession, sf_dir: str, name: str, cast=()) -> DataFrame:
    """The table as a lazy DataFrame; its plan (footer read once) is reused within a session."""
    key = (sf_dir, name, tuple(cast))
    hit = _READ.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, read_table(spark, f"{sf_dir}/{name}.parquet", cast))
        _READ[key] = hit
    return hit[1]


def _tables(spark: SparkSession, sf_dir: str, upto: int | None = None) -> list[DataFrame]:
    return [_read(spark, sf_dir, n, c) for n, c in TABLE_SET[:upto]]


# ------------------------------------------------------------------ Spark side


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: join-size estimates for every string-column pair of all sf0.001 tables."""
    return joinpaths.multi_set_resemble(_tables(spark, "/root/testdata/sf0.001"), threshold=0, seed=SEED)


def _round(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def _roundtrip(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Write ``part`` in ``fmt`` under the shared checkpoint folder and read it back."""
    src = _read(spark, sf_dir, "part")
    out = os.path.join(checkpoint_dir(spark), f"roundtrip-{uuid.uuid4().hex}.{fmt}")
    if fmt == "csv":
        src.write.csv(out, header=True)
    elif fmt == "txt":
        src.write.csv(out, header=True, sep="\t")
    else:
        src.write.json(out)
    return read_table(spark, out)


def _derived_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with derived NaN (negative balances) and NULL (one segment)."""
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_acctbal") > 9000, F.lit(None)).otherwise(F.col("c_acctbal")).alias("bal_nulls"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.col("c_nationkey"),
    )


try:  # optional parts of the library, and what they need
    from tablescout.llm.queries import ORACLE_SQL as _LLM_SQL
    from tablescout.llm.queries import QUERIES as _LLM_QUERIES
except ImportError:
    _LLM_SQL, _LLM_QUERIES = {}, {}
try:
    import corpus_pipeline as _pipeline
except ImportError:
    _pipeline = None


CENTERS = [[10.0, 910.0], [40.0, 990.0]]
MANY_CENTERS = [[float(5 * i % 53), 900.0 + 3.5 * i] for i in range(300)]
UNEVEN = [1000.0 + 7.5 * i * i for i in range(200)]


def _rank_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each sketched quantile is within the error it was asked for."""
    names, table = ["l_extendedprice", "l_quantity"], _read(spark, sf_dir, "lineitem")
    found = ranks.approximate_quantiles(table, names, [0.1, 0.5, 0.9], 0.01)
    return ranks.rank_errors(table, found, names).select("column", "prob", (F.col("error") <= 0.01).alias("within"))


def _sketch_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` profiled in two parts, open ones and the rest; the merged estimates against exact counts."""
    orders, store = _read(spark, sf_dir, "orders"), os.path.join(checkpoint_dir(spark), f"sketches-{uuid.uuid4().hex}")
    is_open = F.col("o_orderstatus").eqNullSafe("O")
    sketches.add_part(store, orders.where(is_open), "orders", "open")
    sketches.add_part(store, orders.where(~is_open), "orders", "rest")
    found = sketches.distinct_estimates(sketches.read_store(spark, store, ["orders"]))
    names = sketches.sketched_columns(orders)
    counted = profile.distinct_count(orders, names)
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("exact")) for n in names])
    both = found.join(counted.select(F.inline(rows)), "column")
    return both.select("column", "n_rows", "n_nulls", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("error")).alias("within"))


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables read as a set, one column of the first cast to text."""
    nation, region = handle_input(spark, [f"{sf_dir}/nation.parquet", f"{sf_dir}/region.parquet"], {0: ["n_nationkey"]})
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


def _dispatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One function by name over two tables of a set, one column list each."""
    tables = TableProfiler(spark, [f"{sf_dir}/{t}.parquet" for t in ("customer", "supplier")])
    customer, supplier = tables.single_column_evaluation("distinct_count", [0, 1], [["c_nationkey"], ["s_nationkey"]])
    value = lambda df: df.select(F.lit(df.columns[0]).alias("column"), F.col(df.columns[0]).alias("distinct"))
    return value(customer).union(value(supplier))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    jp = joinpaths
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # sources
        "cast_categorical": lambda s, d: cast_categorical(_read(s, d, "customer"), ["c_custkey", "c_nationkey", "nope"]),
        "csv_roundtrip": lambda s, d: _roundtrip(s, d, "csv"),
        "json_roundtrip": lambda s, d: _roundtrip(s, d, "json"),
        "txt_roundtrip": lambda s, d: _roundtrip(s, d, "txt"),
        # MinHash join discovery
        "minhash_signature": lambda s, d: sig_ops.multiple_table_signature(
            _tables(s, d), hash_coefficients(HASHNUM, SEED)
        ),
        "minhash_signature_wide": lambda s, d: sig_ops.multiple_table_signature(
            _tables(s, d), hash_coefficients(HASHNUM, SEED, wide=True)
        ),
        "multi_set_resemble_wide": lambda s, d: jp.multi_set_resemble(
            _tables(s, d), threshold=0, coeffs=hash_coefficients(HASHNUM, SEED, wide=True)
        ),
        "joining_path_hash": lambda s, d: jp.joining_path_hash(_tables(s, d), seed=SEED),
        "joining_path_hash_tpch": lambda s, d: jp.joining_path_hash(_tables(s, d, TPCH), threshold=0.05, seed=SEED),
        "joining_path_hash_containing": lambda s, d: jp.joining_path_hash(
            _tables(s, d), containing_check=True, seed=SEED
        ),
        "joining_path_hash_specific": lambda s, d: jp.joining_path_hash_specific(
            _tables(s, d), 5, "o_custkey", seed=SEED
        ),
        "joining_path_hash_specific_containing": lambda s, d: jp.joining_path_hash_specific(
            _tables(s, d), 6, "l_suppkey", containing_check=True, seed=SEED
        ),
        "multi_set_resemble": lambda s, d: jp.multi_set_resemble(_tables(s, d), threshold=0, seed=SEED),
        "multi_set_resemble_containing": lambda s, d: jp.multi_set_resemble(
            _tables(s, d), threshold=0.5, containing_check=True, seed=SEED
        ),
        "multi_set_resemble_specific": lambda s, d: jp.multi_set_resemble_specific(
            _tables(s, d), 6, "l_orderkey", seed=SEED
        ),
        "jaccard_minhash": lambda s, d: jp.jaccard_minhash_frame(_tables(s, d), 8, 10, "text", "text", HASHNUM, SEED),
        "jaccard_exact": lambda s, d: jp.jaccard_exact_frame(_tables(s, d), 2, 5, "c_custkey", "o_custkey"),
        "joining_path_naive": lambda s, d: jp.joining_path_naive(_tables(s, d)),
        "joining_path_hash_half": lambda s, d: jp.joining_path_hash(_tables(s, d), threshold=0.5, seed=SEED),
        "joining_path_naive_half": lambda s, d: jp.joining_path_naive(_tables(s, d), threshold=0.5),
        "joining_path_naive_some": lambda s, d: jp.joining_path_naive(_tables(s, d), threshold=0.01),
        "hash_collision_check": lambda s, d: jp.hash_collision_check(_tables(s, d), HASHNUM, seed=SEED),
        # profiling
        "describe_table": lambda s, d: profile.describe_table(_read(s, d, "orders")),
        "describe_long": lambda s, d: _round(
            profile.describe_long(_read(s, d, "lineitem")), ["mean", "stddev"]
        ),
        "value_count": lambda s, d: profile.value_count(_read(s, d, "orders"), ["o_orderpriority"])[0],
        "value_count_long": lambda s, d: profile.value_count_long(
            _read(s, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_linenumber"]
        ),
        "value_count_text": lambda s, d: profile.value_count_long(_read(s, d, "documents"), ["text", "lang"]),
        "cat_describe": lambda s, d: profile.cat_describe(_read(s, d, "customer", ["c_nationkey"])),
        "cat_describe_text": lambda s, d: profile.cat_describe(_read(s, d, "documents")),
        "distinct_count_exact": lambda s, d: profile.distinct_count(
            _read(s, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity"]
        ),
        "distinct_count_approx": lambda s, d: profile.distinct_count(
            _read(s, d, "lineitem"), ["l_orderkey", "l_partkey"], "approx"
        ),
        "sketch_store_check": _sketch_store,
        "nan_count": lambda s, d: profile.nan_count(_derived_missing(s, d), ["bal", "bal_nulls", "segment"]),
        "null_count": lambda s, d: profile.null_count(_derived_missing(s, d), ["bal", "bal_nulls", "segment"]),
        "missing_count": lambda s, d: profile.missing_count(_derived_missing(s, d), ["bal", "bal_nulls", "segment"]),
        # histograms
        "histogram_even": lambda s, d: histogram.histogram(_read(s, d, "lineitem"), "l_extendedprice", 10),
        "histogram_integer": lambda s, d: histogram.histogram(_read(s, d, "part"), ["p_size"], 7),
        "histogram_edges": lambda s, d: histogram.histogram(
            _read(s, d, "orders"), "o_totalprice", [0, 50000, 100000, 200000, 400000, 600000]
        ),
        "histogram_single_bin": lambda s, d: histogram.histogram(_read(s, d, "lineitem"), "l_discount", 1),
        "histogram_bigint": lambda s, d: histogram.histogram(
            _read(s, d, "orders").select((F.col("o_orderkey") + F.lit(2**53)).alias("big")), "big", [2**53, 2**53 + 1, 2**53 + 2, 2**53 + 1001, 2**60]
        ),
        "histogram_many_edges": lambda s, d: histogram.histogram(_read(s, d, "orders"), "o_totalprice", UNEVEN),
        # one-argument aggregates and pass-through methods
        "agg_numeric": lambda s, d: _round(
            aggregates.aggregate(_read(s, d, "lineitem"), "avg", ["l_quantity", "l_extendedprice", "l_discount"]),
            ["avg(l_extendedprice)", "avg(l_discount)"],
        ),
        "agg_stddev": lambda s, d: _round(
            aggregates.aggregate(_read(s, d, "customer"), "stddev", ["c_acctbal", "c_custkey"]),
            ["stddev(c_acctbal)", "stddev(c_custkey)"],
        ),
        "agg_skewness": lambda s, d: _round(
            aggregates.aggregate(_read(s, d, "orders"), "skewness", ["o_totalprice"]), ["skewness(o_totalprice)"]
        ),
        "agg_kurtosis": lambda s, d: _round(
            aggregates.aggregate(_read(s, d, "orders"), "kurtosis", ["o_totalprice"]), ["kurtosis(o_totalprice)"]
        ),
        "agg_integral_bits": lambda s, d: aggregates.aggregate(
            _read(s, d, "lineitem"), "bit_xor", ["l_orderkey", "l_linenumber"]
        ),
        "agg_boolean": lambda s, d: aggregates.aggregate(
            _read(s, d, "lineitem").select((F.col("l_quantity") > 49).alias("big"), (F.col("l_discount") >= 0).alias("nonneg")),
            "bool_and",
            ["big", "nonneg"],
        ),
        "agg_mode": lambda s, d: aggregates.aggregate(
            _read(s, d, "orders"), "mode", ["o_orderpriority", "o_orderstatus", "o_custkey"]
        ),
        "select_columns": lambda s, d: passthrough.PASS_THROUGH["select"](_read(s, d, "part"), ["p_partkey", "p_brand"]),
        "select_expr": lambda s, d: passthrough.PASS_THROUGH["selectExpr"](
            _read(s, d, "part"), ["p_partkey", "upper(p_brand) AS brand", "p_size * 2 AS double_size"]
        ),
        "dedup_columns": lambda s, d: passthrough.PASS_THROUGH["dropDuplicates"](
            _read(s, d, "lineitem"), ["l_returnflag", "l_linestatus"]
        ).select("l_returnflag", "l_linestatus"),
        "sort_columns": lambda s, d: passthrough.PASS_THROUGH["orderBy"](_read(s, d, "part"), ["p_size", "p_partkey"]),
        "cube_counts": lambda s, d: passthrough.PASS_THROUGH["cube"](_read(s, d, "lineitem"), ["l_returnflag", "l_linestatus"]),
        "rollup_counts": lambda s, d: passthrough.PASS_THROUGH["rollup"](
            _read(s, d, "orders"), ["o_orderstatus", "o_orderpriority"]
        ),
        "grouping_sets_counts": lambda s, d: passthrough.PASS_THROUGH["groupingSets"](
            _read(s, d, "customer"), [["c_mktsegment"], ["c_nationkey"], []]
        ),
        "unpivot_columns": lambda s, d: passthrough.PASS_THROUGH["unpivot"](
            _read(s, d, "part"), ["p_partkey"], ["p_size", "p_retailprice"]
        ),
        "quantiles_approx": lambda s, d: passthrough.PASS_THROUGH["approxQuantile"](
            _read(s, d, "lineitem"), ["l_extendedprice", "l_quantity"], probabilities=[0.1, 0.5, 0.9]
        ),
        "quantiles_fine": lambda s, d: passthrough.PASS_THROUGH["approxQuantile"](
            _read(s, d, "lineitem"), ["l_extendedprice", "l_quantity"], probabilities=[0.1, 0.25, 0.5, 0.9],
            relativeError=0.0,
        ),
        "quantiles_exact": lambda s, d: _round(passthrough.PASS_THROUGH["percentile"](
            _read(s, d, "lineitem"), ["l_extendedprice", "l_quantity", "l_orderkey"], probabilities=[0.0, 0.1, 0.5, 0.99, 1.0]
        ), ["value"]),
        "quantile_rank_check": lambda s, d: _rank_check(s, d),
        "agg_median": lambda s, d: aggregates.aggregate(_read(s, d, "orders"), "median", ["o_totalprice", "o_orderkey"]),
        "freq_items": lambda s, d: passthrough.PASS_THROUGH["frequentItems"](
            _read(s, d, "orders"), ["o_orderpriority", "o_orderstatus", "o_custkey"], 0.003
        ),
        # discovery beyond similarity
        "containment_paths": lambda s, d: discovery.containment_paths(_tables(s, d), threshold=0.5, sample=1 << 16).drop("sampled", "error"),
        "containment_error_check": lambda s, d: discovery.containment_errors(_tables(s, d), sample=512, confidence=0.999999),
        "join_size_sketch": lambda s, d: discovery.join_sizes(_tables(s, d)),
        "join_size_error_check": lambda s, d: discovery.join_size_errors(_tables(s, d)),
        # entry points: reading a table set, dispatch by name, the facade
        "load_table_set": lambda s, d: _loaded(s, d),
        "single_column_dispatch": lambda s, d: _dispatched(s, d),
        "profiler_paths": lambda s, d: TableProfiler(
            s, [f"{d}/{t}.parquet" for t in ("customer", "orders")], {0: ["c_custkey"], 1: ["o_custkey"]}
        ).joining_path_naive(),
        # outliers
        "outliers_given_centers": lambda s, d: outliers.outliers_given_centers(
            _read(s, d, "part"), ["p_size", "p_retailprice"], CENTERS, 30.0
        ),
        "outliers_many_centers": lambda s, d: outliers.outliers_given_centers(
            _read(s, d, "part"), ["p_size", "p_retailprice"], MANY_CENTERS, 2.0
        ),
        "sum_distance": lambda s, d: _round(
            outliers.sum_distance(_read(s, d, "part"), ["p_size", "p_retailprice"], CENTERS),
            ["sum_distance", "sum_squared_distance"],
        ),
        "kmeans_outliers": lambda s, d: outliers.outliers(
            _read(s, d, "part"), ["p_size", "p_retailprice"], 4, 20.0, seed=SEED
        ),
    }
    q.update(_LLM_QUERIES)
    if _pipeline:
        q["pipeline"] = _pipeline.run
    return q


# ------------------------------------------------------------------ DuckDB side


def _crc_sql(v: str) -> str:
    """crc32 of the UTF-8 bytes of ``v`` (code points re-encoded, then bitwise, reflected polynomial)."""
    cp = "unicode(ch)"
    return f"""xor(4294967295, list_reduce(
  flatten(list_transform(string_split({v}, ''), lambda ch: flatten(list_transform(
     CASE WHEN {cp} < 128 THEN [{cp}]
          WHEN {cp} < 2048 THEN [192 | ({cp} >> 6), 128 | ({cp} & 63)]
          WHEN {cp} < 65536 THEN [224 | ({cp} >> 12), 128 | (({cp} >> 6) & 63), 128 | ({cp} & 63)]
          ELSE [240 | ({cp} >> 18), 128 | (({cp} >> 12) & 63), 128 | (({cp} >> 6) & 63), 128 | ({cp} & 63)] END,
     lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1])))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b::BIGINT) ELSE xor(a >> 1, 3988292384 * (a & 1)) END,
  4294967295::BIGINT))"""


def _long_sql(tables: list[int] | None = None, only: tuple[int, str] | None = None) -> str:
    """UNION ALL long form ``(table_index, col_name, value)`` of the table set's string columns."""
    parts = []
    for i, (name, casts) in enumerate(TABLE_SET):
        if tables is not None and i not in tables:
            continue
        cols = [(c, f"CAST({c} AS VARCHAR)") for c in casts] + [(c, c) for c in STRING_COLUMNS[name]]
        for c, expr in cols:
            if only is not None and (i, c) != only:
                continue
            parts.append(f"SELECT {i} AS table_index, '{c}' AS col_name, {expr} AS value FROM {name}")
    return "\n  UNION ALL ".join(parts)


def _coef_sql(hashnum: int = HASHNUM, seed: int = SEED, wide: bool = False) -> str:
    """The hash family as one list literal of (i, a, b) structs."""
    co = hash_coefficients(hashnum, seed, wide)
    return "[" + ", ".join(f"{{'i': {i}, 'a': {a}::HUGEINT, 'b': {b}::HUGEINT}}" for i, a, b in co.rows()) + "]"


def _sig_ctes(long_sql: str, wide: bool = False) -> str:
    key = "CAST('0x' || left(md5(value), 15) AS BIGINT)" if wide else _crc_sql("value")
    return f"""long AS (
  {long_sql}
),
vals AS (SELECT table_index, col_name, value, count(*) AS cnt FROM long WHERE value IS NOT NULL GROUP BY table_index, col_name, value),
crcs AS (
  SELECT table_index, col_name, crc, sum(cnt) AS cnt, count(*) AS n_values
  FROM (SELECT table_index, col_name, {key} AS crc, cnt FROM vals) t
  GROUP BY table_index, col_name, crc
),
hashed AS (
  SELECT table_index, col_name, cnt, n_values, x.i AS hash_index, CAST(x.h AS BIGINT) AS h
  FROM (
    SELECT table_index, col_name, cnt, n_values,
           unnest(list_transform({_coef_sql(wide=wide)}, lambda c: {{'i': c.i, 'h': (c.a * crc + c.b) % {WIDE_PRIME if wide else PRIME}}})) AS x
    FROM crcs
  ) t
),
sig AS (
  SELECT CAST(table_index AS INTEGER) AS table_index, col_name, CAST(hash_index AS INTEGER) AS hash_index,
         min(h) AS hash_value, CAST(arg_min(cnt, h) AS BIGINT) AS min_hash_count,
         CAST(sum(n_values) AS BIGINT) AS n_distinct
  FROM hashed GROUP BY table_index, col_name, hash_index
)"""


KEYS = "at_ind, ac_name, bt_ind, bc_name"


def _match_sql(a: str, b: str, cross: bool, threshold: float) -> str:
    cond = " AND a.table_index < b.table_index" if cross else ""
    return f"""SELECT a.table_index AS at_ind, a.col_name AS ac_name, b.table_index AS bt_ind, b.col_name AS bc_name,
         avg(a.min_hash_count * b.min_hash_count) AS aj_contribution,
         CAST(count(*) AS DOUBLE) / {float(HASHNUM)} AS similarity
  FROM {a} a JOIN {b} b ON a.hash_index = b.hash_index AND a.hash_value = b.hash_value{cond}
  GROUP BY a.table_index, a.col_name, b.table_index, b.col_name
  HAVING CAST(count(*) AS DOUBLE) / {float(HASHNUM)} > {float(threshold)}"""


def _contain_sql(a: str, b: str, cross: bool, op: str, name: str) -> str:
    cond = " AND a.table_index < b.table_index" if cross else ""
    return f"""SELECT a.table_index AS at_ind, a.col_name AS ac_name, b.table_index AS bt_ind, b.col_name AS bc_name,
         CAST(count(*) AS DOUBLE) / {float(HASHNUM)} AS {name}
  FROM {a} a JOIN {b} b ON a.hash_index = b.hash_index AND a.hash_value {op} b.hash_value{cond}
  GROUP BY a.table_index, a.col_name, b.table_index, b.col_name"""


def _paths_sql(
    tables=None, threshold=0.0, containing=False, with_size=False, specific: tuple[int, str] | None = None, wide=False
) -> str:
    if specific is None:
        ctes = _sig_ctes(_long_sql(tables), wide)
        a, b, cross = "sig", "sig", True
    else:
        t, c = specific
        ctes = _sig_ctes(_long_sql([i for i in range(len(TABLE_SET)) if i != t]) + "\n  UNION ALL " + _long_sql([t], (t, c)))
        ctes += f""",
siga AS (SELECT * FROM sig WHERE table_index = {t} AND col_name = '{c}'),
sigb AS (SELECT * FROM sig WHERE table_index <> {t})"""
        a, b, cross = "siga", "sigb", False
    ctes += f",\nres AS (\n  {_match_sql(a, b, cross, threshold)}\n)"
    cols = f"res.at_ind, res.ac_name, res.bt_ind, res.bc_name, res.aj_contribution, res.similarity"
    joins = ""
    if containing:
        ctes += f",\nacb AS (\n  {_contain_sql(a, b, cross, '<', 'A_contain_B_sim')}\n)"
        ctes += f",\nbca AS (\n  {_contain_sql(a, b, cross, '>', 'B_contain_A_sim')}\n)"
        cols += ", coalesce(acb.A_contain_B_sim, 0.0) AS A_contain_B_sim, coalesce(bca.B_contain_A_sim, 0.0) AS B_contain_A_sim"
        joins += f" LEFT JOIN acb USING ({KEYS}) LEFT JOIN bca USING ({KEYS})"
    if with_size:
        ctes += ",\nnd AS (SELECT table_index, col_name, n_distinct FROM sig WHERE hash_index = 0)"
        cols += (
            ", res.similarity / (1.0 + res.similarity) * res.aj_contribution"
            " * CAST(na.n_distinct + nb.n_distinct AS DOUBLE) AS aj_size"
        )
        joins += (
            " LEFT JOIN nd na ON na.table_index = res.at_ind AND na.col_name = res.ac_name"
            " LEFT JOIN nd nb ON nb.table_index = res.bt_ind AND nb.col_name = res.bc_name"
        )
    return f"WITH {ctes}\nSELECT {cols} FROM res{joins}"


def _naive_sql(threshold: float = 0.0) -> str:
    return f"""WITH long AS (
  {_long_sql()}
),
dv AS (SELECT DISTINCT table_index, col_name, value FROM long WHERE value IS NOT NULL),
nd AS (SELECT table_index, col_name, count(*) AS n FROM dv GROUP BY table_index, col_name),
inter AS (
  SELECT a.table_index AS at_ind, a.col_name AS ac_name, b.table_index AS bt_ind, b.col_name AS bc_name, count(*) AS n_inter
  FROM dv a JOIN dv b ON a.value = b.value AND a.table_index < b.table_index
  GROUP BY a.table_index, a.col_name, b.table_index, b.col_name
)
SELECT CAST(at_ind AS INTEGER) AS at_ind, ac_name, CAST(bt_ind AS INTEGER) AS bt_ind, bc_name,
       n_inter / CAST(na.n + nb.n - n_inter AS DOUBLE) AS similarity
FROM inter JOIN nd na ON na.table_index = at_ind AND na.col_name = ac_name
           JOIN nd nb ON nb.table_index = bt_ind AND nb.col_name = bc_name
WHERE n_inter / CAST(na.n + nb.n - n_inter AS DOUBLE) > {threshold}"""


def _sketch_store_sql() -> str:
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS column, count(*) AS n_rows, count(*) - count({n}) AS n_nulls, count(DISTINCT {n}) AS exact, true AS within FROM orders"
        for n in names
    )


def _hist_even_sql(table: str, col: str, bins: int) -> str:
    return f"""WITH v AS (SELECT CAST({col} AS DOUBLE) AS v FROM {table} WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE))),
s AS (SELECT min(v) + 0.0 AS mn, max(v) + 0.0 AS mx FROM v),
w AS (SELECT mn, mx, CASE WHEN floor((mx - mn) / {bins}) * {bins} = mx - mn THEN floor((mx - mn) / {bins}) ELSE (mx - mn) / {bins} END AS inc FROM s),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})),
c AS (
  SELECT least(CAST(floor((v - (SELECT mn FROM w)) / (SELECT inc FROM w)) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
  FROM v GROUP BY 1
)
SELECT CAST(b.bin AS DOUBLE) * (SELECT inc FROM w) + (SELECT mn FROM w) AS bin_start_value,
       CASE WHEN b.bin = {bins - 1} THEN (SELECT mx FROM w)
            ELSE CAST(b.bin + 1 AS DOUBLE) * (SELECT inc FROM w) + (SELECT mn FROM w) END AS bin_end_value,
       coalesce(c.n, 0) AS count
FROM b LEFT JOIN c ON c.bin = b.bin"""


def _hist_edges_sql(table: str, col: str, edges: list[float]) -> str:
    arr = "[" + ", ".join(repr(float(e)) for e in edges) + "]"
    n = len(edges) - 1
    return f"""WITH v AS (SELECT CAST({col} AS DOUBLE) AS v FROM {table} WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE))),
c AS (
  SELECT least(len(list_filter(CAST({arr} AS DOUBLE[]), lambda x: x <= v)) - 1, {n - 1}) AS bin, count(*) AS n
  FROM v WHERE v >= {float(edges[0])} AND v <= {float(edges[-1])} GROUP BY 1
),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range({n}))
SELECT CAST({arr} AS DOUBLE[])[b.bin + 1] AS bin_start_value, CAST({arr} AS DOUBLE[])[b.bin + 2] AS bin_end_value,
       coalesce(c.n, 0) AS count
FROM b LEFT JOIN c ON c.bin = b.bin"""


def _derived_missing_sql() -> str:
    return """(SELECT CASE WHEN c_acctbal < 0 THEN 'NaN'::DOUBLE ELSE c_acctbal END AS bal,
        CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS bal_nulls,
        nullif(c_mktsegment, 'BUILDING') AS segment
 FROM customer) d"""


def _dist_sql(cols: list[str]) -> str:
    def sq(c):
        return " + ".join(f"({x} - {v}) * ({x} - {v})" for x, v in zip(cols, c))

    return "sqrt(least(" + ", ".join(sq(c) for c in CENTERS) + "))"


def _cat_describe_sql(table: str, cols: list[tuple[str, str]]) -> str:
    vc = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {e} AS value, count(*) AS n FROM {table} GROUP BY {e}" for c, e in cols
    )
    return f"""WITH vc AS (
  {vc}
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value IS NOT NULL DESC, value DESC) AS rk FROM vc
)
SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS uniques,
       max(CASE WHEN rk = 1 THEN value END) AS mode, max(CASE WHEN rk = 1 THEN n END) AS mode_count
FROM ranked GROUP BY "column\""""


def _value_count_long_sql(table: str, cols: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {e} AS value, count(*) AS count FROM {table} GROUP BY {e}" for c, e in cols
    )


def _distinct_ctes(tables: list[int]) -> str:
    """Distinct values with row counts, their number per column, and how many columns of different tables share."""
    return f"""long AS ({_long_sql(tables)}),
d AS MATERIALIZED (SELECT CAST(table_index AS INTEGER) AS table_index, col_name, value, count(*) AS cnt FROM long WHERE value IS NOT NULL GROUP BY ALL),
sizes AS (SELECT table_index, col_name, count(*)::DOUBLE AS n FROM d GROUP BY ALL),
shared AS (SELECT a.table_index AS at_ind, a.col_name AS ac_name, b.table_index AS bt_ind, b.col_name AS bc_name, count(*) AS shared
  FROM d a JOIN d b ON a.value = b.value AND a.table_index <> b.table_index GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    all_idx = list(range(len(TABLE_SET)))
    tpch = list(range(TPCH))
    sql: dict[str, str] = {
        "cast_categorical": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_acctbal, c_mktsegment FROM customer""",
        "csv_roundtrip": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
        "txt_roundtrip": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
        "json_roundtrip": """SELECT p_brand, p_name, p_partkey, p_retailprice, CAST(p_size AS BIGINT) AS p_size, p_type FROM part""",
        "minhash_signature": f"WITH {_sig_ctes(_long_sql(all_idx))}\nSELECT table_index, col_name, hash_index, hash_value, min_hash_count FROM sig",
        "minhash_signature_wide": f"WITH {_sig_ctes(_long_sql(all_idx), wide=True)}\nSELECT table_index, col_name, hash_index, hash_value, min_hash_count FROM sig",
        "multi_set_resemble_wide": _paths_sql(all_idx, with_size=True, wide=True),
        "joining_path_hash": _paths_sql(all_idx),
        "joining_path_hash_tpch": _paths_sql(tpch, threshold=0.05),
        "joining_path_hash_containing": _paths_sql(all_idx, containing=True),
        "joining_path_hash_specific": _paths_sql(specific=(5, "o_custkey")),
        "joining_path_hash_specific_containing": _paths_sql(specific=(6, "l_suppkey"), containing=True),
        "multi_set_resemble": _paths_sql(all_idx, with_size=True),
        "multi_set_resemble_containing": _paths_sql(all_idx, threshold=0.5, containing=True, with_size=True),
        "multi_set_resemble_specific": _paths_sql(specific=(6, "l_orderkey"), with_size=True),
        "jaccard_minhash": f"""WITH {_sig_ctes(
            "SELECT 0 AS table_index, 'a' AS col_name, text AS value FROM documents UNION ALL "
            "SELECT 1 AS table_index, 'b' AS col_name, text AS value FROM benchmark")},
agree AS (SELECT hash_index, count(*) = 2 AND min(hash_value) = max(hash_value) AS ok FROM sig GROUP BY hash_index)
SELECT CAST(count(*) FILTER (WHERE ok) AS DOUBLE) / {float(HASHNUM)} AS similarity FROM agree""",
        "jaccard_exact": """WITH a AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS v FROM customer),
b AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS v FROM orders)
SELECT (SELECT count(*) FROM a JOIN b USING (v)) / CAST((SELECT count(*) FROM (SELECT v FROM a UNION SELECT v FROM b)) AS DOUBLE) AS similarity""",
        "joining_path_naive": _naive_sql(),
        "joining_path_hash_half": _paths_sql(all_idx, threshold=0.5),
        "joining_path_naive_half": _naive_sql(0.5),
        "joining_path_naive_some": _naive_sql(0.01),
        "sketch_store_check": _sketch_store_sql(),
        "hash_collision_check": f"""WITH {_sig_ctes(_long_sql(all_idx))}
SELECT CAST(table_index AS INTEGER) AS table_index, col_name, CAST(hash_index AS INTEGER) AS hash_index,
       CAST(sum(n_values) AS BIGINT) AS n_values, count(DISTINCT h) AS n_hashes,
       CAST(sum(n_values) AS BIGINT) - count(DISTINCT h) AS collisions
FROM hashed GROUP BY table_index, col_name, hash_index""",
        "describe_long": "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
FROM lineitem"""
            for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        ),
        "value_count": "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority",
        "value_count_long": _value_count_long_sql(
            "lineitem",
            [("l_returnflag", "l_returnflag"), ("l_linestatus", "l_linestatus"),
             ("l_quantity", "CAST(l_quantity AS VARCHAR)"), ("l_linenumber", "CAST(l_linenumber AS VARCHAR)")],
        ),
        "value_count_text": _value_count_long_sql("documents", [("text", "text"), ("lang", "lang")]),
        "cat_describe": _cat_describe_sql(
            "customer", [("c_name", "c_name"), ("c_nationkey", "CAST(c_nationkey AS VARCHAR)"), ("c_mktsegment", "c_mktsegment")]
        ),
        "cat_describe_text": _cat_describe_sql("documents", [("text", "text"), ("lang", "lang"), ("source", "source")]),
        "distinct_count_exact": """SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey,
       count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_returnflag) AS l_returnflag,
       count(DISTINCT l_quantity) AS l_quantity FROM lineitem""",
        "nan_count": f"""SELECT count(*) FILTER (WHERE isnan(bal)) AS bal, count(*) FILTER (WHERE isnan(bal_nulls)) AS bal_nulls,
       CAST(0 AS BIGINT) AS segment FROM {_derived_missing_sql()}""",
        "null_count": f"""SELECT count(*) FILTER (WHERE bal IS NULL) AS bal, count(*) FILTER (WHERE bal_nulls IS NULL) AS bal_nulls,
       count(*) FILTER (WHERE segment IS NULL) AS segment FROM {_derived_missing_sql()}""",
        "missing_count": f"""SELECT count(*) FILTER (WHERE bal IS NULL OR isnan(bal)) AS bal,
       count(*) FILTER (WHERE bal_nulls IS NULL OR isnan(bal_nulls)) AS bal_nulls,
       count(*) FILTER (WHERE segment IS NULL) AS segment FROM {_derived_missing_sql()}""",
        "histogram_even": _hist_even_sql("lineitem", "l_extendedprice", 10),
        "histogram_integer": _hist_even_sql("part", "p_size", 7),
        "histogram_edges": _hist_edges_sql("orders", "o_totalprice", [0, 50000, 100000, 200000, 400000, 600000]),
        "histogram_single_bin": """SELECT min(l_discount) + 0.0 AS bin_start_value, max(l_discount) + 0.0 AS bin_end_value, count(*) AS count
FROM lineitem WHERE l_discount IS NOT NULL AND NOT isnan(l_discount)""",
        "agg_numeric": """SELECT avg(l_quantity) AS "avg(l_quantity)", round(avg(l_extendedprice), 6) AS "avg(l_extendedprice)",
       round(avg(l_discount), 6) AS "avg(l_discount)" FROM lineitem""",
        "agg_stddev": """SELECT round(stddev_samp(c_acctbal), 6) AS "stddev(c_acctbal)",
       round(stddev_samp(c_custkey), 6) AS "stddev(c_custkey)" FROM customer""",
        "agg_skewness": """WITH c AS (
  SELECT avg(power(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 2)) AS m2,
         avg(power(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 3)) AS m3 FROM orders)
SELECT round(m3 / power(m2, 1.5), 6) AS "skewness(o_totalprice)" FROM c""",
        "agg_kurtosis": """WITH c AS (
  SELECT avg(power(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 2)) AS m2,
         avg(power(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 4)) AS m4 FROM orders)
SELECT round(m4 / (m2 * m2) - 3.0, 6) AS "kurtosis(o_totalprice)" FROM c""",
        "agg_integral_bits": 'SELECT bit_xor(l_orderkey) AS "bit_xor(l_orderkey)", bit_xor(l_linenumber) AS "bit_xor(l_linenumber)" FROM lineitem',
        "agg_boolean": 'SELECT bool_and(l_quantity > 49) AS "bool_and(big)", bool_and(l_discount >= 0) AS "bool_and(nonneg)" FROM lineitem',
        "quantiles_exact": "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", {p} AS prob, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM lineitem"""
            for c in ["l_extendedprice", "l_quantity", "l_orderkey"] for p in ["0.0::DOUBLE", "0.1::DOUBLE", "0.5::DOUBLE", "0.99::DOUBLE", "1.0::DOUBLE"]
        ),
        "quantiles_fine": "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", {p}::DOUBLE AS prob, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM lineitem"""
            for c in ["l_extendedprice", "l_quantity"] for p in [0.1, 0.25, 0.5, 0.9]
        ),
        "quantile_rank_check": "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", {p}::DOUBLE AS prob, TRUE AS within"""
            for c in ["l_extendedprice", "l_quantity"] for p in [0.1, 0.5, 0.9]
        ),
        "agg_median": """SELECT median(o_totalprice) AS "median(o_totalprice)", CAST(median(o_orderkey) AS DOUBLE) AS "median(o_orderkey)" FROM orders""",
        "freq_items": "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM orders WHERE {c} IS NOT NULL
GROUP BY {c} HAVING count(*) > 0.003 * (SELECT count(*) FROM orders)""" for c in ["o_orderpriority", "o_orderstatus", "o_custkey"]
        ),
        "containment_paths": f"""WITH {_distinct_ctes(all_idx)}
SELECT at_ind, ac_name, bt_ind, bc_name, shared / n AS containment FROM shared JOIN sizes ON at_ind = table_index AND ac_name = col_name
WHERE shared / n >= 0.5""",
        "containment_error_check": f"""WITH {_distinct_ctes(all_idx)}
SELECT at_ind, ac_name, bt_ind, bc_name, shared / n AS exact, TRUE AS within FROM shared JOIN sizes ON at_ind = table_index AND ac_name = col_name""",
        "join_size_error_check": f"""WITH {_distinct_ctes(all_idx)}
SELECT a.table_index AS at_ind, a.col_name AS ac_name, b.table_index AS bt_ind, b.col_name AS bc_name, CAST(sum(a.cnt * b.cnt) AS BIGINT) AS exact, TRUE AS within
FROM d a JOIN d b ON a.value = b.value AND a.table_index < b.table_index GROUP BY ALL""",
        "load_table_set": """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "single_column_dispatch": """SELECT 'c_nationkey' AS "column", count(DISTINCT c_nationkey) AS "distinct" FROM customer
UNION ALL SELECT 's_nationkey', count(DISTINCT s_nationkey) FROM supplier""",
        "profiler_paths": f"""WITH d AS (
  SELECT DISTINCT 0::INTEGER AS t, c, v FROM (SELECT 'c_custkey' AS c, CAST(c_custkey AS VARCHAR) AS v FROM customer
    UNION ALL SELECT 'c_name', c_name FROM customer UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer)
  UNION SELECT DISTINCT 1::INTEGER, c, v FROM (SELECT 'o_custkey' AS c, CAST(o_custkey AS VARCHAR) AS v FROM orders
    UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders)),
n AS (SELECT t, c, count(*) AS n FROM d GROUP BY ALL),
s AS (SELECT a.c AS ac, b.c AS bc, count(*) AS common FROM d a JOIN d b ON a.t = 0 AND b.t = 1 AND a.v = b.v GROUP BY ALL)
SELECT 0::INTEGER AS at_ind, ac AS ac_name, 1::INTEGER AS bt_ind, bc AS bc_name, common / (x.n + y.n - common) AS similarity
FROM s JOIN n x ON x.t = 0 AND x.c = ac JOIN n y ON y.t = 1 AND y.c = bc""",
        "histogram_bigint": """WITH e AS (SELECT * FROM (VALUES (0, 0, 1), (1, 1, 2), (2, 2, 1001), (3, 1001, 1152921504606846976 - 9007199254740992)) t(i, lo, hi))
SELECT CAST(9007199254740992 + lo AS DOUBLE) AS bin_start_value, CAST(9007199254740992 + hi AS DOUBLE) AS bin_end_value,
       (SELECT count(*) FROM orders WHERE o_orderkey >= lo AND (o_orderkey < hi OR (i = 3 AND o_orderkey = hi))) AS count FROM e""",
        "histogram_many_edges": _hist_edges_sql("orders", "o_totalprice", UNEVEN),
        "outliers_many_centers": f"""SELECT p.* FROM part p JOIN (
  SELECT p_partkey, min(power(p_size - x, 2) + power(p_retailprice - y, 2)) AS d2
  FROM part, (VALUES {", ".join(f"({x}, {y})" for x, y in MANY_CENTERS)}) c(x, y) GROUP BY p_partkey) USING (p_partkey) WHERE sqrt(d2) > 2.0""",
        "agg_mode": """WITH p AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1),
c AS (SELECT o_custkey AS v, count(*) AS n FROM orders GROUP BY 1)
SELECT (SELECT v FROM p ORDER BY n DESC, v ASC LIMIT 1) AS "mode(o_orderpriority)",
       (SELECT v FROM s ORDER BY n DESC, v ASC LIMIT 1) AS "mode(o_orderstatus)",
       (SELECT v FROM c ORDER BY n DESC, v ASC LIMIT 1) AS "mode(o_custkey)\"""",
        "select_columns": "SELECT p_partkey, p_brand FROM part",
        "select_expr": "SELECT p_partkey, upper(p_brand) AS brand, p_size * 2 AS double_size FROM part",
        "dedup_columns": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
        "sort_columns": "SELECT * FROM part ORDER BY p_size, p_partkey",
        "cube_counts": "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
        "rollup_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
        "grouping_sets_counts": """SELECT c_nationkey, c_mktsegment, count(*) AS count FROM customer
GROUP BY GROUPING SETS ((c_mktsegment), (c_nationkey), ())""",
        "unpivot_columns": """SELECT p_partkey, 'p_size' AS variable, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice' AS variable, p_retailprice AS value FROM part""",
        "outliers_given_centers": f"SELECT * FROM part WHERE {_dist_sql(['p_size', 'p_retailprice'])} > 30.0",
        "sum_distance": f"""SELECT round(sum(d), 6) AS sum_distance, round(sum(d * d), 6) AS sum_squared_distance
FROM (SELECT {_dist_sql(['p_size', 'p_retailprice'])} AS d FROM part) t WHERE d IS NOT NULL AND NOT isnan(d)""",
    }
    sql.update(_LLM_SQL)
    if _pipeline and _pipeline.ORACLE_SQL:
        sql["pipeline"] = _pipeline.ORACLE_SQL
    return sql
