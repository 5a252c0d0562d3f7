"""Exact top-k inner-product search by term-at-a-time accumulation.

Vectors are quantised to integers. A vector component is a term: a block of
candidate rows keeps, per component, the postings (row, weight) of its
non-zero weights. A query walks its own non-zero components and scatters
``weight * posting`` into a dense score array over the block; a partial
selection then keeps the block's k best, and a last step merges the blocks'
winners. Every query meets every row: queries and candidates are cut into
blocks of a fixed number of rows, and each pair of blocks is one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import stored

CANDIDATE_ROWS = 4096
QUERY_ROWS = 1024


def _matrix(table: pa.Table, scale: int) -> np.ndarray:
    """floor(scale * x), rows padded with zeros to the longest; exact integers whatever their size."""
    column = table.column("vec").combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(scale))
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    if out.size and np.abs(out).sum(axis=1).max() >= 2.0**31:  # products could pass 64 bits
        return np.vectorize(int, otypes=[object])(out)
    return out.astype(np.int64)


def _block_top(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, k: int):
    """Yields per query the places of its k best candidates (all, if fewer) and their scores.

    Candidates are in the order in which ties rank; ``own`` is each query's
    place among them, or -1.
    """
    rows = len(candidates)
    postings = []
    for t in range(candidates.shape[1]):
        places = np.flatnonzero(candidates[:, t])
        weights = np.ascontiguousarray(candidates[places, t])
        postings.append((slice(None) if len(places) == rows else places, weights))
    wide = object in (queries.dtype, candidates.dtype)
    for query, mine in zip(queries, own, strict=True):
        scores = np.zeros(rows, object if wide else np.int64)
        for t in np.flatnonzero(query[: len(postings)]):
            places, weights = postings[t]
            scores[places] += query[t] * weights
        left = np.delete(np.arange(rows), mine) if mine >= 0 else np.arange(rows)
        held = scores[left]
        if len(left) > k:
            edge = np.sort(held)[-k] if wide else np.partition(held, len(held) - k)[len(held) - k]
            above = np.flatnonzero(held > edge)
            chosen = np.concatenate((above, np.flatnonzero(held == edge)[: k - len(above)]))
        else:
            chosen = np.arange(len(left))
        yield left[chosen], held[chosen]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    candidate_rows: int = CANDIDATE_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query row's k best other rows.

    The score is the integer inner product of ``floor(scale * x)``; missing
    components of a shorter vector count as zero. Ties go to the smaller id,
    rows without an id last. Vectors that are null or hold a null or
    non-finite component take no part. Rows with the same id are different
    rows: each is a query of its own and a candidate of the others. An empty
    table gives an empty result. A score beyond 64 bits raises an error.
    """
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = stored(
        vectors.where(vec.isNotNull() & F.forall(vec, finite)).select(
            F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
            vec.alias("vec"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
            F.monotonically_increasing_id().alias("rid"),
        )
    )
    total, asked = rows.agg(F.count("*"), F.count_if("is_query")).first()
    blocks, query_blocks = max(1, -(-total // candidate_rows)), max(1, -(-asked // query_rows))
    block, query_block = (F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int") for n in (blocks, query_blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("vec_id", "rid", "vec", block.alias("cb"), every(query_blocks).alias("qb"))
    queries = rows.where("is_query").select("vec_id", "rid", "vec", query_block.alias("qb"), every(blocks).alias("cb"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([("vec_id", "ascending"), ("rid", "ascending")])  # ties; null ids go last
        rids, ids = left.column("rid").to_numpy(), left.column("vec_id").combine_chunks()
        by_rid = {r: i for i, r in enumerate(rids.tolist())}
        query_rids, query_ids = right.column("rid").to_pylist(), right.column("vec_id").to_pylist()
        own = np.array([by_rid.get(r, -1) for r in query_rids], np.int64)
        at, score, of = [], [], []
        if left.num_rows and right.num_rows:
            for q, (places, scores) in enumerate(_block_top(_matrix(right, scale), _matrix(left, scale), own, k)):
                at += places.tolist()
                score += scores.tolist()
                of += [q] * len(places)
        return pa.table(
            {
                "query_rid": pa.array([query_rids[q] for q in of], pa.int64()),
                "query_id": pa.array([query_ids[q] for q in of], pa.int64()),
                "vec_id": ids.take(pa.array(at, pa.int64())),
                "rid": pa.array(rids[at] if at else [], pa.int64()),
                "score": pa.array(score, pa.int64()),
            }
        )

    best = (
        candidates.groupBy("cb", "qb")
        .cogroup(queries.groupBy("cb", "qb"))
        .applyInArrow(search, "query_rid bigint, query_id bigint, vec_id bigint, rid bigint, score bigint")
    )
    order = Window.partitionBy("query_rid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
