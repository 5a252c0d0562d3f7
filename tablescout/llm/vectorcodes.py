"""Vector code compression: product codes by exact integer arithmetic.

Components become integers; a vector is cut into equal parts, and each part
position has a codebook of integer entries, learned by a fixed number of
Lloyd rounds. The nearest entry is found by dot products that are exact:
integers are split into limbs of ``LIMB_BITS`` bits, each pair of limbs is one
float64 matrix product whose sums stay below 2^53, and the products are
recombined by shifts in int64. The first smallest distance wins.

Every round is one Spark job over the stored integers: a task hands on at most
one row of sums per codebook entry, and the driver gets the codebooks alone,
whose size does not depend on the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import field_type, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Two limbs of 8 bits multiply to less than 2^16, so 2^37 dimensions add up below 2^53.
LIMB_BITS = 8
#: Scaled components from here on are refused: beyond 4096 dimensions their squared distances may pass 63 bits.
LARGEST = 1 << 24
BLOCK = 2048  # vectors whose distances are taken together
HOT_SHARE = 256  # a label with more than one row in so many is hot: there are fewer than that


def limbs(x: np.ndarray, bits: int = LIMB_BITS) -> list[np.ndarray]:
    """float64 arrays whose sum, each shifted by ``bits`` more, is ``x``; all but the last are not negative."""
    out = []
    while x.size and (x.max() >= 1 << bits or x.min() < -(1 << bits)):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray, bits: int = LIMB_BITS) -> np.ndarray:
    """``a @ b.T`` of int64 matrices; exact wherever the result fits into int64."""
    if a.shape[1] << (2 * bits) > 1 << 53:
        raise ValueError("too many dimensions for limbs of this width")
    right = limbs(b, bits)
    total = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            if bits * (i + j) < 64:  # beyond, nothing is left modulo 2^64
                total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each vector and its squared distance, by blocks."""
    at, error = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
    norm = (book * book).sum(axis=1)
    for lo in range(0, len(vectors), BLOCK):
        x = vectors[lo : lo + BLOCK]
        far = norm - 2 * exact_products(x, book)
        best = far.argmin(axis=1)  # the first of the smallest
        at[lo : lo + BLOCK] = best
        error[lo : lo + BLOCK] = far[np.arange(len(x)), best] + (x * x).sum(axis=1)
    return at, error


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def integers(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, x``: floor(scale * component), without vectors that are null or hold null or non-finite components."""
    v = F.col("v")
    finite = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = docs.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    ).where(finite)
    scaled = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x))
    too_large = F.exists(v, lambda x: F.abs(F.lit(float(scale)) * x) >= F.lit(float(LARGEST)))
    return kept.select("vec_id", "label", F.when(too_large, F.raise_error(F.lit(f"component beyond {LARGEST} after scaling"))).otherwise(scaled).alias("x"))


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``part, entry, n, sums``: of the vectors whose nearest entry it is, one row a task at most for each entry."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch).reshape(batch.num_rows, parts, width)
            for p in range(parts):
                at, _ = nearest(x[:, p], shared.value[p])
                order = np.argsort(at, kind="stable")
                used, first = np.unique(at[order], return_index=True)
                n[p] += np.bincount(at, minlength=entries)
                if width:
                    total[p, used] += np.add.reduceat(x[order, p], first, axis=0)
        p, e = np.nonzero(n)
        if len(p):
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * width, pa.int32()), pa.array(total[p, e].ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e], pa.int64()), flat], ["part", "entry", "n", "sums"])

    found = rows.select("x").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    each = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """The codebooks (parts x entries x width) of ``vec_id, x`` rows; None if there are none.

    They start as the parts of the smallest ids (null ids last, ties by the
    vector), fewer if there are fewer vectors. Entries that no part is nearest
    to stay as they are.
    """
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    if not first:
        return None
    dims = len(first[0]["x"])
    if dims % parts or not rows.where(F.size("x") != dims).isEmpty():
        raise ValueError(f"all vectors must have one length, a multiple of {parts}")
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(rows, books).collect():  # parts x entries at most
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(dims // parts)]
    return books


def books_sha256(books: np.ndarray) -> str:
    """Over all components as decimal numbers, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, codes, error``: the nearest entry of each part, and the squared distances' sum."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch).reshape(batch.num_rows, parts, width)
            found = [nearest(x[:, p], shared.value[p]) for p in range(parts)]
            codes = np.stack([at for at, _ in found], axis=1).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * parts, pa.int32()), pa.array(codes.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), flat, pa.array(sum(error for _, error in found), pa.int64())], ["vec_id", "label", "codes", "error"]
            )

    return rows.select("vec_id", "label", "x").mapInArrow(
        run, f"vec_id {field_type(rows, 'vec_id')}, label {field_type(rows, 'label')}, codes array<int>, error bigint"
    )


def with_group_total(rows: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over equal ``key`` (nulls together) as ``total``.

    Sums meet before the shuffle. The sums of hot keys, fewer than
    ``HOT_SHARE`` by their share of the rows, are broadcast, so that no task
    gets all rows of such a key; the other keys join.
    """
    sums = stored(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(total), F.count("*").alias("_n")))
    hot = F.col("_n") * HOT_SHARE > (sums.agg(F.sum("_n")).first()[0] or 0)
    few = F.broadcast(sums.where(hot).select("_key", total, F.lit(True).alias("_hot")))
    marked = rows.join(few, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot", total).join(sums.where(~hot).drop("_n"), F.col(key).eqNullSafe(F.col("_key")))
    columns = [*rows.columns, total]
    return marked.where("_hot").select(*columns).unionByName(rest.select(*columns))


def compress(
    docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """The codes of every usable vector, and the codebooks (None if no vector is usable).

    Columns: ``vec_id, codes, error, label_error``; ``label_error`` sums the
    errors over equal labels, nulls together. Vectors that are null or hold
    null or non-finite components are left out; rows with equal or null ids
    stay separate. Runs jobs: two for the start, one a round, one for the
    labels. A component of ``LARGEST`` or more after scaling, vectors of
    unequal lengths, or a length that ``parts`` does not divide, are errors.
    """
    rows = stored(integers(docs, id_col, vector_col, label_col, scale))
    books = train(rows, parts, entries, rounds)
    if books is None:
        empty = rows.select("vec_id", F.lit(None).cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"))
        return empty, None
    coded = stored(encode(rows, books))
    return with_group_total(coded, "label", "error", "label_error").select("vec_id", "codes", "error", "label_error"), books


def hex_code(codes: Column) -> Column:
    """Two lower-case hex digits a code, in order."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
