"""SimHash near-duplicates by pigeonring filtering.

A document's fingerprint takes, bit by bit, the majority of the 64-bit hashes
of its word shingles. Two fingerprints link when at most ``max_bits`` bits
differ. Candidates come from the pigeonring principle: cut the fingerprint
into m segments on a ring; if at most t bits differ in all, some start i
exists such that, for every length l, the l segments from i on differ in at
most floor(l * t / m) bits together. With m > t the first segment of such a
chain is equal and the second differs in at most one bit, so a join on both
(the second with each of its zero bits set in turn) finds every pair; the
longer prefixes of the chain then prune it before the full Hamming check.

Only distinct fingerprints take part, so a group of copies costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import arrow_slices, field_type, stored, utf8
from tablescout.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 4
SEED = 42
_BLOCK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text; zero if it has no word."""
    parts = text.lower().split()  # on bytes: A-Z only, and ASCII white space
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = list(accumulate(map(len, parts), lambda end, n: end + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_digest
    if len(parts) < words:
        hashes = [digest(line, SEED)]
    else:
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[words - 1 :], strict=False)]
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), _BLOCK):
        block = np.frombuffer(b"".join(hashes[lo : lo + _BLOCK]), np.uint8)
        counts += np.unpackbits(block).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` for every row of ``docs``; null and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            fps = [fingerprint(t, words) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {field_type(rows, 'doc_id')}, fp bigint")


def _segment(fp: Column, i: int, segments: int) -> Column:
    width = 64 // segments
    return F.shiftrightunsigned(fp, (i % segments) * width).bitwiseAND(F.lit((1 << width) - 1))


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """All pairs ``a < b`` of the distinct bigint column ``fp`` that differ in at most ``max_bits`` bits."""
    if not 0 <= max_bits < segments or 64 % segments or segments < 2:
        raise ValueError("segments must divide 64 and exceed max_bits")
    width = 64 // segments
    near = 2 * max_bits // segments  # bits that the first two segments may differ in: 0 or 1
    fp = F.col("fp")
    chain = lambda i, second: F.struct(
        F.lit(i).alias("start"), F.shiftleft(_segment(fp, i, segments), width).bitwiseOR(second).alias("key")
    )
    index = fps.select(
        F.col("fp").alias("b"),
        F.inline(F.array(*[chain(i, _segment(fp, i + 1, segments)) for i in range(segments)])),
    )
    probes = []
    for i in range(segments):
        second = _segment(fp, i + 1, segments)
        probes.append(chain(i, second))
        if near:
            for bit in range(width):
                unset = second.bitwiseAND(F.lit(1 << bit)) == 0
                probes.append(F.when(unset, chain(i, second.bitwiseOR(F.lit(1 << bit)))))
    probe = (
        fps.select(F.col("fp").alias("a"), F.explode(F.array_compact(F.array(*probes))).alias("p"))
        .select("a", "p.start", "p.key")
    )
    diff = F.col("a").bitwiseXOR(F.col("b"))
    kept = F.lit(False)
    for i in range(segments):
        spent, within = F.lit(0), F.col("start") == i
        for length in range(1, segments + 1):
            spent = spent + F.bit_count(_segment(diff, i + length - 1, segments))
            within = within & (spent <= length * max_bits // segments)
        kept = kept | within
    pairs = probe.join(index, ["start", "key"]).where((F.col("a") != F.col("b")) & kept & (F.bit_count(diff) <= max_bits))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest id that links reach, the row's own id
    included. Null and blank texts share fingerprint zero and link like any
    other; rows with a null id keep their row and take the component of their
    fingerprint. Other columns of ``docs`` play no part.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words))
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    parts = connected_components(links(distinct.select("fp"), max_bits, segments))
    labelled = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_fp = labelled.join(smallest, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component.

    All columns stay. Repeated rows of a kept id stay as well; rows with a
    null id are kept only if no row of their component has an id.
    """
    found = near_duplicates(docs, id_col, text_col, **parameters)
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(keep, docs[id_col].eqNullSafe(keep["_kept_id"]), "left_semi")
