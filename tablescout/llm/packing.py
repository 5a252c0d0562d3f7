"""Vector best-fit packing of tokenised documents into training sequences.

A sequence is a bin with three capacities: tokens, documents (pieces of
them) and attention cost (the sum of squared piece lengths, what
block-diagonal attention pays). Longest first, a piece goes to the open bin
that every constraint allows and that scores best: the largest weighted dot
product of the piece with the bin's residual capacities, or the smallest
weighted norm of what would remain. If none allows it, a new bin opens.

Documents longer than a sequence are cut; the first piece takes the
remainder, so all others fill a sequence and need no search. The rest is
dealt into groups of a fixed expected number of pieces, which are packed
independently: one bin a group may stay part empty, whatever the input size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import arrow_slices, field_type, stored

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 2048
WEIGHTS = (1.0, 0.05, 0.05)  # tokens, documents, attention cost, each relative to its capacity

# A regular text holds Latin letters, common punctuation, spaces and line feeds
# alone, where every library agrees on what a letter or white space is.
_OTHER = re.compile("[^\n\x20-\x7e\xa1-ɏ‐-‧€™]")

# Fixed value: how byte-level BPE cuts a text into words before merging.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The tokenizer at ``path``, its vocabulary as byte ranks, and a pattern of what takes the tokenizer itself."""
    from tiktoken import Encoding
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    symbols = sorted(ByteLevel.alphabet())  # bytes that print stand for themselves, the others follow from 256 on
    byte = {chr(c): c for c in plain}
    byte |= dict(zip((x for x in symbols if x not in byte), (c for c in range(256) if c not in set(plain)), strict=True))
    ranks = {bytes(byte[x] for x in token): i for token, i in tokenizer.get_vocab().items() if token not in added}
    special = re.compile("|".join([_OTHER.pattern, *map(re.escape, sorted(added))]))
    return tokenizer, Encoding("words", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}), special


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text, as the tokenizer at ``path`` gives them without adding special tokens.

    A regular text is merged by the ranks of the same vocabulary. Other texts,
    and those that hold the string of an added token, which has an id of its
    own, go through the tokenizer.
    """
    tokenizer, ranks, special = _tokenizer(path)
    other = [i for i, text in enumerate(texts) if special.search(text)]
    out = dict(zip(other, tokenizer.encode_batch_fast([texts[i] for i in other], add_special_tokens=False), strict=True))
    return [np.array(out[i].ids if i in out else ranks.encode_ordinary(text), "<u4") for i, text in enumerate(texts)]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for every piece of every row's ids."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            of, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(encode([t or "" for t in batch.column("text").to_pylist()], tokenizer_path)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for n, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    of.append(row), piece.append(n), start.append(lo), length.append(hi - lo)
                    crc.append(zlib.crc32(ids[lo:hi].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(run, f"doc_id {field_type(rows, 'doc_id')}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: np.ndarray, capacities: tuple[int, int, int], weights=WEIGHTS, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its place in it; ``lengths`` are in the order in which pieces are placed.

    A piece that alone breaks a capacity gets a bin of its own: documents
    are never dropped, and only tokens can be cut to size.
    """
    full = np.array(capacities, float)
    scale = np.array(weights, float) / full
    room = np.zeros((256, 3))
    used = opened = 0
    live = np.zeros(256, np.int64)  # bins that have room for one token more; their numbers
    into, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    filled: list[int] = []
    for i, n in enumerate(lengths.tolist()):
        need = np.array([n, 1, n * n], float)
        rest = room[:used] - need
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            if rule == "dot":
                score = -((room[fits] * scale) @ (need * scale))
            else:
                score = ((rest[fits] * scale) ** 2).sum(axis=1)
            at = int(fits[score.argmin()])  # ties: the bin opened first
        else:
            if used == len(room):
                room, live = np.concatenate([room, np.zeros_like(room)]), np.concatenate([live, np.zeros_like(live)])
            at, room[used], live[used] = used, full, opened
            used, opened = used + 1, opened + 1
            filled.append(0)
        b = int(live[at])
        into[i], offset[i] = b, filled[b]
        filled[b] += n
        room[at] -= need
        if (room[at] <= 0).any():  # nothing more can go in: close it
            room[at : used - 1], live[at : used - 1] = room[at + 1 : used].copy(), live[at + 1 : used].copy()
            used -= 1
    return into, offset


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights=WEIGHTS,
    rule: str = "norm",
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Every piece of every row of ``docs`` with its sequence and its place there.

    Columns: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    ``max_docs`` and ``max_cost`` default to values that no sequence of
    ``capacity`` tokens can exceed. ``rule`` is "norm" (residual norm) or
    "dot" (weighted dot product). A null text counts as empty: one piece
    that holds the end id. Rows with equal or null ids are documents of
    their own. Other columns play no part; an empty table has no pieces.
    """
    if rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    limits = (capacity, max_docs or capacity, max_cost or capacity * capacity)
    cut = stored(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id).withColumn("place", F.monotonically_increasing_id()))
    open_ = cut.where(F.col("length") < capacity)
    groups = max(1, -(-open_.count() // group_pieces))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def fill(table: pa.Table) -> pa.Table:
        # The order is fixed by the pieces themselves, not by how they arrive.
        table = table.sort_by([("length", "descending"), ("place", "ascending")])
        into, offset = best_fit(table.column("length").to_numpy(), limits, weights, rule)
        group = table.column("bucket").to_numpy()
        # Odd numbers; a full piece has an even one.
        sequence = ((group.astype(np.int64) << 32) + into) * 2 + 1
        return table.select(columns[:5]).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    kind = field_type(cut, "doc_id")
    packed = (
        open_.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(groups)).cast("int"))
        .groupBy("bucket")
        .applyInArrow(fill, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    )
    full = cut.where(F.col("length") >= capacity).select(*columns[:5], (F.col("place") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(full)
