"""Phrase collocation mining by Rabin-Karp fingerprints.

A text is cut into pieces at punctuation and line ends, and a piece into
words. Prefix polynomials modulo 2^64 give the fingerprint of any stretch of
bytes, and over the words' fingerprints that of any n-gram, by one subtraction
and one product; the language goes in as well. A task counts equal
fingerprints before the shuffle adds them up.

A phrase is frequent only if all its parts are, so the fingerprints of longer
n-grams are counted only where a bit table of fixed size lets their parts
through: first words, then pairs of words, then longer phrases in one pass. The
table's false positives cost time and nothing else.

The last pass materialises frequent phrases alone. Equal fingerprints of a
slice are compared word by word, in the text, with the occurrence that their
pointer names; where one differs, that fingerprint's occurrences are told apart
by their text. The shuffle then adds counts up by language and text and keeps
the least pointer, so the counts are exact whatever collides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import arrow_slices, field_type, shuffle_partitions, stored

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
UNKNOWN = "und"  # the language of rows without one
MAX_BITS = 1 << 28  # of a pass's bit table: 32 MB, whatever the input
LEAST_BITS = 1 << 15
BLOCK_BITS = 512  # in which all probes of a fingerprint fall
PROBES = 4
PENDING = 1 << 21  # fingerprints that a task holds before it counts them and hands them on
_SLICE = 1 << 20  # bytes of text worked on at a time
_TEXT_SLICE = 1 << 21  # where phrases are written out

# A piece ends at these bytes, and a word at these as well.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b"\x20\x09"

_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[list(WORD_ENDS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2^64, kept up to the size of a slice."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 2 * _SLICE:
            _POWERS[base] = known
    return known[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def stretches(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial fingerprint of ``values[first:end]`` for each pair, from one prefix polynomial."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * _powers(_BASE, len(values)), out=prefix[1:])
    return (prefix[end] - prefix[first]) * _powers(_INVERSE, len(values) + 1)[first]


class Words(NamedTuple):
    """The words of some texts, in order; a phrase lies within one piece."""

    data: np.ndarray  # the texts' bytes in lower case
    first: np.ndarray  # where each word begins and ends in them
    end: np.ndarray
    piece: np.ndarray  # number of the piece that it lies in
    mark: np.ndarray  # fingerprint


def words_of(texts: list[bytes]) -> Words:
    """The words of the texts; a line feed keeps them apart. Worked through in blocks that end between words."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = _KIND[data]
    word = kind == 0
    edges = np.flatnonzero(np.diff(np.r_[False, word].view(np.int8)))
    first, end = edges[::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[first] if len(first) else np.zeros(0, np.int32)
    mark = np.empty(len(first), np.uint64)
    lo = 0
    while lo < len(first):
        base = int(first[lo])
        hi = max(lo + 1, int(np.searchsorted(end, base + _SLICE, side="right")))
        found = stretches(data[base : int(end[hi - 1])].astype(np.uint64) + np.uint64(1), first[lo:hi] - base, end[lo:hi] - base)
        mark[lo:hi] = _mixed(found ^ ((end[lo:hi] - first[lo:hi]).astype(np.uint64) << np.uint64(48)))
        lo = hi
    return Words(data, first, end, piece, mark)


class Marker:
    """Fingerprints of the n-grams of some words in one language; ``bits`` below 64 only to provoke collisions in tests."""

    def __init__(self, words: Words, lang: str, bits: int = 64):
        self.words, self.bits = words, bits
        tongue = np.frombuffer(lang.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64) + np.uint64(1)
        self.lang = _mixed(stretches(tongue, np.zeros(1, np.int64), np.array([len(tongue)])))[0]

    def places(self, size: int) -> np.ndarray:
        """Where n-grams of ``size`` words begin."""
        piece = self.words.piece
        return np.flatnonzero(piece[: len(piece) - size + 1] == piece[size - 1 :]) if len(piece) >= size else np.zeros(0, np.int64)

    def marks(self, size: int, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.zeros(0, np.uint64)
        lo = at[0]  # powers for no more words than there are from the first to the last of them
        values = self.words.mark[lo : at[-1] + size]
        found = _mixed(stretches(values, at - lo, at - lo + size) + np.uint64(size))
        return _mixed(found ^ self.lang) >> np.uint64(64 - self.bits)


class Bits(NamedTuple):
    """Which fingerprints may be frequent: a bit table in blocks, all probes of a fingerprint in one block."""

    table: np.ndarray | None  # None lets everything through

    @staticmethod
    def probes(marks: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
        h = _mixed(marks + np.uint64(0x632BE59BD9B4E019))
        block = (h >> np.uint64(32)) % np.uint64(blocks)
        return block, [(h >> np.uint64(9 * i)) & np.uint64(BLOCK_BITS - 1) for i in range(PROBES - 1)] + [(marks >> np.uint64(3)) & np.uint64(BLOCK_BITS - 1)]

    def has(self, marks: np.ndarray) -> np.ndarray:
        if self.table is None:
            return np.ones(len(marks), bool)
        block, bits = self.probes(marks, len(self.table) * 8 // BLOCK_BITS)
        out = np.ones(len(marks), bool)
        for bit in bits:
            at = block * np.uint64(BLOCK_BITS) + bit
            out &= (self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def bit_table(frequent: DataFrame, max_bits: int = MAX_BITS) -> Bits:
    """The table of the column ``mark``: ``max_bits`` at most, a few bits a fingerprint below that.

    Each task sets one range of it; the driver puts the ranges together.
    """
    n = frequent.count()
    blocks = max(LEAST_BITS, min(max_bits, 1 << (max(1, 16 * n) - 1).bit_length())) // BLOCK_BITS
    ranges = min(blocks, 64)
    width = -(-blocks // ranges)

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, _ = Bits.probes(batch.column("mark").to_numpy().view(np.uint64), blocks)
            yield batch.append_column("part", pa.array((block // np.uint64(width)).astype(np.int32)))

    def fill(table: pa.Table) -> pa.Table:
        marks = table.column("mark").to_numpy().view(np.uint64)
        part = table.column("part")[0].as_py()
        block, bits = Bits.probes(marks, blocks)
        out = np.zeros(width * BLOCK_BITS, bool)
        for bit in bits:
            out[(block - np.uint64(part * width)) * np.uint64(BLOCK_BITS) + bit] = True
        return pa.table({"part": pa.array([part], pa.int32()), "table": pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())})

    found = frequent.select("mark").mapInArrow(ranged, "mark bigint, part int").groupBy("part").applyInArrow(fill, "part int, table binary").collect()
    table = np.zeros(ranges * width * BLOCK_BITS // 8, np.uint8)
    for r in found:
        lo = r["part"] * width * BLOCK_BITS // 8
        table[lo : lo + width * BLOCK_BITS // 8] = np.frombuffer(r["table"], np.uint8)
    return Bits(table[: blocks * BLOCK_BITS // 8])


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """Language, row numbers and texts, one language after another."""
    langs = batch.column("lang").to_pylist()
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    rows: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        rows.setdefault(UNKNOWN if lang is None else lang, []).append(i)
    for lang, at in rows.items():
        yield lang, np.array(at), [texts[i] or b"" for i in at]


def _candidates(marker: Marker, size: int, filters: dict[int, Bits]) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of the n-grams whose parts, of the longest filtered size, may all be frequent."""
    at = marker.places(size)
    known = max((n for n in filters if n < size), default=0)
    if known:
        may = np.zeros(len(marker.words.piece) + 1, bool)
        starts = marker.places(known)
        may[starts] = filters[known].has(marker.marks(known, starts))
        for shift in range(size - known + 1):
            at = at[may[at + shift]]
    return at, marker.marks(size, at)


def _counted(rows: DataFrame, sizes: range, filters: Broadcast, min_count: int, bits: int) -> DataFrame:
    """``mark, words, n`` of the fingerprints that occur often enough; ``sizes`` are counted in one pass."""

    def tally(pending: list[np.ndarray], size: int) -> pa.RecordBatch:
        marks, n = np.unique(np.concatenate(pending), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(marks.view(np.int64)), pa.array(np.full(len(marks), size, np.int32)), pa.array(n, pa.int64())], ["mark", "words", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[int, list[np.ndarray]] = {size: [] for size in sizes}
        for batch in arrow_slices(batches, limit=_SLICE):
            for lang, _, texts in _by_language(batch):
                marker = Marker(words_of(texts), lang, bits)
                for size in sizes:
                    pending[size].append(_candidates(marker, size, filters.value)[1])
                    if sum(map(len, pending[size])) > PENDING:
                        yield tally(pending[size], size)
                        pending[size] = []
        for size, left in pending.items():
            if left:
                yield tally(left, size)

    found = rows.select("lang", "text").mapInArrow(run, "mark bigint, words int, n bigint")
    return stored(found.groupBy("mark", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _equal_ids(words: Words) -> np.ndarray:
    """A number for each word, equal for words of equal bytes: fingerprints first, then checked against the text."""
    _, one, ids = np.unique(words.mark, return_index=True, return_inverse=True)
    size = words.end - words.first
    other = one[ids]
    wrong = size != size[other]
    same = np.flatnonzero(~wrong)
    ends = np.cumsum(size[same])
    lo = 0
    while lo < len(same):  # all bytes of all words beside those of the first word with that fingerprint, by blocks
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _SLICE, side="right")))
        part = same[lo:hi]
        n = size[part]
        starts = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(starts, n)
        differs = words.data[np.repeat(words.first[part], n) + inside] != words.data[np.repeat(words.first[other[part]], n) + inside]
        wrong[part] = np.bitwise_or.reduceat(differs, starts)
        lo = hi
    extra: dict[bytes, int] = {}
    for i in np.flatnonzero(wrong):  # a collision: by text
        word = words.data[words.first[i] : words.end[i]].tobytes()
        ids[i] = extra.setdefault(word, len(one) + len(extra))
    return ids


def _texts(words: Words, places: np.ndarray, size: int) -> tuple[np.ndarray, pa.Array]:
    """The phrases at ``places``, and the order in which they come: first those that stand in the text as they are written."""
    lo, hi = words.first[places], words.end[places + size - 1]
    plain = np.ones(len(places), bool)
    for k in range(1, size):
        begin = words.first[places + k]
        plain &= (begin - words.end[places + k - 1] == 1) & (words.data[begin - 1] == 32)
    order = np.argsort(~plain, kind="stable")
    n = (hi - lo)[plain]
    ends = np.cumsum(n)
    data = words.data[np.arange(int(n.sum())) + np.repeat(lo[plain] - (ends - n), n)]
    offsets = np.zeros(len(n) + 1, np.int32)
    offsets[1:] = ends
    found = [pa.StringArray.from_buffers(len(n), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))]
    between = []
    for place in places[~plain].tolist():  # several spaces or tabs between words
        at = zip(words.first[place : place + size].tolist(), words.end[place : place + size].tolist(), strict=True)
        between.append(b" ".join(words.data[x:y].tobytes() for x, y in at))
    return order, pa.concat_arrays([*found, pa.array(between, pa.binary()).cast(pa.string())])


def _rows(lang: str, phrases: pa.Array, size: int, n: pa.Array, doc_ids: pa.Array, places: pa.Array) -> pa.RecordBatch:
    langs = pa.array([lang]).take(pa.array(np.zeros(len(phrases), np.int64)))
    return pa.RecordBatch.from_arrays([langs, phrases, pa.array(np.full(len(phrases), size, np.int32)), n, doc_ids, places], ["lang", "phrase", "words", "n", "doc_id", "word"])


def _phrases(rows: DataFrame, sizes: range, filters: Broadcast, bits: int) -> DataFrame:
    """``lang, phrase, words, n, doc_id, word``: exact counts of the phrases that pass the filters, and how many words a language has.

    The latter is the row of the empty phrase. ``doc_id`` and ``word`` point
    to the occurrence of the least id, there to the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, limit=_TEXT_SLICE):
            for lang, numbers, texts in _by_language(batch):
                words = words_of(texts)
                marker, ids = Marker(words, lang, bits), _equal_ids(words)
                begins = np.searchsorted(words.first, np.cumsum([0, *(len(t) + 1 for t in texts)][:-1]))  # each text's first word
                none = pa.nulls(1, pa.int64())
                yield _rows(lang, pa.array([""]), 0, pa.array([len(ids)], pa.int64()), batch.column("doc_id").take(none), none)
                for size in sizes:
                    at, marks = _candidates(marker, size, filters.value)
                    keep = filters.value[size].has(marks)
                    at, marks = at[keep], marks[keep]
                    if not len(at):
                        continue
                    _, one, group = np.unique(marks, return_index=True, return_inverse=True)
                    pointed = at[one][group]
                    wrong = np.zeros(len(at), bool)
                    for k in range(size):
                        wrong |= ids[at + k] != ids[pointed + k]
                    # Those told apart by their text come one by one.
                    places = np.r_[at[one], at[wrong]]
                    times = np.r_[np.bincount(group[~wrong], minlength=len(one)), np.ones(int(wrong.sum()), np.int64)]
                    order, phrases = _texts(words, places, size)
                    places, times = places[order], times[order]
                    text_of = np.searchsorted(begins, places, side="right") - 1
                    ids_of = batch.column("doc_id").take(pa.array(numbers[text_of], pa.int64()))
                    yield _rows(lang, phrases, size, pa.array(times, pa.int64()), ids_of, pa.array(places - begins[text_of], pa.int64()))

    kind = field_type(rows, "doc_id")
    found = rows.select("doc_id", "lang", "text").mapInArrow(run, f"lang string, phrase string, words int, n bigint, doc_id {kind}, word bigint")
    # A slice points to its first occurrence, not to the one of its least id; over slices the least is kept.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "word"))
    return found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"), least.alias("at")).select("lang", "phrase", "words", "n", "at.doc_id", "at.word")


def frequent_phrases(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, bits: int = 64, max_bits: int = MAX_BITS
) -> DataFrame:
    """``lang, phrase, words, n, doc_id, word``: every phrase of up to ``max_words`` words that a language has ``min_count`` times or more.

    ``n`` is exact and counts overlapping occurrences. ``doc_id`` and ``word``
    point to one occurrence. Null texts are empty, rows without a language are
    in ``und``. The row of the empty phrase holds the number of all words of a
    language that has any row. Runs a job and a broadcast for words, for
    pairs and for longer phrases; the result reads the table once more.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    )
    filters: dict[int, Bits] = {}
    for sizes in [range(n, n + 1) for n in (1, 2) if n <= max_words] + ([range(3, max_words + 1)] if max_words > 2 else []):
        shared = spark.sparkContext.broadcast(dict(filters))  # MAX_BITS each
        found = _counted(rows, sizes, shared, min_count, bits)
        shared.unpersist()
        for size in sizes:
            filters[size] = bit_table(found.where(F.col("words") == size), max_bits)
    shared = spark.sparkContext.broadcast(filters)
    out = stored(_phrases(rows, range(1, max_words + 1), shared, bits).where((F.col("words") == 0) | (F.col("n") >= min_count)))
    shared.unpersist()
    return out


def collocations(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, **parameters
) -> DataFrame:
    """Each language's first ``top`` phrases of two words or more: ``lang, rank, phrase, a, l, r, n, score, doc_id, word``.

    A cut after a phrase's first k words scores ``floor(1000 * a * n / (l *
    r))`` for its count a, the counts l and r of both parts and the language's
    n words; the lowest cut counts, of equal ones the earliest. A phrase
    inside a longer one that occurs as often is dropped. Order: score, then
    count, falling, then phrase by UTF-8 bytes. ``doc_id`` and ``word`` point
    to one occurrence. Empty tables and texts without words give no rows.
    """
    found = frequent_phrases(docs, id_col, text_col, lang_col, min_count, max_words, **parameters)
    counts = found.where("words > 0")
    parts = F.split("phrase", " ")
    joined = lambda first, size: F.array_join(F.slice(parts, first, size), " ")
    # What a phrase of one word less and the same count would be dropped for; any longer phrase implies one of these.
    inner = counts.where("words > 2").select("lang", F.explode(F.array(joined(F.lit(1), F.col("words") - 1), joined(F.lit(2), F.col("words") - 1))).alias("phrase"), F.col("n").alias("a"))
    cuts = counts.where("words > 1").select(
        "lang", "phrase", F.col("n").alias("a"), "doc_id", "word",
        F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(k.alias("k"), joined(F.lit(1), k).alias("left"), joined(k + 1, F.col("words") - k).alias("right")))).alias("cut"),
    ).join(inner.distinct(), ["lang", "phrase", "a"], "left_anti")
    of = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
    totals = found.where("words = 0").select("lang", F.col("n").alias("total"))
    cuts = cuts.select("lang", "phrase", "a", "doc_id", "word", "cut.*").join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(totals, "lang")
    # Up to 38 digits, exact: the quotient is 1000 * n / min_count at most, because l and r are a at least.
    score = F.expr("CAST((CAST(1000 * a AS DECIMAL(19,0)) * CAST(total AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", F.col("total").alias("n"), "doc_id", "word")).alias("best")).select("lang", "phrase", "best.*")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # A hot language is first ranked in shares, whose first rows hold all of its first rows.
    shares = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession)))
    few = scored.withColumn("share", shares).withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id", "word")
