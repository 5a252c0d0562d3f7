"""Fuzzy line deduplication by MinHash.

Lines are compared in lower case (A-Z) with white space runs as one space.
A line's signature holds, for each of ``BANDS * ROWS`` hash functions, the
least hash of its character shingles. Distinct lines that agree on all rows
of a band meet in a bucket. The candidates' exact shingle sets are compared,
pairs of Jaccard similarity ``threshold`` or more link, and a distributed
union-find keeps the first line of each component in the order of document
id, text hash and line number.

With 9 bands of 5 rows a pair of similarity 0.8 meets with probability 0.972,
one of 0.85 with 0.995. Lines that share a common vocabulary meet by chance, the
more lines the more often. So each line takes along, with about a bit for each
shingle, whether the shingles of each class are odd in number; pairs that these
parities or the sizes rule out go where they meet, before any pair is written or
a text is fetched. In a bucket of up to ``SMALL_BUCKET`` lines every pair is compared. A
larger one first compares each line with two leaders, its least and its
greatest line, which joins a large group of near copies without its pairs.
Where a bucket is still in several components after that, an exact search
compares the rest: all its pairs of lines not yet connected, by blocks of lines
that several tasks share out. The lines of such buckets also meet by ``REST_BANDS``
bands of ``REST_ROWS`` rows, which finds a pair of 0.8 in no common bucket with
probability 0.9995. Links found there join components, not lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.collocations import Bits, bit_table
from tablescout.llm.common import arrow_slices, discard, field_type, stored, utf8
from tablescout.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 9, 5
SMALL_BUCKET = 64
BINS = 128  # of a line's sketch
_BLOCK = 1 << 16  # shingles hashed at a time
_SLICE = 1 << 21  # bytes of text in which a line is signed once
_SETS = 1 << 19  # bytes of lines whose shingles are held at a time
PARITIES = 1 << 10  # classes of shingles whose parities are compared, if not set by the line's size
LEAST_PARITIES, MOST_PARITIES = 1 << 6, 1 << 14
REST_BANDS, REST_ROWS = 32, 7  # of the lines in large buckets that stay apart
BLOCK_LINES = 1 << 11  # of a large bucket, compared with one another in a task
_PAIRS = 1 << 16  # pairs whose parities are held at a time
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\v\f\r", b"abcdefghijklmnopqrstuvwxyz    ")


def normal(line: str) -> bytes:
    """The line as it is compared; empty if blank."""
    return _lines(line.encode("utf-8", "surrogatepass"))[0]


def node(line: bytes) -> int:
    """A normalised line's signed 64-bit identity."""
    return int.from_bytes(xxhash.xxh3_64_digest(line), "big", signed=True)


def shingles(line: str, size: int = SHINGLE) -> set[str]:
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def _shingle_hashes(lines: list[bytes], size: int = SHINGLE) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """By blocks of lines: which they are, the hash of every shingle of each in turn, and where each line's shingles start."""
    text = [x.decode("utf-8", "surrogatepass").ljust(size, "\0") for x in lines]  # a shorter line is one shingle, padded with zeros
    lengths = np.fromiter(map(len, text), np.int64, len(text))
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(text):  # a very long line is a block
        before = int(ends[lo] - lengths[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, before + _BLOCK, side="right")))
        codes = np.frombuffer("".join(text[lo:hi]).encode("utf-32-le", "surrogatepass"), np.uint32)
        h = np.zeros(len(codes) - size + 1, np.uint64)
        shifted = np.empty_like(h)
        for k in range(size):
            h ^= codes[k : k + len(h)]
            h *= np.uint64(0x9E3779B97F4A7C15)
            np.right_shift(h, np.uint64(29), out=shifted)
            h ^= shifted
        inside = np.ones(len(h), bool)
        inside[(ends[lo : hi - 1, None] - before - np.arange(1, size)).ravel()] = False  # these would reach into the next line
        yield slice(lo, hi), h[inside], np.r_[0, np.cumsum(lengths[lo:hi] - size + 1)[:-1]]
        lo = hi


def _distinct(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted hashes of the different shingles of each line of a block, and how many each has."""
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(h)], strict=True):
        h[a:b].sort()
    new = np.r_[True, h[1:] != h[:-1]]
    new[starts] = True
    return h[new], np.add.reduceat(new, starts, dtype=np.int64)


def _band_keys(h: np.ndarray, starts: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """One row of ``bands`` bucket keys (signed 64 bits) for each line, whose shingles start at ``starts``."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    h = (h >> np.uint64(16)).astype(np.uint32)
    high, x, y = h >> np.uint32(15), np.empty_like(h), np.empty_like(h)
    out = np.empty((len(starts), bands), np.int64)
    for band in range(bands):
        key = np.full(len(starts), band, np.uint64)
        for i in range(band * rows, band * rows + rows):
            np.multiply(h, factor[i], out=x)
            np.multiply(high, factor[-1 - i], out=y)
            y += shift[i]
            x ^= y
            key = (key ^ np.minimum.reduceat(x, starts)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        out[:, band] = key.view(np.int64)
    return out


def parities(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each set a row of longs: whether the count of shingles in each of ``PARITIES`` classes is odd.

    Sets that differ in d shingles differ in d bits at most.
    """
    of = np.repeat(np.arange(len(ends)) * PARITIES, np.diff(ends, prepend=0))
    odd = np.bincount(of + (tokens >> np.uint64(50)).astype(np.int64) % PARITIES, minlength=len(ends) * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, PARITIES), axis=1).view(np.int64)


def signatures(
    lines: list[bytes], size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, seed: int = 5, dense: int = 1
) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each line that is not empty: a row of ``bands`` bucket keys, the number of its different shingles, and their parities.

    The number of classes is a power of two, ``dense`` times 0.7 to 1.4 times
    that of shingles within the bounds. Halves folded on one another are the
    parities of half as many classes, so that lines of similar size can be
    compared.
    """
    keys, n, width, odd = np.zeros((len(lines), bands), np.int64), np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int64), []
    for at, h, starts in _shingle_hashes(lines, size):
        h, count = _distinct(h, starts)
        n[at] = count
        keys[at] = _band_keys(h, np.cumsum(count) - count, bands, rows, seed)
        classes = dense << np.ceil(np.log2(count / 1.4)).astype(np.int64).clip(0)
        classes = classes.clip(LEAST_PARITIES, MOST_PARITIES)
        width[at] = classes // 8
        of = np.repeat(np.cumsum(classes) - classes, count)
        of += (h >> np.uint64(50)).view(np.int64) & np.repeat(classes - 1, count)
        odd.append(np.packbits(np.bincount(of, minlength=int(classes.sum())).astype(np.uint8) & 1))
    ends = pa.array(np.r_[0, np.cumsum(width)], pa.int32())
    return keys, n, pa.BinaryArray.from_buffers(pa.binary(), len(lines), [None, ends.buffers()[1], pa.py_buffer(np.concatenate([*odd, np.zeros(0, np.uint8)]))])


def _spaced(line: bytes) -> bytes:
    line = line.strip(b" ")
    return b" ".join(line.split()) if b"  " in line else line


def _lines(text: bytes) -> list[bytes]:
    """The lines as they are compared; blank ones are empty."""
    return [_spaced(x) for x in text.translate(_FOLD).split(b"\n")]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def signed_lines(rows: DataFrame, size: int = SHINGLE, bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """``doc_id, text_key, line_no, node, keys, n, odd`` of every line that is not blank.

    ``keys, n, odd`` are the line's ``signatures`` where it first occurs in a
    slice of the table, and empty or null where it occurs again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, limit=_SLICE):
            of, number, nodes, new, found = [], [], [], [], {}
            for row, text in enumerate(utf8(batch.column("text"))):
                for n, line in enumerate(_lines(text)):
                    if line:
                        key = node(line)
                        new.append(key not in found)
                        found.setdefault(key, line)
                        of.append(row), number.append(n), nodes.append(key)
            if not of:
                continue
            keys, n, odd = signatures(list(found.values()), size, bands, band_rows)
            ends = np.r_[0, np.cumsum(new)] * bands
            at = pa.array(of, pa.int64())
            flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))
            once = pa.array(np.cumsum(new) - 1, mask=~np.array(new))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(number, pa.int32()), pa.array(nodes, pa.int64()), flat, pa.array(n, pa.int32()).take(once), odd.take(once)],
                ["doc_id", "text_key", "line_no", "node", "keys", "n", "odd"],
            )

    return rows.mapInArrow(run, f"doc_id {field_type(rows, 'doc_id')}, text_key bigint, line_no int, node bigint, keys array<bigint>, n int, odd binary")


def buckets(rows: DataFrame, signed: DataFrame) -> DataFrame:
    """``node, keys, n, odd``: the bucket keys of the lines of ``rows``, each at least once, and what tells unlike lines apart."""
    return signed.where(F.size("keys") > 0).select("node", "keys", "n", "odd")


class _Sketched:
    """Lines' sizes and parities, in tables by the number of classes. Null or zero: not known."""

    def __init__(self, n: pa.Array, odd: pa.Array):
        self.n = pc.fill_null(n, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.width = pc.fill_null(pc.binary_length(odd), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.place, self.tables = np.zeros(len(n), np.int64), {}
        for width in np.unique(self.width[self.width > 0]).tolist():
            at = np.flatnonzero(self.width == width)
            self.place[at] = np.arange(len(at))
            self.tables[width] = np.frombuffer(odd.take(pa.array(at)).buffers()[2], np.uint64, len(at) * width // 8).reshape(-1, width // 8)

    def _rows(self, at: np.ndarray, width: int) -> np.ndarray:
        """The parities of lines of ``width`` bytes, or of twice that, folded."""
        out = np.empty((len(at), width // 8), np.uint64)
        for own in (width, 2 * width):
            of = self.width[at] == own
            if of.any():
                found = self.tables[own][self.place[at[of]]]
                out[of] = found if own == width else found[:, : width // 8] ^ found[:, width // 8 :]
        return out

    def possible(self, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
        """Which of the pairs of lines can reach the threshold, by their sizes and parities.

        Such sets differ in at most ``(1 - t) / (1 + t) * (n + m)`` shingles,
        hence in no more parities.
        """
        n, m = self.n[i], self.n[j]
        keep = np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9
        known = (self.width[i] > 0) & (self.width[j] > 0)
        least, most = np.minimum(self.width[i], self.width[j]), (1 - threshold) / (1 + threshold) * (n + m) + 1e-9
        at = np.flatnonzero(keep & known & (np.maximum(self.width[i], self.width[j]) <= 2 * least))
        for width in np.unique(least[at]).tolist():
            of, step = at[least[at] == width], max(1, _PAIRS * 64 // width)
            for lo in range(0, len(of), step):
                part = of[lo : lo + step]
                differ = np.bitwise_count(self._rows(i[part], width) ^ self._rows(j[part], width)).sum(axis=1, dtype=np.int64)
                keep[part] = differ <= most[part]
        return keep | ~known


def _neighbours(group: np.ndarray, n: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs ``i < j`` within a group whose sizes allow the threshold; rows are in the order of ``group`` and ``n``."""
    i = np.arange(len(group))
    for d in range(1, len(group)):
        i = i[: np.searchsorted(i, len(group) - d)]
        i = i[(group[i + d] == group[i]) & ((n[i] == 0) | (n[i] >= threshold * n[i + d] - 1e-9))]
        if not len(i):
            return
        yield i, i + d


def _gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, about ``_PAIRS`` at a time."""
    held, n = [], 0
    for i, j in pairs:
        held.append((i, j))
        n += len(i)
        if n >= _PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches again, cut where a group of ``by`` ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(c).to_numpy() for c in by]
        starts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if held and any(held[-1].column(c)[-1].as_py() != x[0] for c, x in zip(by, columns, strict=True)):
            starts = np.r_[0, starts]
        if not len(starts):
            held.append(batch)
            continue
        cut = int(starts[-1])
        yield from pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()
        held = [batch.slice(cut)]
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    return rows.repartition(*by).sortWithinPartitions(*by, "n", "node")


def _pair_batch(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])
    return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b)], ["key", "a", "b"])


def _shared(signed: DataFrame, differ: str) -> Broadcast:
    """The bit table of the bucket keys whose rows differ in the column ``differ``, of a fixed size whatever the input."""
    rows = signed.select(F.explode("keys").alias("key"), differ)
    both = stored(rows.groupBy("key").agg(F.min(differ).alias("low"), F.max(differ).alias("high")).where("low <> high").select(F.col("key").alias("mark")))
    found = signed.sparkSession.sparkContext.broadcast(bit_table(both))
    discard(both)
    return found


def _entries(signed: DataFrame, shared: Broadcast, columns: list[str]) -> DataFrame:
    """``key`` and ``columns`` for each bucket key that the bit table lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            flat = keys.flatten()
            keep = pa.array(shared.value.has(flat.to_numpy(zero_copy_only=False).view(np.uint64)))
            of = pc.list_parent_indices(keys).filter(keep)
            yield pa.RecordBatch.from_arrays([flat.filter(keep), *(batch.column(c).take(of) for c in columns)], ["key", *columns])

    return signed.select("keys", *columns).mapInArrow(run, "key bigint, " + ", ".join(f"{c} {field_type(signed, c)}" for c in columns))


def meetings(signed: DataFrame, threshold: float = THRESHOLD, small: int = SMALL_BUCKET) -> DataFrame:
    """``key, a, b``: the pairs ``a < b`` of lines in a bucket that can reach the threshold, ``key`` null; of more than ``small`` lines, only pairs with the leaders, and each line as ``key, a``.

    Most buckets hold one line. Those that do not are found by the least and
    greatest line of each; a bit table of their keys, of a fixed size whatever
    the input, then lets the other lines' keys stay where they are.
    """
    shared = _shared(signed, "node")
    for column, kind in (("n", "int"), ("odd", "binary")):
        if column not in signed.columns:
            signed = signed.withColumn(column, F.lit(None).cast(kind))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches, ["key"]):
            key, node = (batch.column(c).to_numpy() for c in ("key", "node"))
            once = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
            of = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
            lines = np.bincount(of[once])
            once &= lines[of] > 1
            key, node, of = key[once], node[once], of[once]
            if not len(key):
                continue
            line = _Sketched(*(batch.column(c).filter(pa.array(once)) for c in ("n", "odd")))
            few = lines[of] <= small
            at = np.flatnonzero(few)
            pairs = [(at[i], at[j]) for i, j in _gathered(_neighbours(of[at], line.n[at], threshold))]
            many = np.flatnonzero(~few)
            if len(many):
                starts = np.flatnonzero(np.r_[True, of[many][1:] != of[many][:-1]])
                for part in np.split(many, starts[1:]):
                    for leader in (part[node[part].argmin()], part[node[part].argmax()]):
                        pairs.append((np.full(len(part) - 1, leader), part[part != leader]))
                yield pa.RecordBatch.from_arrays([pa.array(key[many]), pa.array(node[many]), pa.nulls(len(many), pa.int64())], ["key", "a", "b"])
            for i, j in pairs:
                keep = line.possible(i, j, threshold)
                yield _pair_batch(node, i[keep], j[keep])

    met = _dealt(_entries(signed, shared, ["node", "n", "odd"]), "key")
    out = stored(met.mapInArrow(meet, "key bigint, a bigint, b bigint"))
    shared.unpersist()
    return out


def _lines_of(rows: DataFrame, wanted: Bits = Bits(None)) -> DataFrame:
    """``node, line``: the normalised lines that pass the bit table, each at least once."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            found = {}
            for text in utf8(batch.column("text")):
                for line in _lines(text):
                    if line:
                        found[node(line)] = line
            nodes = np.fromiter(found, np.int64, len(found))
            keep = shared.value.has(nodes.view(np.uint64))
            text = pa.array([x for x, k in zip(found.values(), keep.tolist(), strict=True) if k], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), text.cast(pa.string())], ["node", "line"])

    return rows.mapInArrow(run, "node bigint, line string")


def shingle_sets(lines: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted hashes of each line's different shingles, one line after another, and where each line's end."""
    sets, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, h, starts in _shingle_hashes(lines, size):
        for found, each in zip((sets, ends), _distinct(h, starts), strict=True):
            found.append(each)
    return np.concatenate(sets), np.cumsum(np.concatenate(ends))


def sketches(lines: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The number of each line's different shingles, and how many of them fall into each of ``BINS`` bins, a byte each: 255 is 255 or more."""
    h, ends = shingle_sets(lines, size)
    n = np.diff(ends, prepend=0)
    at = np.repeat(np.arange(len(n)) * BINS, n) + (h >> np.uint64(20)).astype(np.int64) % BINS
    return n, np.minimum(np.bincount(at, minlength=len(n) * BINS), 255).astype(np.uint8).reshape(-1, BINS)


def sketch(line: str, size: int = SHINGLE) -> tuple[int, bytes]:
    n, bins = sketches([line.encode("utf-8", "surrogatepass")], size)
    return int(n[0]), bins.tobytes()


def _sketched(lines: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``node, line, n, bins``: with the sketch of each line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, "line", _SETS):
            n, bins = sketches(utf8(batch.column("line")), size)
            yield batch.append_column("n", pa.array(n, pa.int32())).append_column("bins", pa.array([x.tobytes() for x in bins], pa.binary()))

    return lines.mapInArrow(run, "node bigint, line string, n int, bins binary")


def most_shared(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The most shingles that sets of sketches ``x`` and ``y`` (rows) can share: the lesser count of each bin, and what ``x``, of size ``n``, holds beyond full bins."""
    return np.minimum(x, y).sum(axis=1, dtype=np.int64) + n - x.sum(axis=1, dtype=np.int64)


def _possible(pairs: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` that neither their sizes nor their sketches rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("bins_a", "bins_b"))
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            most = most_shared(x, y, n)
            yield batch.select(["a", "b"]).filter(pa.array(most >= threshold * (n + m - most), pa.bool_()))

    sizes, bins = lines.select("node", "n"), lines.select("node", "bins")
    near = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
    near = near.where(F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-9)
    near = near.join(bins.toDF("a", "bins_a"), "a").join(bins.toDF("b", "bins_b"), "b")
    return near.select("a", "b", "n_a", "n_b", "bins_a", "bins_b").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, lines: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """The pairs ``a, b`` whose shingle sets reach the threshold; ``lines`` holds ``node, line, n, bins``.

    Pairs that sizes or sketches rule out go before their texts are fetched.
    Shingles are told apart by 64-bit hashes. Each step is written out: in one
    stage, steps in Python would each keep a worker per task, and its memory.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, "line_a", _SETS):
            place: dict[bytes, int] = {}
            x, y = ([place.setdefault(t, len(place)) for t in utf8(batch.column(c))] for c in ("line_a", "line_b"))
            h, ends = shingle_sets(list(place), size)
            sets = np.split(h, ends[:-1])
            common = np.empty(len(x), np.int64)
            for k, (i, j) in enumerate(zip(x, y, strict=True)):
                both = np.concatenate((sets[i], sets[j]))
                both.sort()
                common[k] = np.count_nonzero(both[1:] == both[:-1])
            n = np.diff(ends, prepend=0)
            yield batch.select(["a", "b"]).filter(pa.array(common >= threshold * (n[x] + n[y] - common), pa.bool_()))

    near = stored(_possible(pairs, lines, threshold))
    text = lines.select("node", "line")
    both = near.join(text.toDF("a", "line_a"), "a").join(text.toDF("b", "line_b"), "b")
    links = stored(both.select("a", "b", "line_a", "line_b").mapInArrow(verify, "a bigint, b bigint"))
    discard(near)
    return links


def _apart(lines: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``node, line, component, keys, n, odd`` of ``node, line, component``: signed by ``REST_BANDS`` bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches, "line", _SETS):
            keys, n, odd = signatures(utf8(batch.column("line")), size, REST_BANDS, REST_ROWS, seed=6, dense=4)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * REST_BANDS, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat, pa.array(n, pa.int32()), odd], ["node", "line", "component", "keys", "n", "odd"])

    return lines.select("node", "line", "component").mapInArrow(run, "node bigint, line string, component bigint, keys array<bigint>, n int, odd binary")


class _Joined:
    """Links among a task's lines that join components: pairs of connected lines are not compared."""

    def __init__(self, lines: pa.Array, component: np.ndarray, threshold: float, size: int):
        self.lines, self.component, self.threshold, self.size = lines, component.copy(), threshold, size
        self.sets: dict[int, np.ndarray] = {}
        self.held = 0

    def _set(self, k: int) -> np.ndarray:
        if k not in self.sets:
            if self.held > _SETS:
                self.sets, self.held = {}, 0
            self.sets[k] = shingle_sets(utf8(self.lines.slice(k, 1)), self.size)[0]
            self.held += len(self.sets[k])
        return self.sets[k]

    def links(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs are links and join two components."""
        keep = np.zeros(len(i), bool)
        for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            if self.component[a] != self.component[b]:
                x, y = self._set(a), self._set(b)
                both = np.concatenate((x, y))
                both.sort()
                common = np.count_nonzero(both[1:] == both[:-1])
                if common >= self.threshold * (len(x) + len(y) - common):
                    self.component[self.component == self.component[b]] = self.component[a]
                    keep[k] = True
        return keep


def shared_rare_shingles(lines: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, members: DataFrame | None = None, joining: bool = False) -> DataFrame:
    """Pairs ``a < b`` of ``node, line, component`` rows that differ in component and can reach the threshold.

    No pair of a bucket of ``members`` (``key, node``) that reaches it is
    missing; without ``members`` all lines are one bucket. Lines in no common
    bucket that agree in one of the rarer combinations of shingles, the rows of
    a further band, are found as well. A bucket is cut into blocks of lines of
    about one size, and each two blocks are compared in a task of their own.
    With ``joining`` the shingle sets of the pairs are compared there, and only
    links that join components come back, so that a group of near copies gives
    about as many rows as it has lines.
    """
    signed = stored(_apart(lines, size))
    line = signed.select("node", "component", "n", "odd", *["line"] * joining)
    if members is None:
        members = line.select(F.lit(0).cast("bigint").alias("key"), "node")
    shared = _shared(signed, "component")
    rows = members.select("key", "node").union(_entries(signed, shared, ["node"])).join(line, "node")
    bucket = Window.partitionBy("key")
    rows = rows.withColumn("lines", F.count("*").over(bucket)).where("lines > 1")
    rows = rows.withColumn("block", F.floor((F.row_number().over(bucket.orderBy("n", "node")) - 1) / BLOCK_LINES))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("lines") - 1) / BLOCK_LINES))))
    rows = rows.select("key", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "node", "component", "n", "odd", "block", *["line"] * joining)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = ["key", "first", "second"]
        for batch in _whole_groups(batches, by):
            node, component, block, *groups = (batch.column(c).to_numpy() for c in ("node", "component", "block", *by))
            line = _Sketched(batch.column("n"), batch.column("odd"))
            of = np.cumsum(np.r_[True, np.any([g[1:] != g[:-1] for g in groups], axis=0)])
            one = groups[1] == groups[2]
            joined = _Joined(batch.column("line"), component, threshold, size) if joining else None
            component = joined.component if joined else component
            for i, j in _gathered(_neighbours(of, line.n, threshold)):
                keep = (component[i] != component[j]) & (one[i] | (block[i] != block[j]))
                i, j = i[keep], j[keep]
                keep = line.possible(i, j, threshold)
                i, j = i[keep], j[keep]
                if joined:
                    keep = joined.links(i, j)
                    i, j = i[keep], j[keep]
                yield _pair_batch(node, i, j)

    met = _dealt(rows, "key", "first", "second")
    out = stored(met.mapInArrow(meet, "key bigint, a bigint, b bigint").select("a", "b").distinct())
    shared.unpersist()
    discard(signed)
    return out


def line_components(
    rows: DataFrame, signed: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, small: int = SMALL_BUCKET
) -> DataFrame:
    """``node, component`` of every line linked to a different one; ``signed`` is what ``signed_lines`` says of ``rows``."""
    met = meetings(buckets(rows, signed), threshold, small)
    pairs = stored(met.where("b is not null").select("a", "b").distinct())
    many = met.where("b is null").select("key", F.col("a").alias("node"))
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).union(many.select("node")).distinct())
    found = _lines_of(rows, bit_table(wanted.select(F.col("node").alias("mark"))))
    lines = stored(_sketched(found.join(wanted, "node", "left_semi").dropDuplicates(["node"]), size))
    discard(wanted)
    links = verified(pairs, lines, threshold, size)
    labels = connected_components(links)
    discard(pairs, links)

    placed = many.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    members = stored(placed.join(split, "key"))
    discard(met)
    if members.isEmpty():
        discard(lines, members)
        return labels
    apart = stored(members.select("node", "component").distinct())
    near = stored(lines.join(apart, "node"))
    discard(lines)
    found = shared_rare_shingles(near, threshold, size, members, joining=True)
    links = found
    for end in ("a", "b"):
        links = links.join(apart.toDF(end, f"component_{end}"), end)
    joined = connected_components(links.select("component_a", "component_b")).toDF("component", "least")
    discard(near, apart, found, members)
    return labels.join(joined, "component", "left").select("node", F.coalesce("least", "component").alias("component")).union(joined)


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, band_rows: int = ROWS, small: int = SMALL_BUCKET
) -> DataFrame:
    """One row per distinct (id, text) of ``docs``: ``doc_id, text_key, n_lines, dropped``.

    ``n_lines`` counts the lines that are not blank, ``dropped`` lists the
    numbers (from 0, by line feeds) of those that repeat an earlier line.
    Blank lines never go. Rows alike in id and text count as one document.
    """
    rows = _keyed(docs, id_col, text_col)
    signed = stored(signed_lines(rows, size, bands, band_rows))
    labels = line_components(rows, signed, threshold, size, small)
    lines = stored(signed.select("doc_id", "text_key", "line_no", "node").distinct())
    discard(signed)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "line_no")
    linked = labels.union(labels.select("component", "component").distinct())  # with each component's least line
    several = lines.groupBy("node").agg(F.count("*").alias("n")).join(linked, "node", "left").where("n > 1 OR component IS NOT NULL")
    several = several.select("node", F.coalesce("component", "node").alias("component"))
    alike = stored(lines.join(several, "node").select("doc_id", "text_key", "line_no", "component"))
    least = alike.groupBy("component").agg(F.min(place).alias("kept"))
    gone = alike.join(least, "component").where(~place.eqNullSafe(F.col("kept"))).select("doc_id", "text_key", "line_no")
    per_doc = gone.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list("line_no")).alias("dropped"))
    counts = rows.select("doc_id", "text_key").distinct().alias("d").join(
        lines.groupBy("doc_id", "text_key").agg(F.count("*").alias("n_lines")).alias("c"),
        F.expr("d.doc_id <=> c.doc_id AND d.text_key = c.text_key"), "left",
    ).select("d.*", F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines")).alias("d")
    return counts.join(per_doc.alias("g"), F.expr("d.doc_id <=> g.doc_id AND d.text_key = g.text_key"), "left").select(
        "d.doc_id", "d.text_key", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")
    )


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one; all columns stay.

    A document that loses every line that is not blank goes. Null and blank
    texts, and documents without repeated lines, come back unchanged. Rows
    alike in id and text are treated alike.
    """
    found = dropped_lines(docs, id_col, text_col, **parameters).where(F.size("dropped") > 0)
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_lines", "dropped").alias("_f")
    text = F.col(f"_d.`{text_col}`")
    joined = docs.alias("_d").join(found, F.col(f"_d.`{id_col}`").eqNullSafe(F.col("_f._id")) & (F.xxhash64(text.cast("string")) == F.col("_f._key")), "left")
    parts = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    gone = F.map_from_arrays("_f.dropped", "_f.dropped")
    kept = F.array_join(F.transform(F.filter(parts, lambda p: ~F.map_contains_key(gone, p["i"])), lambda p: p["x"]), "\n")
    new = F.when(F.col("_f._key").isNull(), text).otherwise(kept)
    return joined.where(F.col("_f._key").isNull() | (F.size("_f.dropped") < F.col("_f.n_lines"))).select(
        *[(new if c == text_col else F.col(f"_d.`{c}`")).alias(c) for c in docs.columns]
    )
