"""Benchmark decontamination by a broadcast set of n-gram hashes.

Benchmark items become windows of ``window_words`` consecutive normalised
words (a shorter item is one window of all its words). Their hashes are
broadcast, ``max_windows`` at a time so that the broadcast has a fixed bound
whatever the size of the benchmark; further windows take further passes over
the same rows in the same stage. Documents are scanned in whole: numpy hashes
every word and every window, a bitmap and a sorted array of the benchmark's
hashes pick candidates, and each is verified word by word. Nothing of the
documents is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablescout.llm.common import arrow_slices, utf8

WINDOW_WORDS = 10
MAX_WINDOWS = 1_000_000
_SEGMENT = 1 << 20  # bytes whose words are hashed at a time
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BITS = 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


class Words(NamedTuple):
    """The words of a run of texts: lowered bytes, places, text number and hash of each word."""

    lowered: bytes
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, base, np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS: list[np.ndarray] = []


def words_of(texts: list[bytes]) -> Words:
    """Lower A-Z and find the runs of other than ASCII non-alphanumeric characters."""
    joined = b"\0".join([*texts, b""])
    low = _LOWER[np.frombuffer(joined, np.uint8)]
    inside = np.concatenate(([False], _WORD[low], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    limits = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    hashes = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _SEGMENT, side="right")))
        size = int(ends[hi - 1] - starts[lo])
        if not _POWERS or len(_POWERS[0]) < size:
            _POWERS[:] = _powers(max(size, _SEGMENT))
        sums = np.zeros(size + 1, np.uint64)
        part = low[starts[lo] : ends[hi - 1]].astype(np.uint64)
        part += np.uint64(1)
        part *= _POWERS[0][:size]
        np.cumsum(part, out=sums[1:])
        s, e = starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo]
        h = (sums[e] - sums[s]) * _POWERS[1][s]
        h ^= h >> np.uint64(29)
        h *= _MIX
        hashes[lo:hi] = h ^ (h >> np.uint64(32))
        lo = hi
    if len(_POWERS) and len(_POWERS[0]) > _SEGMENT:
        _POWERS.clear()  # tables for one giant word are not kept
    return Words(low.tobytes(), starts, ends, np.searchsorted(limits, starts, side="right"), hashes)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out *= _STEP
        out += hashes[j : j + count]
    out ^= out >> np.uint64(31)
    out *= _MIX
    return out


class Windows(NamedTuple):
    """Benchmark windows of one length: hashes, a bitmap of their top bits, and the words with their items."""

    keys: np.ndarray
    seen: np.ndarray
    known: dict[int, list[tuple[bytes, list[str]]]]


def build_index(rows: list[tuple[int, bytes, list[str]]]) -> dict[int, Windows]:
    """``rows``: number of words, the words joined by a space, the ids of the items that hold them."""
    known: dict[int, dict[int, list[tuple[bytes, list[str]]]]] = defaultdict(lambda: defaultdict(list))
    for n, window, items in rows:
        known[n][int(window_hashes(words_of([window]).hashes, n)[0])].append((window, items))
    out = {}
    for n, by_hash in known.items():
        keys = np.sort(np.fromiter(by_hash, np.uint64, len(by_hash)))
        seen = np.zeros(1 << _BITS, bool)
        seen[keys >> np.uint64(64 - _BITS)] = True
        out[n] = Windows(keys, seen, dict(by_hash))
    return out


def find_hits(words: Words, index: dict[int, Windows], hit: np.ndarray, items: dict[int, set[str]]) -> None:
    """Mark in ``hit`` every word inside an occurrence of a window; add the items found to ``items`` by text."""
    for n, windows in index.items():
        hashes = window_hashes(words.hashes, n)
        at = np.flatnonzero(windows.seen[hashes >> np.uint64(64 - _BITS)])
        at = at[words.text[at] == words.text[at + n - 1]]
        place = np.minimum(np.searchsorted(windows.keys, hashes[at]), len(windows.keys) - 1)
        for i in at[windows.keys[place] == hashes[at]].tolist():
            here = b" ".join([words.lowered[s:e] for s, e in zip(words.starts[i : i + n], words.ends[i : i + n], strict=True)])
            for window, ids in windows.known[int(hashes[i])]:
                if window == here:
                    hit[i : i + n] = True
                    items[int(words.text[i])].update(ids)


def hit_runs(words: Words, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs ``[first, end)`` of hit words; a run stays within one text."""
    places = np.flatnonzero(hit)
    if not len(places):
        return []
    cut = np.flatnonzero((np.diff(places) > 1) | (np.diff(words.text[places]) > 0)) + 1
    return [(int(run[0]), int(run[-1]) + 1) for run in np.split(places, cut)]


def without_hits(text: bytes, index: dict[int, Windows]) -> bytes:
    """Cut the hit words, from the first letter of a run to its last, until no window is left."""
    while True:
        words = words_of([text])
        hit = np.zeros(len(words.hashes), bool)
        find_hits(words, index, hit, defaultdict(set))
        if not hit.any():
            return text
        kept, at = [], 0
        for first, end in hit_runs(words, hit):
            kept.append(text[at : words.starts[first]])
            at = int(words.ends[end - 1])
        text = b"".join([*kept, text[at:]])


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window_words: int = WINDOW_WORDS) -> DataFrame:
    """``n, window, item_ids``: the distinct windows of all items, words joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            words = words_of(utf8(batch.column("text")))
            bounds = np.searchsorted(words.text, np.arange(batch.num_rows + 1))
            for k, item in enumerate(batch.column("item").to_pylist()):
                lo, hi = int(bounds[k]), int(bounds[k + 1])
                n = min(window_words, hi - lo)
                if n:
                    found = [
                        b" ".join([words.lowered[s:e] for s, e in zip(words.starts[i : i + n], words.ends[i : i + n], strict=True)])
                        for i in range(lo, hi - n + 1)
                    ]
                    arrays = [pa.array([n] * len(found), pa.int32()), pa.array(found, pa.binary()), pa.array([item] * len(found), pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, ["n", "window", "item"])

    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return (
        rows.mapInArrow(run, "n int, window binary, item string")
        .groupBy("n", "window")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )


def _chunks(windows: DataFrame, max_windows: int) -> list[dict[int, Windows]]:
    """The index in parts of a bounded size; one part for any benchmark up to ``max_windows``."""
    windows = windows.persist()
    try:
        total = windows.agg(F.sum(F.greatest(F.size("item_ids"), F.lit(1)))).first()[0] or 0
        parts = max(1, -(-total // max_windows))
        part = F.pmod(F.xxhash64("n", "window"), F.lit(parts))
        return [
            build_index([(r.n, bytes(r.window), r.item_ids) for r in windows.where(part == k).toLocalIterator()])
            for k in range(parts)
        ]
    finally:
        windows.unpersist()


_SPANS = "array<struct<first:int,end:int>>"


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    bench_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    max_windows: int = MAX_WINDOWS,
    clean: bool = False,
) -> DataFrame:
    """Find the benchmark in every whole text of ``docs``; one row per row.

    Columns: ``row`` (a struct of all columns of ``docs``; without the text
    unless ``clean``), ``n_words``, ``spans`` (runs of hit words, by word
    number), ``item_ids`` (sorted strings; items without an id count as hits
    but are not listed) and, with ``clean``, ``clean_text``: the text without
    the hit spans. Null and empty texts have no words. An empty benchmark
    hits nothing.
    """
    spark = docs.sparkSession
    parts = [spark.sparkContext.broadcast(p) for p in _chunks(benchmark_windows(benchmark, item_col, bench_text_col, window_words), max_windows)]
    names = docs.columns if clean else [c for c in docs.columns if c != text_col]
    held = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(
        held.alias("row"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.lit(0).alias("n_words"),
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast("array<string>").alias("item_ids"),
    )

    def passing(part, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in arrow_slices(batches):
                texts = utf8(batch.column("text"))
                words = words_of(texts)
                bounds = np.searchsorted(words.text, np.arange(len(texts) + 1)).tolist()
                hit = np.zeros(len(words.hashes), bool)
                items: dict[int, set[str]] = defaultdict(set)
                for k, (spans, ids) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("item_ids").to_pylist(), strict=True)):
                    for s in spans:
                        hit[bounds[k] + s["first"] : bounds[k] + s["end"]] = True
                    if ids:
                        items[k].update(ids)
                find_hits(words, part.value, hit, items)
                spans: list[list[dict]] = [[] for _ in texts]
                for first, end in hit_runs(words, hit):
                    k = int(words.text[first])
                    spans[k].append({"first": first - bounds[k], "end": end - bounds[k]})
                out = {
                    "row": batch.column("row"),
                    "text": batch.column("text"),
                    "n_words": pa.array(np.diff(bounds), pa.int32()),
                    "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                    "item_ids": pa.array([sorted(items.get(k, ())) for k in range(len(texts))], pa.list_(pa.string())),
                }
                if last and not clean:
                    del out["text"]
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

        return run

    def cleaning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_slices(batches):
            texts = batch.column("text").to_pylist()
            for k, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    before, now = None, texts[k].encode()
                    while before != now:
                        before = now
                        for part in parts:
                            now = without_hits(now, part.value)
                    texts[k] = now.decode()
            arrays = [batch.column(c) for c in ("row", "n_words", "spans", "item_ids")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], ["row", "n_words", "spans", "item_ids", "clean_text"])

    kind = StructType([rows.schema["row"]]).simpleString()[len("struct<row:") : -1]
    fields = f"n_words int, spans {_SPANS}, item_ids array<string>"
    for k, part in enumerate(parts):
        last = k == len(parts) - 1
        rows = rows.mapInArrow(passing(part, last), f"row {kind}, {'' if last and not clean else 'text string, '}{fields}")
    if clean:
        rows = rows.mapInArrow(cleaning, f"row {kind}, {fields}, clean_text string")
    return rows


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, item_ids, contaminated``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return scan(rows, benchmark, "text", **parameters).select(
        "row.doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        "item_ids",
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "documents", **parameters) -> DataFrame:
    """``docs`` without the benchmark: hit documents go, or (``remove="spans"``) their hit spans.

    All columns stay as they are but the text in spans mode. Clean rows,
    null and empty texts included, come back unchanged.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    found = scan(docs, benchmark, text_col, clean=True, **parameters) if remove == "spans" else _kept(docs, benchmark, text_col, **parameters)
    return found.select(
        *[
            (F.col("clean_text") if c == text_col and remove == "spans" else F.col(f"row.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )


def _kept(docs: DataFrame, benchmark: DataFrame, text_col: str, **parameters) -> DataFrame:
    """The scan's clean rows with all their columns: the text travels once more, inside ``row``."""
    name = "_scanned_text"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    return scan(docs.withColumn(name, F.col(f"`{text_col}`")), benchmark, name, **parameters).where(F.size("spans") == 0)
