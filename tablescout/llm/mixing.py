"""Mixing overlapping sources to target weights by min-cost flow.

A document belongs to one or more sources. Documents with the same set of
sources form a pattern, and a pattern is all that the flow sees: its tokens
can be taken once, twice and so on, each further copy at a higher cost, and
whatever is taken is credited to one of its sources, up to that source's
target. The cheapest largest flow says how many tokens each pattern gives.
Whole copies of a pattern go to all its documents; the rest goes to documents
in the order of a seeded hash, the last of them in part, so that a pattern
gives exactly what the flow asks for.

Sizes, patterns and the choice of documents are DataFrame work. The flow runs
in the driver on one row per pattern, at most ``MAX_PATTERNS``. The order of a
pattern's documents is cut into ``buckets`` of the hash, and only the bucket in
which the rest ends is sorted, so that no task gets a whole hot source.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Sequence
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import stored

WEIGHTS = (5, 2, 1)  # of the sources in code point order, repeating
SHARE = Fraction(3, 2)  # of all sizes
COPIES = (0, 1)  # cost of a token's first copy, second copy ...: rising, so that repeats come last
MAX_PATTERNS = 100_000  # sets of sources that documents have; more are an error
BUCKETS = 4096
SEED = 17
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Sequence[int], weights: Sequence[int], total: Fraction, stops: Sequence[Fraction]) -> list[Fraction]:
    """``total`` shared by weight; a share above its stop becomes the stop, and the excess is shared again until none is above."""
    out: list[Fraction] = [Fraction(0)] * len(sizes)
    rest, free = Fraction(total), list(range(len(sizes)))
    while free:
        weight = sum(weights[i] for i in free)
        above = [i for i in free if rest * weights[i] > stops[i] * weight]
        if not above:
            for i in free:
                out[i] = rest * weights[i] / weight
            break
        for i in above:
            out[i] = Fraction(stops[i])
        rest -= sum(out[i] for i in above)
        free = [i for i in free if i not in set(above)]
    return out


class _Arcs:
    """A flow network in arrays: arc ``i`` and its reverse ``i ^ 1``."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def add(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y), self.room.append(r), self.cost.append(c)
        return len(self.to) - 2

    def distances(self, source: int, potential: list[int]) -> list[int | None]:
        """Least reduced cost from ``source`` over arcs with room."""
        found: list[int | None] = [None] * len(self.out)
        queue = [(0, source)]
        while queue:
            d, x = heapq.heappop(queue)
            if found[x] is not None:
                continue
            found[x] = d
            for arc in self.out[x]:
                y = self.to[arc]
                if self.room[arc] and found[y] is None:
                    heapq.heappush(queue, (d + self.cost[arc] + potential[x] - potential[y], y))
        return found

    def saturate(self, source: int, sink: int, potential: list[int]) -> None:
        """As much flow as arcs of reduced cost 0 allow, along shortest paths."""
        open_ = lambda x, arc: self.room[arc] and self.cost[arc] + potential[x] - potential[self.to[arc]] == 0
        while True:
            level = {source: 0}
            queue = deque([source])
            while queue:
                x = queue.popleft()
                for arc in self.out[x]:
                    if open_(x, arc) and self.to[arc] not in level:
                        level[self.to[arc]] = level[x] + 1
                        queue.append(self.to[arc])
            if sink not in level:
                return
            at = [0] * len(self.out)
            path: list[int] = []
            x = source
            while True:  # depth first without recursion; an arc that leads nowhere is not tried again
                if x == sink:
                    least = min(self.room[arc] for arc in path)
                    for arc in path:
                        self.room[arc] -= least
                        self.room[arc ^ 1] += least
                    path, x = [], source
                    continue
                while at[x] < len(self.out[x]):
                    arc = self.out[x][at[x]]
                    if open_(x, arc) and level.get(self.to[arc]) == level[x] + 1:
                        break
                    at[x] += 1
                if at[x] < len(self.out[x]):
                    path.append(arc)
                    x = self.to[arc]
                elif path:
                    x = self.to[path.pop() ^ 1]
                    at[x] += 1
                else:
                    break


def cheapest_flow(patterns: Sequence[Sequence[int]], sizes: Sequence[int], quotas: Sequence[int], copies: Sequence[int] = COPIES) -> list[int]:
    """Tokens that each pattern gives in a largest flow of least cost.

    ``patterns[p]`` lists the sources (positions in ``quotas``) of a pattern of
    ``sizes[p]`` tokens. ``copies`` are the costs of a token's copies, from the
    first on, and must not fall.
    """
    if list(copies) != sorted(copies):
        raise ValueError("the cost of a further copy must not be lower")
    n = len(patterns)
    source, sink = n + len(quotas), n + len(quotas) + 1
    net = _Arcs(sink + 1)
    taken = [[net.add(source, p, size, cost) for cost in copies] for p, size in enumerate(sizes)]
    for p, members in enumerate(patterns):
        for s in members:
            net.add(p, n + s, sizes[p] * len(copies))
    for s, quota in enumerate(quotas):
        net.add(n + s, sink, quota)
    potential = [0] * (sink + 1)
    while True:
        found = net.distances(source, potential)
        if found[sink] is None:
            break
        far = max(d for d in found if d is not None)
        potential = [p + (far if d is None else d) for p, d in zip(potential, found, strict=True)]
        net.saturate(source, sink, potential)
    return [sum(net.room[arc ^ 1] for arc in arcs) for arcs in taken]


class Source(NamedTuple):
    name: str | None
    size: int
    target: Fraction


class Plan(NamedTuple):
    sources: list[Source]  # by code point, null last
    patterns: list[tuple[tuple[int, ...], int, int]]  # positions of its sources, size, tokens to take


def plan(totals: list[tuple[list[str | None], int]], weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, copies: Sequence[int] = COPIES) -> Plan:
    """Targets and flow for ``(sources, size)`` patterns."""
    # Python compares strings by code points.
    names = sorted({name for members, _ in totals for name in members}, key=lambda x: (x is None, x or ""))
    place = {name: i for i, name in enumerate(names)}
    patterns = [(tuple(sorted({place[name] for name in members})), size) for members, size in totals]
    sizes = [0] * len(names)
    for members, size in patterns:
        for s in members:
            sizes[s] += size
    weight = [weights[i % len(weights)] for i in range(len(names))]
    total = share * sum(size for members, size in patterns if members)
    goal = targets(sizes, weight, total, [Fraction(len(copies) * size) for size in sizes])
    taken = cheapest_flow([members for members, _ in patterns], [size for _, size in patterns], [int(t + Fraction(1, 2)) for t in goal], copies)
    return Plan([Source(*x) for x in zip(names, sizes, goal, strict=True)], [(m, size, x) for (m, size), x in zip(patterns, taken, strict=True)])


def mix(
    docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text", weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE, copies: Sequence[int] = COPIES, seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """How many words of each row of ``docs`` the mix takes, repeats counted.

    ``sources`` is an array of names, one pattern per set of them; null is a
    name like any other, and a null or empty array is no source: nothing of
    such rows is taken and they count for no target. Columns: ``doc_id, size,
    sources, source_sizes, targets, taken``, the arrays by code point, null
    last. ``size`` counts the words of the whole text, 0 for null. A row gives
    ``taken // size`` whole copies and the first ``taken % size`` words once
    more, which is not 0 for one row a pattern at most. Rows alike in id and
    text are rows of their own. An empty table gives an empty result. Equal
    tables give equal results, however they are stored.
    """
    text = F.col(f"`{text_col}`").cast("string")
    place = F.xxhash64(F.col(f"`{id_col}`").cast("string"), text, F.lit(seed))
    shown = F.transform(F.coalesce(sources.cast("array<string>"), F.array().cast("array<string>")), _shown)
    rows = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.array_sort(F.array_distinct(shown)).alias("pattern"), place.alias("place"),
        ).withColumn("bucket", (F.shiftrightunsigned("place", 32) * buckets / F.lit(float(1 << 32))).cast("int"))
    )
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"documents have more than {MAX_PATTERNS} different sets of sources")
    found.sort(key=lambda r: r["pattern"])
    flow = plan([([x[1:] if x else None for x in r["pattern"]], r["size"]) for r in found], weights, share, copies)
    table = []
    for r, (members, size, taken) in zip(found, flow.patterns, strict=True):
        of = [flow.sources[s] for s in members]
        whole, rest = divmod(taken, size) if size else (0, 0)
        table.append((r["pattern"], [s.name for s in of], [s.size for s in of], [float(s.target) for s in of], whole, rest))
    schema = "pattern array<string>, sources array<string>, source_sizes array<bigint>, targets array<double>, whole bigint, rest bigint"
    patterns = F.broadcast(docs.sparkSession.createDataFrame(table, schema))  # at most MAX_PATTERNS

    # Whole buckets before the one in which a pattern's rest ends are taken, later ones are not.
    held = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("held")).join(patterns.where("rest > 0").select("pattern", "rest"), "pattern")
    before = F.sum("held").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("held")
    last = held.withColumn("before", before).where("before < rest AND before + held >= rest")
    last = stored(last.select("pattern", F.col("bucket").alias("end"), (F.col("rest") - F.col("before")).alias("left")))
    placed = rows.join(patterns, "pattern").join(F.broadcast(last), "pattern", "left")
    columns = ["doc_id", "size", "sources", "source_sizes", "targets"]
    whole = F.col("whole") * F.col("size")
    sure = placed.where("end IS NULL OR bucket <> end").select(*columns, (whole + F.when(F.col("bucket") < F.col("end"), F.col("size")).otherwise(0)).alias("taken"))
    order = Window.partitionBy("pattern").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("left") - F.coalesce(F.sum("size").over(order), F.lit(0))
    split = placed.where("bucket = end").select(*columns, (whole + F.greatest(F.lit(0), F.least(F.col("size"), room))).alias("taken"))
    return sure.unionByName(split)


def _shown(name: Column) -> Column:
    """A name as a string that is not null: null is empty, and a name has a mark in front."""
    return F.coalesce(F.concat(F.lit("="), name), F.lit(""))
