import random
import re

import pytest
import xxhash

from tablescout.llm import components, simhash

SCHEMA = "doc_id bigint, text string, fp string, component_id int"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, max_bits=2):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            r = root(i)
            least[r] = min(least.get(r, k), k)
    return [(k, f"{fp:016x}", least.get(root(i))) for i, (k, fp) in enumerate(zip((k for k, _ in rows), fps, strict=True))]


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}É" for i in range(60)]
    rows = [(None, "a b"), (1, None), (2, ""), (3, " \t\x0b"), (4, "One"), (5, "one"), (6, "Two words"), (6, "Two words")]
    for k in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 200))]
        rows.append((10 + 5 * k, " ".join(words)))
        for c in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((10 + 5 * k + c + 1, "  ".join(words).upper()))
    rows.append((9999, "word " * 70_000))
    df = spark.createDataFrame([(k, t, "x", 7) for k, t in rows], SCHEMA)
    got = simhash.near_duplicates(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_components(rows)))


@pytest.mark.parametrize(("bits", "segments"), [(0, 2), (1, 2), (1, 4), (2, 4), (3, 4), (3, 8)])
def test_links_find_every_pair(spark, bits, segments):
    rng = random.Random(bits)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(4):
            x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp bigint"), bits, segments).collect()
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b) & (2**64 - 1) and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_empty_and_keep_one(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(2, "a b c d", "x", 1), (1, "A B c d", "y", 1), (3, "other words", None, None)], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rng.shuffle(chain)
    edges = spark.createDataFrame([*chain, *star, (7, 7), (None, 3)], "x bigint, y bigint").repartition(7)
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[1000 + i] == 1000 for i in range(1, 200))
    assert components.connected_components(edges.where("x < 0")).collect() == []
