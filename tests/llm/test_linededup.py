import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescout.llm import linededup

SCHEMA = "doc_id bigint, text string, node string, line_no int, n double"


def brute(rows, threshold=0.8):
    """The distinct documents' dropped lines by comparing every pair of lines."""
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    lines = [(d, n, linededup.normal(x).decode()) for d, (_, t) in enumerate(docs) for n, x in enumerate((t or "").split("\n")) if linededup.normal(x)]
    sets = [linededup.shingles(x) for _, _, x in lines]
    parent = list(range(len(lines)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    out = {d: [] for d in range(len(docs))}
    for i, (d, n, _) in enumerate(lines):
        if root(i) != i:
            out[d].append(n)
    return {docs[d]: v for d, v in out.items()}


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    bases = [" ".join(word() for _ in range(rng.randint(10, 20))) for _ in range(30)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(1, 4)):
            line = rng.choice(bases) if rng.random() < 0.5 else " ".join(word() for _ in range(12))
            if rng.random() < 0.5:
                line = line.upper().replace(" ", "  ") + rng.choice(["", "!", " x"])
            text.append(line)
        rows.append((i, "\n".join(text)))
    rows += [(70, None), (71, ""), (72, "\n \n"), (73, "ab"), (74, "ab"), (75, "AB\n\ncd"), (None, "no id line at all"), (80, "no id line at all")]
    return rows + [rows[0], (90, "é" * 70_000 + " tail"), (91, "é" * 70_000 + " tail")]


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(k, t, "x", 1, 0.5) for k, t in rows], SCHEMA).repartition(4)
    got = linededup.dropped_lines(df).collect()
    want = brute(rows)
    assert len(got) == len(want)
    dropped = sorted((str(r.doc_id), r.n_lines, list(r.dropped)) for r in got)
    assert dropped == sorted((str(k), sum(bool(linededup.normal(x)) for x in (t or "").split("\n")), v) for (k, t), v in want.items())


def test_rewritten_documents(spark):
    rows = corpus()
    df = spark.createDataFrame([(k, t, "x", 1, 0.5) for k, t in rows], SCHEMA)
    kept = linededup.remove_repeated_lines(df)
    want = []
    dropped = brute(rows)
    for k, t in rows:
        gone = dropped[(k, t)]
        full = [n for n, x in enumerate((t or "").split("\n")) if linededup.normal(x)]
        if not gone or len(gone) < len(full):
            want.append((k, t if not gone else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)))
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert linededup.remove_repeated_lines(df.where("doc_id < 0")).collect() == []


def test_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(150):
        line = list(base)
        line[rng.randrange(40)] = f"other{i}"
        rows.append((i, " ".join(line)))
    df = spark.createDataFrame([(k, t, "x", 1, 0.5) for k, t in rows], SCHEMA)
    assert [r.doc_id for r in linededup.remove_repeated_lines(df).collect()] == [0]


def test_large_buckets_of_several_groups(spark):
    """All lines in one bucket: the exact search finds the links that the leaders miss."""
    rng = random.Random(9)
    rows = []
    for group in range(25):
        base = ["shared start of the line"] + [f"w{rng.randrange(10**6)}" for _ in range(24)]
        for _ in range(rng.randint(1, 5)):
            line = list(base)
            line[rng.randrange(1, 25)] = f"v{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(line)))
    rng.shuffle(rows)
    df = spark.createDataFrame([(k, t, "x", 1, 0.5) for k, t in rows], SCHEMA).repartition(3)
    want = brute(rows)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(linededup, "buckets", one_bucket)
        got = {(r.doc_id): list(r.dropped) for r in linededup.dropped_lines(df).collect()}
    assert got == {k: v for (k, _), v in want.items()} and sum(map(len, want.values())) > 20


def one_bucket(rows, *_):
    return linededup._lines_of(rows).select("node", F.array(F.lit(0).cast("bigint")).alias("keys"))


def test_sketch_bounds_the_overlap():
    rng = random.Random(3)
    for _ in range(200):
        x = "".join(rng.choice("abcé \u4e2d") for _ in range(rng.randint(1, 300)))
        y = x[: rng.randint(0, len(x))] + "".join(rng.choice("abcé") for _ in range(rng.randint(1, 40)))
        (n, a), (m, b) = linededup.sketch(x), linededup.sketch(y)
        assert n == len(linededup.shingles(x)) and m == len(linededup.shingles(y))
        a, b = (np.frombuffer(v, np.uint8)[None] for v in (a, b))
        assert linededup.most_shared(a, b, np.array([n]))[0] >= len(linededup.shingles(x) & linededup.shingles(y))
    x = "".join(rng.choice("abcdefghijklmnop") for _ in range(60_000))
    (n, a), (m, b) = linededup.sketch(x), linededup.sketch(x[5_000:])
    a, b = (np.frombuffer(v, np.uint8)[None] for v in (a, b))
    assert a.max() == 255 and linededup.most_shared(a, b, np.array([n]))[0] >= m


def test_recall_against_all_pairs(spark):
    """Lines of similarity just above the bound: the share of pairs whose lines end in one component."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    rows, pairs = [], []
    while len(pairs) < 300:
        base = " ".join(word() for _ in range(18))
        at = rng.randrange(5, len(base) - 10)
        other = base[:at] + "".join(rng.choice("0123456789") for _ in range(rng.choice([5, 7, 9]))) + base[at + 6 :]
        x, y = linededup.shingles(base), linededup.shingles(other)
        if 0.8 <= len(x & y) / len(x | y) < 0.86:
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows), base), (len(rows) + 1, other)]
    df = spark.createDataFrame([(k, t, "x", 1, 0.5) for k, t in rows], SCHEMA).repartition(4)
    gone = {r.doc_id for r in linededup.dropped_lines(df).collect() if r.dropped}
    found = sum(b in gone for _, b in pairs)
    assert gone <= {b for _, b in pairs} and found >= 0.95 * len(pairs), found


def test_rare_shingles_bring_only_lines_that_can_be_alike(spark):
    """Every pair that reaches the threshold is found, and two groups that share rare shingles alone are not paired up."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rare, ways = text(25), [text(60), text(60)]
    groups = [[f"{rare}{way}{text(3)}" for _ in range(50)] for way in ways]
    alike = []
    for _ in range(40):
        line = list(text(rng.randint(5, 120)))
        alike.append("".join(line))
        for _ in range(3):
            line[rng.randrange(len(line))] = rng.choice("xyz")
            alike.append("".join(line))
    others = [way + text(20) for way in ways for _ in range(100)]
    lines = [(line, k) for k, group in enumerate(groups) for line in group] + [(x, 10 + i) for i, x in enumerate(alike)] + [(x, 2) for x in others]
    rows = [(i, line, component) for i, (line, component) in enumerate(lines)]
    got = {(r.a, r.b) for r in linededup.shared_rare_shingles(spark.createDataFrame(rows, "node long, line string, component long").repartition(3)).collect()}
    sets = [linededup.shingles(line) for line, _ in lines]
    near = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if lines[i][1] != lines[j][1] and near(i, j)}
    assert len(want) > 50 and want <= got
    assert not any(lines[a][1] == 0 and lines[b][1] == 1 for a, b in got)


def test_parities_tell_long_lines_apart():
    """They differ in no more bits than the sets in shingles, and rule out long lines of one passage that are too unlike to link."""
    rng = random.Random(15)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    base = [rng.choice(words) for _ in range(100)]
    changed = lambda n: " ".join(rng.choice(words) if i in at else w for at in [set(rng.sample(range(100), n))] for i, w in enumerate(base))
    lines = [changed(n) for n in (0, 2, 4, 6, 11, 11, 12, 12, 13, 13, 14, 14)]
    bits = linededup.parities(*linededup.shingle_sets([x.encode() for x in lines])).view(np.uint8)
    sets = [linededup.shingles(x) for x in lines]
    out, unlike = 0, 0
    for i in range(len(lines)):
        for j in range(i):
            differ = int(np.unpackbits(bits[i] ^ bits[j]).sum())
            assert differ <= len(sets[i] ^ sets[j])
            if len(sets[i] & sets[j]) < 0.7 * len(sets[i] | sets[j]):
                unlike += 1
                out += differ > 0.2 / 1.8 * (len(sets[i]) + len(sets[j]))
    assert unlike > 20 and out >= 0.9 * unlike, (out, unlike)


def test_pair_sets_and_lines_as_before():
    """Sets of many lines at once equal those of each line; lines are folded as Python folds bytes."""
    lines = ["ab", "", "a  b\tC", "\x0b \r", "É straße \U0001f600 ab", "x" * 70_000 + "yz", " Q\fq "]
    assert linededup._lines("\n".join(lines).encode()) == [b" ".join(x.encode().lower().split()) for x in lines]
    assert [linededup.normal(x) for x in lines] == linededup._lines("\n".join(lines).encode())
    found, ends = linededup.shingle_sets([x.encode() for x in lines])
    assert np.diff(ends, prepend=0).tolist() == [len(linededup.shingles(x)) for x in lines]
    for x, each in zip(lines, np.split(found, ends[:-1]), strict=True):
        assert each.tolist() == linededup.shingle_sets([x.encode()])[0].tolist()


def test_no_stage_runs_two_steps_in_python(spark):
    """What the union-find reads of the links is a table: no worker that compares lines waits beside it."""
    lines = spark.createDataFrame([(i, f"a line that is like the others {i}") for i in range(5)], "node long, line string")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 5)], "a long, b long")
    links = linededup.verified(pairs, linededup._sketched(lines))
    assert sorted((r.a, r.b) for r in links.collect()) == [(0, i) for i in range(1, 5)]
    assert "MapInArrow" not in links._jdf.queryExecution().executedPlan().toString()


def test_unlike_lines_of_a_bucket_are_not_paired_up(spark):
    """Lines that meet by chance go in their bucket: no table grows with the square of its lines, and no link is lost."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    rows = [(i, " ".join(["a common start of the line"] + [word() for _ in range(20)])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + "!") for i in range(3)]
    written, stored = [], linededup.stored

    def counted(table):
        out = stored(table)
        written.append((out.columns, out.count()))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(linededup, "buckets", lambda rows, signed: signed.select("node", F.array(F.lit(0).cast("bigint")).alias("keys"), *[c for c in ("n", "odd") if c in signed.columns]))
        patch.setattr(linededup, "stored", counted)
        df = spark.createDataFrame([(k, t, "x", 1, 0.5) for k, t in rows], SCHEMA).repartition(2)
        gone = {r.doc_id for r in linededup.dropped_lines(df).collect() if r.dropped}
    assert gone == {100, 101, 102}
    assert max(n for columns, n in written if columns[-2:] == ["a", "b"]) <= 6


def test_parities_that_go_with_a_line_lose_no_pair():
    """Lines of unlike sizes are compared by folded parities; all that reach the threshold stay, nearly all others go."""
    rng = random.Random(22)
    lines = []
    for n in (3, 7, 40, 60, 80, 95, 150, 180, 360, 700, 30_000):
        line = "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
        lines += [line, line[: -max(1, n // 20)], line + line[:3] + "x" * (n // 8), line.replace("a", "q", 2), "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))]
    _, n, odd = linededup.signatures([x.encode() for x in lines])
    sets = [linededup.shingles(x) for x in lines]
    width = np.array([len(x) for x in odd.to_pylist()])
    assert n.tolist() == [len(x) for x in sets] and len(set(width)) > 4
    i, j = np.triu_indices(len(lines), 1)
    keep = linededup._Sketched(linededup.pa.array(n), odd).possible(i, j, 0.8)
    alike = np.array([len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in zip(i, j, strict=True)])
    assert keep[alike >= 0.8].all() and (alike >= 0.8).sum() > 20 and ((alike >= 0.8) & (width[i] != width[j])).any()
    assert keep[alike < 0.5].sum() <= 0.05 * (alike < 0.5).sum()


def test_large_bucket_in_blocks(spark):
    """A bucket's lines are dealt out in blocks: every pair is found, within one and across two; lines of other buckets are left alone."""
    rng = random.Random(23)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    lines = []
    for _ in range(25):
        line = text(rng.randint(60, 200))
        lines += [line, line[:-3], line + text(4)]
    rng.shuffle(lines)
    sets = [linededup.shingles(x) for x in lines]
    want = {(i, j) for i in range(75) for j in range(i + 1, 75) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    df = spark.createDataFrame([(i, x, i) for i, x in enumerate(lines)], "node long, line string, component long").repartition(3)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(linededup, "BLOCK_LINES", 8)
        got = [(r.a, r.b) for r in linededup.shared_rare_shingles(df).collect()]
        patch.setattr(linededup, "REST_BANDS", 0)
        members = df.select((F.col("node") % 2).alias("key"), "node")
        parted = [(r.a, r.b) for r in linededup.shared_rare_shingles(df, members=members).collect()]
    assert len(want) == 75 and len(set(got)) == len(got) and want <= set(got) and len(got) < 100
    assert {(a, b) for a, b in want if a % 2 == b % 2} <= set(parted) and all(a % 2 == b % 2 for a, b in parted)


def test_groups_stay_whole_across_batches():
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 4, 5, 5]
    table = linededup.pa.table({"key": keys, "at": list(range(len(keys)))})
    for size in (1, 2, 3, 20):
        found = [b.column("key").to_pylist() for b in linededup._whole_groups(iter(table.to_batches(size)), ["key"])]
        assert sum(found, []) == keys
        assert all(x[-1] != y[0] for x, y in zip(found, found[1:], strict=False))


def test_near_copies_that_stay_apart_give_one_link_a_line(spark):
    """The exact search gives the links that join components, not every pair of a group; unlike lines give none."""
    base = [f"word{i}" for i in range(60)]
    lines = [" ".join(base[:i] + [f"other{i}"] + base[i + 1 :]) for i in range(60)] + [" ".join(f"{k}{w}" for w in base) for k in range(20)]
    df = spark.createDataFrame([(i, x, i) for i, x in enumerate(lines)], "node long, line string, component long").repartition(3)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(linededup, "REST_BANDS", 0)
        links = [(r.a, r.b) for r in linededup.shared_rare_shingles(df, joining=True).collect()]
    sets = [linededup.shingles(x) for x in lines]
    parent = list(range(80))
    for a, b in links:
        assert len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
        a, b = parent[a], parent[b]
        parent = [a if p == b else p for p in parent]
    assert len(links) == 59 and len(set(parent[:60])) == 1 and len(set(parent)) == 21
