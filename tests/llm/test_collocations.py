import random
import re
from collections import Counter

import numpy as np
import pytest

from tablescout.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, phrase string, n int"


def counted(rows, longest=5):
    """Counts of all phrases per language, and of all words."""
    found, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    found[lang, tuple(words[i : i + size])] += 1
    return found, total


def brute(rows, least, top, longest=5):
    found, total = counted(rows, longest)
    out = {}
    chosen = {k: a for k, a in found.items() if len(k[1]) > 1 and a >= least}
    for (lang, words), a in chosen.items():
        inside = any(
            la == lang and len(longer) > len(words) and 100 * b >= 100 * a and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (la, longer), b in chosen.items()
        )
        if inside:
            continue
        score, k = min((1000 * a * total[lang] // (found[lang, words[:k]] * found[lang, words[k:]]), k) for k in range(1, len(words)))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode("utf-8", "surrogatepass"), found[lang, words[:k]], found[lang, words[k:]]))
    return sorted(
        (lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, each in out.items() for i, (score, a, phrase, left, right) in enumerate(sorted(each)[:top])
    )


def corpus(rng, n):
    vocabulary = ["Ab", "ab", "é", "ÉÉ", "c d", "x" * 70, "日本", "z", "q-q", "'", "w1", "w2", "w3"]
    fixed = ["new york city", "of the of the of the", "a\tb  c d e f g", "one two three four five six", "New York"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice([rng.choice(vocabulary), rng.choice(fixed)]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", ",", "\x0b"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice([i, None, 7]), text, rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    return rows + [(1, None, "en"), (2, "", None), (3, " \t\n.,", "xx"), (4, "solo", "de"), (5, "z " * 30_000, "en"), (6, "y" * 300_000, "en")]


@pytest.mark.parametrize(("bits", "table"), [(64, collocations.MAX_BITS), (6, collocations.MAX_BITS), (64, collocations.BLOCK_BITS)])
def test_against_brute_force(spark, bits, table, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST_BITS", collocations.BLOCK_BITS)
    rows = corpus(random.Random(bits), 300)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = collocations.collocations(df, min_count=9, top=40, bits=bits, max_bits=table)
    assert sorted(tuple(r)[:8] for r in got.collect()) == brute(rows, 9, 40)


def test_pointers_name_an_occurrence(spark):
    rows = corpus(random.Random(3), 200)
    df = spark.createDataFrame([(i, text, lang, "", 1) for i, (_, text, lang) in enumerate(rows)], SCHEMA).repartition(3)
    texts = {i: re.sub("[A-Z]", lambda m: m[0].lower(), text or "") for i, (_, text, _) in enumerate(rows)}
    found = collocations.frequent_phrases(df, min_count=5).collect()
    assert found
    want, total = counted([(0, t, lang) for _, t, lang in rows])
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found if r.words} == {k: n for k, n in want.items() if n >= 5}
    assert {r.lang: r.n for r in found if not r.words} == dict(total)
    for r in found:
        if r.words:
            words = re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", texts[r.doc_id])
            assert " ".join(words[r.word : r.word + r.words]) == r.phrase


def test_fingerprints_do_not_depend_on_their_place():
    one = collocations.words_of([b"new york is big", b"", b"York,new YORK. is"])
    marks = one.mark.tolist()
    assert marks[0] == marks[5] and marks[1] == marks[4] == marks[6] and marks[2] == marks[7] and len(set(marks)) == 4
    pairs = collocations.Marker(one, "en")
    at = pairs.places(2)
    assert at.tolist() == [0, 1, 2, 5]
    found = pairs.marks(2, at).tolist()
    assert found[0] == found[3] and len(set(found)) == 3
    assert pairs.marks(2, at[3:]).tolist() == found[3:] and collocations.Marker(one, "fr").marks(2, at).tolist() != found


def test_blocks_end_between_words(monkeypatch):
    rng = np.random.default_rng(4)
    text = bytes(rng.choice(np.frombuffer(b"ab c\t.d", np.uint8), 5000))
    whole = collocations.words_of([text])
    monkeypatch.setattr(collocations, "_SLICE", 7)
    parts = collocations.words_of([text])
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True))


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b a b", "en", "", 1), (None, None, None, None, None)], SCHEMA)
    assert collocations.collocations(df.where("doc_id > 5")).collect() == []
    assert collocations.collocations(df).collect() == []
    assert [(r.phrase, r.a, r.score) for r in collocations.collocations(df, min_count=2).collect()] == [("a b", 2, 2000)]
