import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescout.llm import langid

SCHEMA = "doc_id bigint, text string, lang string, score string, row int"
WORDS = {"aa": ["tova", "rilo", "menu", "sata", "pelo"], "bb": ["krsch", "zvult", "prokt", "schna", "wirgt"], "cc": ["öçé", "ñaña", "éûî", "àçà"]}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", ".", ", 12"]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.randint(5, 60)), lang, "x", 1) for i, lang in enumerate(list(WORDS) * 60)]
    rows += [(None, None, "aa", "x", 1), (1, "stray", None, "x", 1)]
    return langid.fit(spark.createDataFrame(rows, SCHEMA))


def test_held_out_accuracy_and_rejection(spark, model):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, 15), lang, "x", 1) for i, lang in enumerate(list(WORDS) * 20)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert all(got[i].lang_pred == lang and got[i].accepted and got[i].score > 0.9 for i, _, lang, _, _ in rows)
    junk = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(400))
    odd = [(1, None, "aa", "", 0), (2, "", "aa", "", 0), (3, " 12 !\0", "aa", "", 0), (4, junk, "aa", "", 0), (4, junk, "aa", "", 0), (None, "tova " * 50_000, "bb", "", 0)]
    got = sorted(map(tuple, langid.identify(spark.createDataFrame(odd, SCHEMA), model).collect()), key=str)
    by_id = {r[0]: r for r in got}
    assert [by_id[i][1] for i in (1, 2, 3)] == ["und"] * 3 and len(got) == 6
    assert [by_id[i][2] for i in (1, 2, 3)] == [0.0] * 3 and not by_id[4][4] and by_id[None][1] == "aa"
    kept = langid.identify(spark.createDataFrame(odd, SCHEMA).where("doc_id > 9"), model)
    assert kept.collect() == []


def test_keep_identified_keeps_columns(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, lang, 40), lang, "x", 1) for i, lang in enumerate(list(WORDS) * 40)] + [(900, "77", "aa", "x", 1), (901, None, "aa", "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = langid.keep_identified(docs, learn=F.col("doc_id") % 4 != 2)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(120))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None, "", 0)], SCHEMA)
    assert [tuple(r)[1:3] for r in langid.identify(docs, langid.fit(docs)).collect()] == [("und", 0.0)]


def test_probabilities_against_plain_kneser_ney():
    rng = random.Random(4)
    grams = Counter("".join(rng.choice("abc ") for _ in range(3)) for _ in range(80))
    model = langid.build([("x", g, n) for g, n in grams.items()], order=3)
    levels = [grams]
    for _ in range(2):
        levels.insert(0, Counter(g[1:] for g in levels[0]))

    def p(g):
        if not g:
            return 1 / (len(set("".join(grams))) + 1)
        level = levels[len(g) - 1]
        once, twice = (sum(n == k for n in level.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once else 0.5
        follow = [n for x, n in level.items() if x[:-1] == g[:-1]]
        if not follow:
            return p(g[1:])
        return max(level[g] - d, 0) / sum(follow) + d * len(follow) / sum(follow) * p(g[1:]) if level[g] else d * len(follow) / sum(follow) * p(g[1:])

    for g in ["abc", "aab", "  a", "zab", "abz", "zzz"]:
        codes = np.array([[ord(c) for c in g]], np.uint32)
        assert math.isclose(langid._probability(model, 0, codes)[0], p(g), rel_tol=1e-9), g
