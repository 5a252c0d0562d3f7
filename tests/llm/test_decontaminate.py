import random
import re

import pytest

from tablescout.llm import decontaminate as dc

SCHEMA = "doc_id bigint, text string, row string, n_words int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = WORD.findall(lowered(text))
        k = min(n, len(w))
        for i in range(len(w) - k + 1) if k else []:
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for key, text in docs:
        w = WORD.findall(lowered(text))
        hit, found = set(), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        ids = sorted(str(x) for x in found if x is not None)
        out.append((key, len(w), len(hit), len(ids), ids, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(1)
    vocabulary = ["alpha", "Beta", "ÉTÉ", "été", "42", "x", "日本", "tail"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "_"]) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 12, 25]))) for i in range(12)] + [(50, None), (51, ""), (52, " .,"), (1, "beta été"), (None, "lonely words")]
    docs = [(None, text(30)), (1, None), (2, ""), (3, "..."), (4, "Lonely-WORDS x"), (4, "Lonely-WORDS x")]
    docs += [(10 + i, text(rng.randint(0, 60)) + (rng.choice(items)[1] or "").upper() + text(20)) for i in range(60)]
    docs.append((500, "filler " * 400_000 + items[4][1] + " filler" * 200_000))
    docs.append((501, "a" * 3_000_000 + " " + items[0][1]))
    return docs, items


def frames(spark, cases):
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in cases[0]], SCHEMA).repartition(3)
    return docs, spark.createDataFrame([(k, t, "clash") for k, t in cases[1]], "item_id bigint, text string, window string")


@pytest.mark.parametrize("max_windows", [10**6, 40])
def test_report_against_brute_force(spark, cases, max_windows):
    docs, items = frames(spark, cases)
    got = sorted(map(tuple, dc.report(docs, items, max_windows=max_windows).collect()), key=str)
    assert got == brute(*cases)


def test_removal(spark, cases):
    docs, items = frames(spark, cases)
    dirty = {r.doc_id for r in dc.report(docs, items).collect() if r.contaminated}
    kept = dc.decontaminate(docs, items)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id not in dirty)
    cut = dc.decontaminate(docs, items, remove="spans", max_windows=40)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert not any(r.contaminated for r in dc.report(cut, items).collect())
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == whole[r.doc_id] for r in cut.collect() if r.doc_id not in dirty)


def test_empty_tables(spark, cases):
    docs, items = frames(spark, cases)
    assert dc.report(docs.where("false"), items).collect() == []
    clean = dc.report(docs, items.where("false")).collect()
    assert len(clean) == len(cases[0]) and not any(r.contaminated or r.n_items for r in clean)




def test_documents_may_have_any_column_names(spark):
    df = spark.createDataFrame([(1, "one two three", "kept", 3), (2, "clean", None, 4)], "doc_id bigint, text string, _scanned_text string, _Scanned_Text_ int")
    items = spark.createDataFrame([(1, "two three")], "item_id bigint, text string")
    assert [tuple(r) for r in dc.decontaminate(df, items).collect()] == [(2, "clean", None, 4)]
