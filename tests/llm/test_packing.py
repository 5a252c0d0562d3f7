import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablescout.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, length string, offset int"
ODD = [None, "", " ", "a", "<|endoftext|> x", "two  spaces", "end ", " \n x\n\ny", "日本語 テスト", "é’s it's IT'S", "tab\tx\x1cy\x85z w", "x" * 3000, "1234 ½ ²", "a <|endoftext|> x", "<|endoftext|>" * 3, "   lead\n\n  and  trail  \n ", "\n\n\n", "    "]


def tokenizer():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(9)
    alphabet = "abcdefg hij klm é.,!'\n 12"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6000))) for _ in range(120)]


def test_ids_equal_the_tokenizers():
    t, lines = tokenizer(), [x or "" for x in texts()]
    for text, ids in zip(lines, packing.encode(lines, PATH), strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, text[:40]


def check(rows, lines, capacity, max_docs, max_cost):
    t = tokenizer()
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for i, x in enumerate(lines)}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == sorted(ids)
    for i, parts in by_doc.items():
        at = 0
        for n, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and r.ids_crc32 == zlib.crc32(ids[i][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[i])
        assert len(parts) == -(-at // capacity)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        if len(parts) > 1:
            assert len(parts) <= max_docs and sum(r.length**2 for r in parts) <= max_cost
    return len(by_sequence), sum(len(x) for x in ids.values())


@pytest.mark.parametrize(("rule", "docs", "cost"), [("norm", None, None), ("dot", None, None), ("norm", 3, None), ("dot", 4, 400_000)])
def test_round_trip_under_every_constraint(spark, rule, docs, cost):
    lines = texts()
    df = spark.createDataFrame([(i, x, "clash", 1) for i, x in enumerate(lines)], SCHEMA).repartition(3)
    rows = packing.pack(df, PATH, rule=rule, max_docs=docs, max_cost=cost).collect()
    sequences, tokens = check(rows, lines, 1024, docs or 1024, cost or 1024**2)
    if docs is None:
        assert sequences <= tokens / 1024 * 1.08 + 1


def test_groups_rows_alike_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c", "", 0), (None, "a b c", "", 0), (5, None, "", 0)], SCHEMA)
    assert sorted(r.length for r in packing.pack(df, PATH, group_pieces=1).collect()) == [1, 4, 4]
    assert packing.pack(df.where("doc_id > 9"), PATH).collect() == []
