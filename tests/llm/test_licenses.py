import re
import textwrap

from tablescout.llm import licenses

SCHEMA = "doc_id bigint, text string, code string, sentence string"
MIT = " ".join(licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
BSD = "\n  ".join(licenses.SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary"))


def brute(text, max_gap=licenses.MAX_GAP):
    known, codes = licenses.known_sentences(), licenses.codes()
    found = [(n, known[s]) for n, s in enumerate(map(licenses.normalised, re.split(licenses.SENTENCE_END, text or ""))) if s in known]
    line = "".join(("|" if i and n - found[i - 1][0] > max_gap + 1 else "") + codes[x] for i, (n, x) in enumerate(found))
    out = []
    while line:
        for name, rule in licenses.RULES:
            m = re.match("".join(codes[i.rstrip("?")] + "?" * i.endswith("?") for i in rule), line)
            if m:
                out.append(name)
                line = line[m.end() :]
                break
        else:
            line = line[1:]
    return out, [x for _, x in found], [n for n, _ in found]


TEXTS = [
    None, "", "...", "No licence here. Just words.", "Released under the MIT License.", "Words.\nLicensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + MIT,
    BSD + "\n" + licenses.SENTENCES["bsd-names"][0], BSD, BSD + "\nA.\nB.\nC.\nD.\n" + licenses.SENTENCES["bsd-names"][0],
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.\n"
    "You may obtain a copy of the License at\n\n http://example.org\n\n" + licenses.SENTENCES["apache-basis"][0],
    "SPDX-License-Identifier: GPL-2.0\n" + licenses.SENTENCES["gpl2-redistribute"][0], "word " * 300_000 + ". Released under the MIT License",
    "The MIT License is named in passing. licensed under mit", licenses.SENTENCES["mit-grant"][0],
]


def test_against_brute_force(spark):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "again", None), (None, TEXTS[4], "", "")]
    got = {r.doc_id: (r.licenses, r.sentence_ids, r.sentence_nos) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {i: brute(t) for i, t in enumerate(TEXTS) if brute(t)[0]}
    assert got == want | {None: brute(TEXTS[4])}
    assert got[7][0] == ["MIT"] and got[8][0] == ["BSD-3-Clause"] and got[9][0] == ["BSD-2-Clause"] and got[11][0] == ["Apache-2.0"]
    assert got[10][0] == ["BSD-2-Clause"] and 15 not in got


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_plan_is_native(spark):
    df = licenses.scan(spark.createDataFrame([(1, "a", "", "")], SCHEMA))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_wrapped_texts(spark):
    apache = licenses.SENTENCES["ref:Apache-2.0"][0] + "\n" + licenses.SENTENCES["apache-obtain"][0] + "\n\n    http://example.org\n\n" + licenses.SENTENCES["apache-basis"][0]
    isc = " ".join(licenses.SENTENCES[k][0] for k in ("isc-grant", "isc-warranty"))
    numbered = "\n".join(f"{mark}{licenses.SENTENCES[k][0]}" for mark, k in (("", "bsd-grant"), ("1. ", "bsd-source"), ("2. ", "bsd-binary"), ("3. ", "bsd-names"), ("", "bsd-warranty")))
    rows, want = [], {}
    for name, text in (("MIT", MIT), ("BSD-3-Clause", numbered), ("ISC", isc), ("Apache-2.0", apache), ("BSD-2-Clause", BSD)):
        for width in (30, 72):
            for mark, end in (("", "\n"), (" * ", "\n"), ("# ", "\r\n"), ("// ", "\n")):
                lines = [x for part in text.split("\n") for x in (textwrap.wrap(part, width) or [""])]
                want[len(rows)] = [name]
                rows.append((len(rows), end.join(mark + x for x in ["Copyright 2020 A. Person", "", *lines, "", "Code follows."]), "", ""))
    for text in ("Permission is hereby\n\ngranted, free of charge", "License: MIT License", "word licensed under\nMIT License and more"):
        rows.append((len(rows), text, "", ""))
    rows.append((len(rows), "Words. This work is licensed\nunder the terms of the GNU GPL\nversion 3.\nMore.", "", ""))
    want[rows[-1][0]] = ["GPL-3.0"]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: r.licenses for i, r in got.items()} == want
    assert got[rows[-1][0]].sentence_nos == [1]
