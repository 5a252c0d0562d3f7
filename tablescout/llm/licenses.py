"""Licence recognition by sentences and ordered rules, in DataFrame functions only.

Texts are split into sentences; a normalised sentence that is a known licence
sentence becomes that sentence's identifier (a join with a fixed, broadcast
table). A known sentence may run over several lines, with or without comment
marks, and a full one that does may begin or end at a colon. A document's identifiers,
in order, are then matched against ordered rules: the first rule that fits at
a place wins, so full texts come before the short notices they contain. Up to
``max_gap`` other sentences (or lines) may stand between two sentences of a
rule.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_GAP = 2

# Names under which texts refer to a licence.
LICENCE_NAMES = {
    "MIT": ["MIT License", "MIT", "X11 License", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0", "Apache Software License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GPLv3", "GPL-3.0"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL version 2.1", "LGPLv2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL version 3", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL version 3", "AGPLv3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "EPL-2.0"],
    "ISC": ["ISC License", "ISC"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
}

# Sentences of public licence texts, by identifier.
SENTENCES = {
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "bsd-warranty": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "isc-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "ref:Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "apache-obtain": ["You may obtain a copy of the License at", "You may not use this file except in compliance with the License"],
    "apache-basis": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "gpl2-redistribute": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl3-redistribute": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl3-redistribute": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "unlicense-domain": ["This is free and unencumbered software released into the public domain."],
    "all-rights": ["All rights reserved."],
}

#: Ordered rules: the first that fits at a place wins. ``?`` marks a sentence that may be absent.
RULES = [
    ("MIT", ["ref:MIT?", "mit-grant", "mit-notice", "mit-warranty", "mit-liability?"]),
    ("BSD-3-Clause", ["ref:BSD-3-Clause?", "bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty?"]),
    ("BSD-2-Clause", ["ref:BSD-2-Clause?", "bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty?"]),
    ("ISC", ["ref:ISC?", "isc-grant", "isc-warranty?"]),
    ("Apache-2.0", ["ref:Apache-2.0", "apache-obtain", "apache-obtain?", "apache-basis?"]),
    ("AGPL-3.0", ["agpl3-redistribute", "gpl-hope?"]),
    ("GPL-3.0", ["gpl3-redistribute", "gpl-hope?"]),
    ("GPL-2.0", ["gpl2-redistribute", "gpl-hope?"]),
    ("Unlicense", ["unlicense-domain"]),
    *[(name, [f"ref:{name}"]) for name in LICENCE_NAMES],
    ("all-rights-reserved", ["all-rights"]),
]

#: Where a sentence ends; what normalisation turns into one space; the lead-in of a notice by name.
SENTENCE_END = "[.!?]+[ \\t\\r]+|[.!?]*[\\r\\n]+"
OTHER = "[^a-z0-9+]+"
LEAD_IN = (
    "^((this|the) [a-z]+ (is|was) )?(dual )?(licensed|released|distributed|available|published|provided|made available)"
    " under (the )?(terms of (the )?)?"
)
LIST_MARK = "^([0-9]|[a-z]) "


def normalised(sentence: str) -> str:
    """What the plan's normalisation makes of one sentence; used on the fixed tables only."""
    s = re.sub(OTHER, " ", sentence.lower()).strip(" ")
    return re.sub(LIST_MARK, "", re.sub(LEAD_IN, "under ", s))


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    out = {}
    for name, spellings in LICENCE_NAMES.items():
        for spelling in spellings:
            base = normalised(spelling)
            for text in (base, f"{base} license", f"{base} licence"):
                out[f"under {text}"] = f"ref:{name}"
                out[f"spdx license identifier {text}"] = f"ref:{name}"
                if "license" in base or "version" in base:
                    out[text] = out[f"the {text}"] = f"ref:{name}"
    for identifier, sentences in SENTENCES.items():
        for sentence in sentences:
            for part in re.split(SENTENCE_END, sentence):
                out[normalised(part)] = identifier
    return out


def codes() -> dict[str, str]:
    """One letter per identifier."""
    identifiers = [f"ref:{name}" for name in LICENCE_NAMES] + list(SENTENCES)
    identifiers = list(dict.fromkeys(identifiers))
    assert len(identifiers) <= len(string.ascii_letters)
    return dict(zip(identifiers, string.ascii_letters, strict=False))


def rule_patterns() -> list[tuple[str, str]]:
    """Licence and the pattern of its run of codes, in the order of the rules."""
    code = codes()
    letters = lambda rule: "".join(code[i.rstrip("?")] + ("?" if i.endswith("?") else "") for i in rule)
    return [(name, f"^({letters(rule)})$") for name, rule in RULES]


def rule_pattern() -> str:
    """All rules as one pattern over a document's codes; the first that fits at a place wins."""
    return "(" + "|".join(pattern[2:-2] for _, pattern in rule_patterns()) + ")"


def _normalised(sentence: Column) -> Column:
    s = F.trim(F.regexp_replace(F.lower(sentence), OTHER, " "))
    return F.regexp_replace(F.regexp_replace(s, LEAD_IN, "under "), LIST_MARK, "")


def _licence(matched: Column) -> Column:
    """The licence of the rule that a matched run of codes fits first."""
    out = F
    for licence, pattern in rule_patterns():
        out = out.when(matched.rlike(pattern), F.lit(licence))
    return out


# In a prepared text a sentence ends at END, a line without a sentence's end at WRAP, and COLON stands for a colon before a space.
END, COLON, WRAP = "\f", "\v", "\x0e"


def _prepared(text: Column) -> Column:
    """Normalised words, one space apart, with one END or WRAP for every ``SENTENCE_END``."""
    s = F.regexp_replace(F.translate(F.lower(text), END + COLON + WRAP, "\x01\x01\x01"), SENTENCE_END, f"{END}$0")
    s = F.regexp_replace(s, f"{END}(\\r\\n|\\r|\\n)(?![\\r\\n])", WRAP)
    s = F.regexp_replace(F.regexp_replace(s, ":[ \\t]+", COLON), f"[^a-z0-9+{END}{COLON}{WRAP}]+", " ")
    return F.trim(F.regexp_replace(s, f" ?([{END}{COLON}{WRAP}]) ?", "$1"))


def sentence_pattern() -> str:
    """Known sentences in a prepared text, the longest at a place; only those of full texts may touch a colon."""
    gap = f"[ {COLON}{WRAP}]"
    out = []
    full = {normalised(part) for sentences in SENTENCES.values() for x in sentences for part in re.split(SENTENCE_END, x)}
    for known, edge in ((full, f"[^{END}{COLON}{WRAP}]"), (set(known_sentences()) - full, f"[^{END}{WRAP}]")):
        by_word: dict[str, list[str]] = {}
        for sentence in sorted(known, key=lambda x: (-len(x), x)):
            first, _, rest = sentence.partition(" ")
            by_word.setdefault(first, []).append("".join(gap + re.escape(w) for w in rest.split(" ")) if rest else "")
        lead = LEAD_IN[1:].replace(" ", gap).removesuffix(gap)
        starts = [(f"(?:under|{lead[: lead.index('under') + 5]}(?:{gap}the)?(?:{gap}terms{gap}of(?:{gap}the)?)?)" if w == "under" else re.escape(w), rests) for w, rests in by_word.items()]
        words = "|".join(f"{w}(?:{'|'.join(rests)})(?!{edge})" for w, rests in starts)
        out.append(f"(?<!{edge})(?:[0-9a-z] )?(?:{words})")
    return f"({'|'.join(out)})".replace("(this|the)", "(?:this|the)")


def recognised_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, sentence_no, last_no, identifier, code`` for every known licence sentence.

    ``sentence_no`` counts the pieces that ``SENTENCE_END`` cuts;
    ``last_no`` is the last piece of a sentence of several lines.
    """
    known, code = known_sentences(), codes()
    values = ", ".join(f"('{s}', '{i}', '{code[i]}')" for s, i in known.items())
    table = docs.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(sentence, identifier, code)")
    text = F.col(f"`{text_col}`").cast("string")
    # Each known sentence between two marks; what stands between them alternates with it.
    cut = F.split(F.regexp_replace(_prepared(text), sentence_pattern(), "\x02$1\x02"), "\x02")
    # On one line a colon ends no sentence.
    beside = F.transform("cut", lambda x, i: F.concat(F.right(F.get("cut", i - 1), F.lit(1)), F.left(F.get("cut", i + 1), F.lit(1))).contains(COLON) & ~x.contains(WRAP))
    breaks = lambda x: F.length(F.regexp_replace(x, f"[^{END}{WRAP}]+", ""))
    return (
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), cut.alias("cut"))
        .where(F.size("cut") > 1)
        .withColumn("beside", beside)
        .withColumn("breaks", F.transform("cut", breaks))
        .withColumn("before", F.aggregate("breaks", F.array(F.lit(0)), lambda all_, n: F.concat(all_, F.array(F.element_at(all_, -1) + n))))
        .select("doc_id", "text_key", F.explode(F.arrays_zip("cut", "breaks", "beside", F.slice("before", 1, F.size("cut")).alias("before"), F.sequence(F.lit(0), F.size("cut") - 1).alias("place"))).alias("p"))
        .where("p.place % 2 = 1 AND NOT p.beside")
        .select("doc_id", "text_key", F.col("p.before").alias("sentence_no"), (F.col("p.before") + F.col("p.breaks")).alias("last_no"), _normalised(F.col("p.cut")).alias("sentence"))
        .join(F.broadcast(table), "sentence")  # a fixed table of a few hundred rows
        .drop("sentence")
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_gap: int = MAX_GAP) -> DataFrame:
    """The licences of every whole text: one row per document that states any.

    Columns: ``doc_id``, ``licenses`` (array, in order of appearance, by the
    ordered rules), ``sentence_ids`` and ``sentence_nos`` (the recognised
    sentences as evidence). Null and empty texts and texts without a known
    sentence give no row; repeated rows (same id and text) give one.
    """
    found = recognised_sentences(docs, id_col, text_col)
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("sentence_no", "last_no", "identifier", "code"))).alias("s")
    )
    letters = F.transform(
        "s",
        lambda x, i: F.concat(
            F.when((i > 0) & (x["sentence_no"] - F.get(F.col("s"), i - 1)["last_no"] > max_gap + 1), F.lit("|")).otherwise(F.lit("")),
            x["code"],
        ),
    )
    matched = F.regexp_extract_all(F.array_join(letters, ""), F.lit(rule_pattern()), F.lit(1))
    return (
        per_doc.select("doc_id", "s", matched.alias("m"))
        .where(F.size("m") > 0)
        .select(
            "doc_id",
            F.transform("m", _licence).alias("licenses"),
            F.col("s.identifier").alias("sentence_ids"),
            F.col("s.sentence_no").alias("sentence_nos"),
        )
    )
