"""Licences found by sentence rules.

A text is cut into sentences, each is normalised, and known licence sentences become identifiers.
A sentence may be wrapped: line breaks, and colons and semicolons, may lie inside a known sentence
or end it; full stops and blank lines always end it. What stands before a line's first letter or
digit (comment marks, bullets) does not count.
The identifiers of a text, in order, are matched against rules; a rule is a sequence of
identifiers, the rules have an order, and what a rule has matched is not matched again. Known
sentences that no rule takes, and unknown ones that speak of a licence, are reported as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwatch.llm import texts

# Normalised sentences of published licences and licence notices, and their names.
SENTENCES = {
    "MIT-NAME": ["released under the mit license", "licensed under the mit license", "the mit license", "mit license"],
    "MIT-GRANT": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction"
        " including without limitation the rights to use copy modify merge publish distribute sublicense"
        " and or sell copies of the software and to permit persons to whom the software is furnished to"
        " do so subject to the following conditions"
    ],
    "MIT-NOTICE": [
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software"
    ],
    "AS-IS": [
        "the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
    ],
    "APACHE-2-NAME": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "apache license version 2 0",
    ],
    "APACHE-2-EXCEPT": [
        "you may not use this file except in compliance with the license"
    ],
    "GPL-3-NAME": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "gnu general public license version 3",
    ],
    "GPL-3-LATER": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation either version 3 of the"
        " license or at your option any later version"
    ],
    "GPL-2-LATER": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation either version 2 of the"
        " license or at your option any later version"
    ],
    "GPL-HOPE": [
        "this program is distributed in the hope that it will be useful but without any warranty without"
        " even the implied warranty of merchantability or fitness for a particular purpose"
    ],
    "BSD-GRANT": [
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met"
    ],
    "BSD-SOURCE": [
        "redistributions of source code must retain the above copyright notice this list of conditions and"
        " the following disclaimer"
    ],
    "BSD-BINARY": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions"
        " and the following disclaimer in the documentation and or other materials provided with the"
        " distribution"
    ],
    "BSD-ENDORSE": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse"
        " or promote products derived from this software without specific prior written permission"
    ],
    "CC-BY-NC-4": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"],
    "CC-BY-SA-4": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"],
    "CC-BY-4": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0"],
    "CC0": ["this work is in the public domain", "this work is licensed under cc0 1 0", "licensed under cc0 1 0"],
    "RESERVED": ["all rights reserved"],
}
# Licences by sequences of sentences, the more specific ones first.
RULES = [
    ("MIT", ["MIT-NAME", "MIT-GRANT", "MIT-NOTICE", "AS-IS"]),
    ("MIT", ["MIT-GRANT", "MIT-NOTICE", "AS-IS"]),
    ("MIT", ["MIT-GRANT", "MIT-NOTICE"]),
    ("BSD-3-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"]),
    ("BSD-2-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"]),
    ("Apache-2.0", ["APACHE-2-NAME", "APACHE-2-EXCEPT"]),
    ("GPL-3.0-or-later", ["GPL-3-LATER", "GPL-HOPE"]),
    ("GPL-2.0-or-later", ["GPL-2-LATER", "GPL-HOPE"]),
    ("GPL-3.0-or-later", ["GPL-3-LATER"]),
    ("GPL-2.0-or-later", ["GPL-2-LATER"]),
    ("GPL-3.0", ["GPL-3-NAME"]),
    ("Apache-2.0", ["APACHE-2-NAME"]),
    ("MIT", ["MIT-NAME"]),
    ("CC-BY-NC-4.0", ["CC-BY-NC-4"]),
    ("CC-BY-SA-4.0", ["CC-BY-SA-4"]),
    ("CC-BY-4.0", ["CC-BY-4"]),
    ("CC0-1.0", ["CC0"]),
    ("all-rights-reserved", ["RESERVED"]),
]
#: What a sentence's normal form must hold to count as one about a licence though it is not known.
ABOUT = " license"

#: Where a text on one line, or a line by itself, is cut.
SENTENCE_END = r"(?<=[.!?:;])\s+|\n"
NOT_WORD = r"[^a-z0-9]+"
# Marks in a normalised text: an end of a sentence, a colon or semicolon, an end of a line, and a
# known sentence. Fixed values.
_END, _PART, _LINE, _KNOWN = "\x01", "\x02", "\x03", "\x04"
#: What makes marks of a text in lower case that begins with a line end, step by step. A comment
#: mark is dropped before a line's first letter or digit; a list marker is a part of its own.
_MARKS = [
    (r"\n[^a-z0-9\n]+", "\n"),
    (r"\n(?:dnl|rem)(?=[ \t\n])[^a-z0-9\n]*", "\n"),
    (r"\n([0-9]{1,2}|[a-z]|[ivx]{1,4})\)\s+", f"\n$1{_PART}"),
    (r"\n\n+", _END),
    (r"(?<=[.!?])\s+", _END),
    (r"(?<=[:;])\s+", _PART),
    (r"\n", _LINE),
    (f"[^a-z0-9{_END}{_PART}{_LINE}]+", " "),
]


def marked(text: Column) -> Column:
    """Lower case, one spelling of licence, and single blanks for all that is not a letter, a digit
    or a mark. A mark stands at both ends."""
    plain = F.concat(F.lit("\n"), F.translate(F.lower(text), _END + _PART + _LINE + _KNOWN, "    "))
    for pattern, by in _MARKS:
        plain = F.regexp_replace(plain, pattern, by)
    plain = F.replace(plain, F.lit("licence"), F.lit("license"))
    return F.concat(F.lit(_END), plain, F.lit(_END))


def pattern_of(known: list[str]) -> str:
    """Known sentences in a marked text, the longest at a place: from one mark to another one."""
    words = ["[ \x02\x03]++".join(s.split(" ")) for s in sorted(known, key=len, reverse=True)]
    return f"[\x01-\x03] ?({'|'.join(words)})(?= ?[\x01-\x03])"


def known_sentences(table: dict[str, list[str]]) -> dict[str, str]:
    return {sentence: name for name, sentences in table.items() for sentence in sentences}


def scan(
    docs: DataFrame,
    sentences: dict[str, list[str]] | None = None,
    rules: list[tuple[str, list[str]]] | None = None,
) -> DataFrame:
    """The licences that each row's whole text states.

    Identifiers follow each other in a text whatever unknown sentences lie between them. A rule
    takes every place where its sequence occurs, then the next rule is tried on what is left. Null
    and empty texts, and texts without any licence sentence, have empty results. Rows are looked
    at one by one, so repeated ones and null ids do no harm, and nothing is shuffled. An empty
    table gives no rows; only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id``, ``sentences`` (identifiers in order), ``places`` (their sentence numbers,
    without empty ones),
    ``licences`` (in the rules' order, each once), ``unmatched`` (identifiers no rule took),
    ``unknown`` (sentences that speak of a licence and are not known).
    """
    known = known_sentences(sentences or SENTENCES)
    rules = rules or RULES
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    pattern = pattern_of(list(known))
    rows = docs.select("doc_id", marked(texts.text_or_empty()).alias("marked"))
    # a known sentence is set apart, what is left of the lines around it is joined
    parts = F.split(
        F.regexp_replace("marked", pattern, _END + _KNOWN + _END), f"[{_END}{_PART}][ {_END}{_PART}{_LINE}]*"
    )
    parts = F.filter(parts, lambda s: F.trim(F.translate(s, _LINE, " ")) != "")
    numbered = F.transform(parts, lambda s, i: F.struct(s.alias("s"), i.alias("i")))
    of_note = F.filter(
        numbered,
        lambda x: (x["s"] == _KNOWN)
        | F.concat(F.lit(" "), F.translate(x["s"], _LINE, " ")).contains(ABOUT),
    )
    hits = F.regexp_extract_all("marked", F.lit(pattern), F.lit(1))
    rows = rows.select("doc_id", of_note.alias("note"), hits.alias("hits"))
    found = rows.select(
        "doc_id",
        F.size(F.filter("note", lambda x: x["s"] != _KNOWN)).cast("long").alias("unknown"),
        F.transform(
            "hits", lambda s: F.element_at(names, F.regexp_replace(s, f"[ {_PART}{_LINE}]+", " "))
        ).alias("sentences"),
        F.transform(F.filter("note", lambda x: x["s"] == _KNOWN), lambda x: x["i"]).alias("places"),
    )
    # identifiers as a text in which each stands between commas, so that a rule is a text too
    left = F.array_join(F.transform("sentences", lambda x: F.concat(F.lit(","), x, F.lit(","))), "")
    out = found.withColumns({"left": left, "licences": F.array().cast("array<string>")})
    for licence, sequence in rules:
        text = "".join(f",{name}," for name in sequence)
        out = out.select(
            "doc_id",
            "sentences",
            "places",
            "unknown",
            F.when(
                F.contains("left", F.lit(text)),
                F.array_union("licences", F.array(F.lit(licence))),
            ).otherwise(F.col("licences")).alias("licences"),
            F.replace("left", F.lit(text), F.lit("|")).alias("left"),
        )
    unmatched = F.filter(F.split("left", "[,|]+"), lambda x: x != "")
    return out.withColumn("unmatched", unmatched).drop("left")
