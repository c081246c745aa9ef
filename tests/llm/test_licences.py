"""Licence sentences and rules beside a plain loop."""

import re

from fillwatch.llm import licences

SCHEMA = "doc_id long, text string, sentences string, unknown int, left string"
MIT = (
    "Copyright (c) 2020 Somebody.\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including"
    " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
    " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the"
    " Software."
)
ROWS = [
    (1, MIT + "\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED"
        " TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    (2, MIT), (3, "Some text. Released under the MIT Licence.\nMore text! All rights reserved."),
    (4, "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License."),
    (5, "See the licence of our partners. Nothing else."), (6, "A licensed plumber. An unlicensed one"), (7, None), (8, ""),
    (None, "Licensed under CC BY-NC 4.0."), (9, "Released under the MIT License.\nReleased under the MIT License."),
    (9, "Released under the MIT License."), (10, "word. " * 30000 + "\nAll rights reserved."),
    (11, "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the"
         " warranties of merchantability, fitness for a particular purpose and noninfringement."),
]


def wanted(text):
    known = licences.known_sentences(licences.SENTENCES)
    found, unknown = [], 0
    for sentence in re.split(licences.SENTENCE_END, text or ""):
        plain = re.sub(licences.NOT_WORD, " ", sentence.lower()).strip().replace("licence", "license")
        if plain in known:
            found.append(known[plain])
        elif " license" in f" {plain}":
            unknown += 1
    out, left = [], list(found)
    for licence, rule in licences.RULES:
        i = 0
        while i + len(rule) <= len(left):
            if left[i : i + len(rule)] == rule:
                out += [licence] * (licence not in out)
                left[i : i + len(rule)] = [None]
            i += 1
    return found, out, [x for x in left if x], unknown


def test_scan(spark):
    docs = spark.createDataFrame([(i, t, "s", 1, "l") for i, t in ROWS], SCHEMA)
    got = licences.scan(docs).collect()
    want = sorted(str((i, *wanted(t))) for i, t in ROWS)
    assert sorted(str((r.doc_id, r.sentences, r.licences, r.unmatched, r.unknown)) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].licences == ["MIT"] and by_id[3].licences == ["MIT", "all-rights-reserved"]
    assert by_id[3].places == [1, 3] and by_id[11].unmatched == ["AS-IS"] and by_id[5].unknown == 1
    assert licences.scan(docs.limit(0)).count() == 0


def test_names_and_sentences_are_well_formed():
    names = set(licences.SENTENCES)
    assert all(set(rule) <= names for _, rule in licences.RULES)
    for sentence in licences.known_sentences(licences.SENTENCES):
        assert sentence == re.sub(licences.NOT_WORD, " ", sentence.lower()).strip().replace("licence", "license")


def _wrapped(text, width, mark=""):
    import textwrap

    return "\n".join(mark + line for line in textwrap.wrap(text, width, break_on_hyphens=False))


APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
    " the License. You may obtain a copy of it elsewhere."
)
GPL_3 = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
    " version."
)
HOPE = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
    " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
)
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
    " disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution.",
]


def test_wrapped_texts(spark):
    whole = "\n".join(" ".join(p.split()) for p in ROWS[0][1].split("\n"))
    want, made = [], []
    for mark in ("", "# ", " * ", "// ", ";; ", "! ", "dnl ", "-- "):
        for width in (30, 72, 80):
            one = {
                "MIT": "\n".join(_wrapped(p, width, mark) or mark for p in whole.split("\n")),
                "Apache-2.0": _wrapped(APACHE, width, mark),
                "GPL-3.0-or-later": f"{_wrapped(GPL_3, width, mark)}\n{mark}\n{_wrapped(HOPE, width, mark)}",
                "GPL-2.0-or-later": _wrapped(GPL_3.replace("version 3", "version 2").replace("software:", "software;"), width, mark),
            }
            for item in ("{}. ", "({}) ", "{}) ", "* "):
                items = [_wrapped((item.format(i) if i else "") + p, width, mark) for i, p in enumerate(BSD)]
                one["BSD-2-Clause", item] = "\r\n".join(items)
            for name, text in one.items():
                made.append(f"int main;\n{text}\nint x;" if mark == "// " else text)
                want.append(name if isinstance(name, str) else name[0])
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(docs).collect()}
    wrong = [(made[i], got[i]) for i, w in enumerate(want) if got[i].licences != [w] or got[i].unmatched]
    assert not wrong


def test_line_ends_and_sentence_ends_still_part(spark):
    made = ["by us\nMIT License\nfor all", "under the mit.\nLicense", "the mit\n\nlicense", "read our\nlicense and our\nlicense"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.unknown) for r in licences.scan(docs).collect()}
    assert got == {0: (["MIT"], 0), 1: ([], 1), 2: ([], 1), 3: ([], 1)}
