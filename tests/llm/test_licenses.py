from __future__ import annotations

import random

from lumenframe.llm import licenses as L

MIT = "\n".join(
    [
        "Some Tool", "", "Permission is hereby granted, free of charge, to any person obtaining a copy", 'of this software and associated documentation files (the "Software"), to deal',
        "in the Software without restriction, including without limitation the rights", "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell", "copies of the Software, and to permit persons to whom the Software is",
        "furnished to do so, subject to the following conditions:", "", "The above copyright notice and this permission notice shall be included in all", "copies or substantial portions of the Software.", "",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR', "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,", "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", "tail",
    ]
)


def names(text):
    return [x[0] for x in L.Recogniser().find(text)]


def test_sentences_and_rules():
    assert names("x y.\nLicensed under the Apache License, Version 2.0.\nmore") == ["Apache-2.0"]
    assert names("LICENSED under   the apache license version 2.0") == ["Apache-2.0"]
    assert names("This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.") == ["GPL-3.0", "CC-BY-NC-4.0"]
    assert names("Not released under the MIT License at all.") == []
    assert names(None) == names("") == names("licence") == []
    (found,) = L.Recogniser().find(MIT)
    assert found[0] == "MIT" and MIT[found[1] :].startswith("Permission") and MIT[: found[2]].endswith("NONINFRINGEMENT")


def test_order_matters():
    rules = (L.Rule("AB", ("a", "b")), L.Rule("B", ("b",)))
    r = L.Recogniser({"a": "First thing", "b": "Second thing"}, rules)
    assert [x[0] for x in r.find("First thing. Second thing.")] == ["AB"]
    assert [x[0] for x in r.find("Second thing. First thing.")] == ["B"]
    assert [x[0] for x in r.find("First thing. Other words. Second thing.")] == ["AB"]


def test_rows(spark, docs, no_docs, texts):
    rows = L.scan(docs).collect()
    assert len(rows) == len(texts) and all(r.licences == [] for r in rows)
    some = spark.createDataFrame([(1, "é\U0001f600. Released under the MIT License."), (2, None), (1, "é\U0001f600. Released under the MIT License.")], "doc_id long, text string")
    got = [[tuple(x) for x in r.licences] for r in L.scan(some).orderBy("id").collect()]
    assert got == [[("MIT", 4, 34)], [("MIT", 4, 34)], []]
    assert L.scan(no_docs).collect() == []


def plain(text, recogniser):
    """Every way to join pieces, looked up among all sentences; then every rule at every place."""
    pieces, at = [], 0
    for m in L._END.finditer(text):
        pieces.append((at, m.start()))
        at = m.end()
    pieces.append((at, len(text)))
    known = {}
    for i, s in L.SENTENCES.items():
        known.setdefault(L.normal(s), i)
    ids, i = [], 0
    while i < len(pieces):
        best = None
        for j in range(i, min(len(pieces), i + 30)):
            if L.normal(text[slice(*pieces[j])]) and L.normal(text[slice(*pieces[i])]):
                whole = " ".join(x for a, b in pieces[i : j + 1] if (x := L.normal(text[a:b])))
                best = (j, known[whole]) if whole in known else best
        if best:
            ids.append((best[1], pieces[i][0], pieces[best[0]][1]))
            i = best[0]
        i += 1
    out, i = [], 0
    while i < len(ids):
        rule = next((r for r in L.RULES if tuple(x[0] for x in ids[i : i + len(r.ids)]) == r.ids), None)
        if rule:
            out.append(rule.licence)
            i += len(rule.ids) - 1
        i += 1
    return out


def test_finds_what_a_plain_search_finds():
    rng = random.Random(8)
    r = L.Recogniser()
    filler = ["Some words here", "Copyright 2020 A. Person", "Version 2.0 of it", "you may", "This program is free software", "Licensed under something else"]
    known = list(L.TEXTS.values()) * 3 + rng.sample(list(L.references().values()), 150)
    seen = set()
    for _ in range(300):
        parts = [rng.choice(known if rng.random() < 0.6 else filler) for _ in range(rng.randint(1, 6))]
        text = "".join(p + rng.choice([". ", ".\n", "\n", "; ", ":\n * "]) for p in parts)
        words = text.split(" ")
        text = "".join(w + (rng.choice([" ", " ", " ", "\n", "\n# "]) if rng.random() < 0.3 else " ") for w in words)
        got = [x[0] for x in r.find(text)]
        assert got == plain(text, r), text
        seen |= set(got)
    assert len(seen) > 25


def test_notices_with_marks_inside():
    text = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nMore."
    assert names(text) == ["GPL-3.0-or-later"]
    assert names("// SPDX-License-Identifier: LGPL-2.1-or-later") == ["LGPL-2.1"]
    assert names("# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy") == ["MPL-2.0"]
    assert names("Copyright 2001 Somebody. All rights reserved.") == ["LicenseRef-all-rights-reserved"]
