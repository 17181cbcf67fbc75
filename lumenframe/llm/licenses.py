"""Licence scans: known sentences become identifiers, and ordered rules match their sequence."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, ship

# Sentences as the public licences have them, and their SPDX names.

#: Sentences of licence texts and of the notices that refer to them.
TEXTS = {
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "apache-grant": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-terms": "you may not use this file except in compliance with the License",
    "apache-asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "gpl2-grant": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl21-grant": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "zlib-asis": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0",
    "cc0-waiver": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work",
    "epl2-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "reserved": "All rights reserved",
}

#: SPDX name of each licence, and how short references name it.
NAMES = {
    "MIT": ("MIT License", "MIT licence", "Expat License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache Software License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3", "AGPL-3.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v2.0"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "Unlicense": ("Unlicense",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    "CC-BY-3.0": ("CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"),
}

#: How a short reference begins.
LEADS = ("Released under", "Licensed under", "Distributed under", "Available under", "This work is licensed under", "This project is licensed under", "This software is licensed under", "This text is available under", "This file is licensed under", "This code is released under")


def references() -> dict[str, str]:
    """Every lead with every name, with and without an article, and SPDX lines, by identifier."""
    out = {}
    for spdx, names in NAMES.items():
        said = [f"{lead} {the}{name}" for name in names for lead in LEADS for the in ("", "the ", "a ")]
        said += [f"{lead} the terms of the {name}" for name in names for lead in LEADS]
        kinds = [spdx, *(f"{spdx}-{end}" for end in ("only", "or-later") if "GPL" in spdx)]
        said += [f"SPDX-License-Identifier: {k}" for k in kinds]
        out |= {f"ref:{spdx}:{i}": x for i, x in enumerate(said)}
    return out


SENTENCES = TEXTS | references()


@dataclass(frozen=True)
class Rule:
    """``licence`` where these identifiers follow each other, other known sentences not between."""

    licence: str
    ids: tuple[str, ...]


#: In order: of rules that match at one place, the first counts.
RULES = (
    Rule("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    Rule("MIT", ("mit-grant",)),
    Rule("Apache-2.0", ("apache-grant", "apache-terms", "apache-asis")),
    Rule("Apache-2.0", ("apache-grant",)),
    Rule("GPL-2.0-or-later", ("gpl2-grant",)),
    Rule("GPL-2.0-only", ("gpl2-only",)),
    Rule("GPL-3.0-or-later", ("gpl-grant",)),
    Rule("LGPL-2.1-or-later", ("lgpl21-grant",)),
    Rule("LGPL-3.0-or-later", ("lgpl3-grant",)),
    Rule("AGPL-3.0-or-later", ("agpl3-grant",)),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-endorse")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("BSD-2-Clause", ("bsd-grant",)),
    Rule("MPL-2.0", ("mpl-notice",)),
    Rule("ISC", ("isc-grant",)),
    Rule("0BSD", ("0bsd-grant",)),
    Rule("Zlib", ("zlib-asis", "zlib-grant")),
    Rule("Zlib", ("zlib-grant",)),
    Rule("Unlicense", ("unlicense",)),
    Rule("BSL-1.0", ("boost-notice",)),
    Rule("CC0-1.0", ("cc0-waiver",)),
    Rule("EPL-2.0", ("epl2-notice",)),
    Rule("LicenseRef-all-rights-reserved", ("reserved",)),
    *(Rule(i.split(":")[1], (i,)) for i in references()),
)

_TOKEN = re.compile(r"[A-Za-z0-9]+")
_END = re.compile(r"[.;:!?]+(?=\s|\Z)|\n")


def normal(sentence: str) -> str:
    """Lower-cased runs of ASCII letters and digits, one space between."""
    return " ".join(_TOKEN.findall(sentence)).lower()


def _hints(sentences: list[str]) -> list[str]:
    """A few words of which each sentence holds one, so a text without any can be passed over.

    The word that most sentences have first; words under five letters only where there is no other.
    """
    holders: dict[str, set[int]] = {}
    for i, s in enumerate(sentences):
        words = s.split(" ")
        for w in [w for w in words if len(w) >= 5] or [max(words, key=len)]:
            holders.setdefault(w, set()).add(i)
    out: list[str] = []
    left = set(range(len(sentences)))
    while left:
        best = max(sorted(holders), key=lambda w: len(holders[w] & left))
        out.append(best)
        left -= holders.pop(best)
    return [w for w in out if not any(o != w and o in w for o in out)]


@functools.lru_cache(maxsize=4)
def _recogniser(sentences: tuple, rules: tuple) -> Recogniser:
    """One for each table of sentences in a process, as a worker has many tasks."""
    return Recogniser(dict(sentences), rules)


class Recogniser:
    """Finds licences in a text; see ``find``."""

    def __init__(self, sentences: dict[str, str] = SENTENCES, rules: tuple[Rule, ...] = RULES) -> None:
        #: The known sentences as a tree of words; the key None holds the identifier of one that ends.
        self.tree: dict = {}
        norms = {}
        for i, s in sentences.items():
            norms.setdefault(normal(s), i)  # the first of sentences that read alike
        for s, i in norms.items():
            node = self.tree
            for w in s.split(" "):
                node = node.setdefault(w, {})
            node[None] = i
        self.rules: dict[str, list[Rule]] = {}
        for r in rules:
            self.rules.setdefault(r.ids[0], []).append(r)
        self.hints = _hints([s for s in norms if s])

    def sentences(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, identifier) of the known sentences, in order, none inside another.

        A piece ends at a mark before white space, or at a line's end. A known sentence begins
        and ends with a piece and may run on over several, as licences are often wrapped and
        some have marks inside; the longest known sentence that begins with a piece counts.
        """
        pieces, at = [], 0
        for m in _END.finditer(text):
            pieces.append((at, m.start()))
            at = m.end()
        pieces.append((at, len(text)))
        out, i = [], 0
        while i < len(pieces):
            first = _TOKEN.search(text, *pieces[i])
            found, node, j = None, self.tree if first and first[0].lower() in self.tree else None, i
            while node is not None and j < len(pieces):
                words = normal(text[slice(*pieces[j])]).split()
                for w in words:
                    node = node.get(w)
                    if node is None:
                        break
                if node is not None and words and None in node:
                    found = (j, node[None])
                j += 1
            if found:
                a, b = pieces[i][0], pieces[found[0]][1]
                lead = len(text[a:b]) - len(text[a:b].lstrip())
                out.append((a + lead, a + len(text[a:b].rstrip()), found[1]))
                i = found[0]
            i += 1
        return out

    def find(self, text: str | None) -> list[tuple[str, int, int]]:
        """(licence, start, end) in order; offsets are code points, the end exclusive."""
        if not text:
            return []
        low = text.lower()
        if not any(h in low for h in self.hints):
            return []
        known = self.sentences(text)
        ids = [x[2] for x in known]
        out, i = [], 0
        while i < len(ids):
            for r in self.rules.get(ids[i], ()):
                if tuple(ids[i : i + len(r.ids)]) == r.ids:
                    out.append((r.licence, known[i][0], known[i + len(r.ids) - 1][1]))
                    i += len(r.ids) - 1
                    break
            i += 1
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] = SENTENCES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: id, licences (array of licence, start, end), in order of start.

    Null and empty texts have none. Rows repeat as in ``docs``; extra columns are not read;
    nothing moves between tasks.
    """
    ship(docs.sparkSession)
    found_type = T.ArrayType(T.StructType([T.StructField("licence", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("licences", found_type)])
    arrow = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _recogniser(tuple(sentences.items()), tuple(rules))
        for b in chunks(batches, "text"):
            rows = [[{"licence": x, "start": s, "end": e} for x, s, e in own.find(t)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, arrow)], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
