"""Licence notices by sentence rules.

A text is cut into sentences, each is normalised (lower case, runs of other characters than
letters and digits become one space) and looked up among known licence sentences. What is
left is a sequence of identifiers with their places. A rule names a licence and an ordered
sequence of identifiers; it matches where they follow each other with at most ``MAX_GAP``
unknown or other sentences between two. Where matches overlap, the one of more identifiers
stands; the same licence is reported once for each place.

One narrow pass over whole texts, no shuffle. A text without any of ``CUES`` holds no known
sentence, since each of them has one, and is passed over.

Null and empty texts, and texts without a notice, give no row. Repeated rows repeat their
matches; null ids stay null. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from safelabel.llm.store import named, unnamed

MAX_GAP = 2
FOUND = "doc_id long, license string, rule string, sentences int, first_char int, last_char int"

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-name": ["The MIT License", "MIT License", "The MIT License (MIT)"],
    "mit-grant": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        'publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do '
        'so, subject to the following conditions:'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        'MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "mit-short": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "apache-header": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'],
    "apache-obtain": ["You may obtain a copy of the License at"],
    "apache-warranty": [
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
        'BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "apache-permissions": ["See the License for the specific language governing permissions and limitations under the License."],
    "apache-short": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.", "Licensed under the Apache License 2.0."],
    "bsd-grant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission."],
    "gpl-redistribute": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "gpl-hope": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl-details": ["See the GNU General Public License for more details."],
    "gpl3-short": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.",
        "Licensed under the GPLv3."],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."],
    "mpl-header": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense-grant": ["This is free and unencumbered software released into the public domain."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "rights": ["All rights reserved."],
}
# Ordered rules: licence, name, identifiers that follow each other.
RULES = [
    ("MIT", "mit-full", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", "mit-grant", ("mit-grant", "mit-notice")),
    ("MIT", "mit-short", ("mit-short",)),
    ("Apache-2.0", "apache-full", ("apache-header", "apache-obtain", "apache-warranty", "apache-permissions")),
    ("Apache-2.0", "apache-header", ("apache-header",)),
    ("Apache-2.0", "apache-short", ("apache-short",)),
    ("BSD-3-Clause", "bsd3", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "bsd2", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0", "gpl3-full", ("gpl-redistribute", "gpl-hope", "gpl-details")),
    ("GPL-3.0", "gpl3-grant", ("gpl-redistribute",)),
    ("GPL-3.0", "gpl3-short", ("gpl3-short",)),
    ("ISC", "isc", ("isc-grant", "mit-warranty")),
    ("ISC", "isc-grant", ("isc-grant",)),
    ("MPL-2.0", "mpl", ("mpl-header",)),
    ("Unlicense", "unlicense", ("unlicense-grant",)),
    ("CC-BY-4.0", "cc-by", ("cc-by",)),
    ("CC-BY-SA-4.0", "cc-by-sa", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", "cc-by-nc", ("cc-by-nc",)),
    ("proprietary", "rights", ("rights",)),
]
CUES = ("licen", "gpl", "permission", "redistribution", "warrant", "rights reserved", "copyright", "public domain", "free software")

_END = re.compile(r"(?<=[.!?:])\s+(?=\S)|\s*\n\s*\n\s*")
_OTHER = re.compile(r"[^0-9a-z]+")
_SPACE = re.compile(r"\s+")


def normal(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


KNOWN = {normal(s): name for name, sentences in SENTENCES.items() for s in sentences}
# Sentences with a stop inside, such as "v. 2.0", are cut there like any text: known by their parts in a row.
_LONGEST = max(len(_END.split(s)) for sentences in SENTENCES.values() for s in sentences)


def sentences(text: str) -> list[tuple[int, int]]:
    """(from, to) of each sentence; a line end counts as a stop only where it ends a known sentence or a paragraph."""
    out, at = [], 0
    for m in _END.finditer(text):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def identifiers(text: str) -> list[tuple[int, str, int, int]]:
    """(sentence number, identifier, from, to) of known sentences; also lines that are one."""
    out = []
    for k, (a, b) in enumerate(spans := sentences(text)):
        if (name := KNOWN.get(normal(text[a:b]))):
            out.append((k, name, a, b))
            continue
        for n in range(2, _LONGEST + 1):
            if k + n <= len(spans) and (name := KNOWN.get(normal(text[a : spans[k + n - 1][1]]))):
                out.append((k, name, a, spans[k + n - 1][1]))
                break
        else:
            at = a
            for line in text[a:b].split("\n"):
                if (name := KNOWN.get(normal(line))):
                    out.append((k, name, at, at + len(line)))
                at += len(line) + 1
    return out


def recognise(text: str | None) -> list[tuple[str, str, int, int, int]]:
    """(licence, rule, number of sentences, from, to) of the notices in a text, in order."""
    low = (text or "").lower()
    if not any(c in low for c in CUES):
        return []
    found = identifiers(text)
    matches = []
    for i in range(len(found)):
        for order, (licence, rule, wanted) in enumerate(RULES):
            if found[i][1] != wanted[0]:
                continue
            at = i
            for name in wanted[1:]:
                near = (j for j in range(at + 1, len(found)) if found[j][0] - found[at][0] <= MAX_GAP + 1 and found[j][1] == name)
                at = next(near, None)
                if at is None:
                    break
            if at is not None:
                matches.append((-len(wanted), order, i, at, licence, rule, found[i][2], found[at][3]))
    out, taken = [], set()
    for n, _, i, j, licence, rule, a, b in sorted(matches):
        if not taken.intersection(range(i, j + 1)):
            taken.update(range(i, j + 1))
            out.append((licence, rule, -n, a, b))
    return sorted(out, key=lambda m: m[3])


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = [(doc, *m) for doc, text in zip(frame["doc_id"], frame["text"], strict=True) for m in recognise(text)]
        yield pd.DataFrame(out, columns=["doc_id", "license", "rule", "sentences", "first_char", "last_char"])


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, license, rule, sentences, first_char, last_char) of every notice."""
    return unnamed(documents.select(named("doc_id"), "text").mapInPandas(_scan, FOUND), "doc_id")
