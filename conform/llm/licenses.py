"""License notices found by their wording, with how much a template helps to compress them."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache

import zstandard
from pyspark.sql import DataFrame

from conform.llm.arrow import map_blocks, texts

# Names in short notices: each after every verb.
NAMES = {
    "AGPL-3.0": ["the GNU Affero General Public License, version 3"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License"],
    "BSL-1.0": ["the Boost Software License, Version 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "GPL-2.0": ["the GNU General Public License, version 2"],
    "GPL-3.0": ["the GNU General Public License, version 3"],
    "ISC": ["the ISC License"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3"],
    "MIT": ["the MIT License"],
    "MPL-2.0": ["the Mozilla Public License, Version 2.0", "the Mozilla Public License 2.0"],
    "Unlicense": ["the Unlicense"],
}
VERBS = ["This work is licensed under", "Licensed under", "Released under", "Distributed under", "or"]
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU {1} as published by the Free Software Foundation, either version {2} of the License, or "
    "(at your option) any later version."
)
# Standard headers and the paragraphs of licence texts that only they hold.
HEADERS = {
    "AGPL-3.0": [_GNU.format("program", "Affero General Public License", "3")],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ],
    "BSL-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
        "and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:",
    ],
    "GPL-2.0": [_GNU.format("program", "General Public License", "2")],
    "GPL-3.0": [_GNU.format("program", "General Public License", "3")],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "LGPL-2.1": [_GNU.format("library", "Lesser General Public License", "2.1")],
    "LGPL-3.0": [_GNU.format("library", "Lesser General Public License", "3")],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: Words that tell licences apart. A match holds all that its template has, and those with a digit.
TELLING = {
    *"affero apache attribution attribution-noncommercial attribution-sharealike boost bsd".split(),
    *"bsd-style by by-nc by-sa endorse fee gnu isc lesser mit mozilla sublicense".split(),
    *"third-parties unencumbered unlicense".split(),
}
TRIGGER = re.compile(
    r"licen[sc]e|copyright|creative\s+commons|\bcc\s+by\b|public\s+domain|spdx", re.I
)
#: A sentence ends before a blank and a capital, or with its line.
SENTENCE_END = re.compile(r"(?<=[.!?])\s+(?=[^\W\d_a-z])|\n+")
#: Blocks end at lines without a letter or digit, which in comments hold marks.
BLOCK_END = re.compile(r"\n(?:[^\w\n]*\n)+")
#: A match holds this share of its template's words, in order, and so few others for each.
LEAST_WORDS, MOST_OTHERS = 0.9, 0.25
WORD = re.compile(r"\w+(?:[.-]\w+)*")
SCHEMA = (
    "doc_id long, n_blocks long, licenses string, spans string, reductions string, "
    "differences string"
)


def _word(word: str) -> str:
    """A word as it is compared: British and American spelling, ``v2.0`` and ``2.0`` are one."""
    word = word.lower().replace("licence", "license")
    if word == "v":
        return "version"
    return word[1:] if word[0] == "v" and word[1:2].isdigit() else word


def _templates() -> list[tuple[str, str]]:
    """License and wording: notices with each verb, headers, and SPDX lines."""
    found = []
    for name, named in NAMES.items():
        found += [(name, f"{verb} {n}") for verb in VERBS for n in named]
        found += [(name, text) for text in HEADERS.get(name, [])]
        ids = [name]
        if "GPL" in name:
            ids += [f"{name}-only", f"{name}-or-later", f"{name}+"]
        found += [(name, f"SPDX-License-Identifier: {i}") for i in ids]
    return found


TEMPLATES = _templates()


def _telling(words: list[str]) -> list[int]:
    spdx = words[0] == "spdx-license-identifier"
    return [i for i, w in enumerate(words) if spdx or w in TELLING or any(map(str.isdigit, w))]


#: Words of each template and the places of those that a match must hold.
WORDINGS = [
    (words, _telling(words)) for words in ([_word(w) for w in WORD.findall(t)] for _, t in TEMPLATES)
]


#: Words that a match can have at most, and so what a candidate needs around its trigger.
WIDEST = max(len(words) + int(MOST_OTHERS * len(words)) for words, _ in WORDINGS)
#: Candidates that lie close are one, up to so many words; longer ones share WIDEST words.
STRETCH = 4 * WIDEST
#: Words around a winner's place that are ranked with it once more.
MARGIN = 3


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=9, write_content_size=False)


@lru_cache(maxsize=1 << 4)
def _plain_size(block: str) -> int:
    return len(_compressor().compress(block.encode()))


@lru_cache(maxsize=len(TEMPLATES))
def _with_template(number: int) -> zstandard.ZstdCompressor:
    """With a template as raw dictionary, for each worker."""
    words = zstandard.ZstdCompressionDict(
        TEMPLATES[number][1].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    return zstandard.ZstdCompressor(level=9, dict_data=words, write_content_size=False)


def candidates(text: str) -> list[tuple[int, int]]:
    """Blocks with a trigger, by their places in code points; whole texts are searched."""
    if not TRIGGER.search(text):
        return []
    found, start = [], 0
    for end in [*BLOCK_END.finditer(text), None]:
        stop = end.start() if end else len(text)
        if TRIGGER.search(text, start, stop):
            found.append((start, stop))
        start = end.end() if end else stop
    return found


def reduction(block: str, number: int) -> float:
    """By how much a template shrinks the compressed block."""
    return 1 - len(_with_template(number).compress(block.encode())) / _plain_size(block)


@lru_cache(maxsize=1 << 12)
def ranking(block: str) -> list[int]:
    """Templates that shrink the compressed block, from the one that shrinks it most."""
    shrunk = [(reduction(block, number), -number) for number in range(len(TEMPLATES))]
    return [-number for share, number in sorted(shrunk, reverse=True) if share > 0]


@lru_cache(maxsize=1 << 14)
def _extended(wanted: tuple[str, ...], found: tuple[str, ...]) -> tuple[list, list, int]:
    """``wanted`` laid along the start of ``found``: words lacking, words besides, words used."""
    width = len(found) + 1
    costs = [list(range(width))]
    for i, word in enumerate(wanted, 1):
        above, row = costs[-1], [i]
        for j, other in enumerate(found):
            least = min(above[j + 1], row[j]) + 1
            row.append(min(least, above[j]) if word == other else least)
        costs.append(row)
    used = j = min(range(width), key=lambda x: (costs[-1][x], x))
    i, lacking, besides = len(wanted), [], []
    while i or j:
        if i and j and wanted[i - 1] == found[j - 1] and costs[i][j] == costs[i - 1][j - 1]:
            i, j = i - 1, j - 1
        elif i and costs[i][j] == costs[i - 1][j] + 1:
            i -= 1
            lacking.append(wanted[i])
        else:
            j -= 1
            besides.append(found[j])
    return lacking[::-1], besides[::-1], used


def matches(words: list[str], number: int) -> list[tuple[int, int, list[str], list[str]]]:
    """First and last word, words lacking and besides of a template's matches, apart.

    The template is laid along the words from each place of one of its telling
    words, to both sides; what is before its first word and after its last is not judged.
    Of places that share words the one with least differences stands, then the first.
    """
    wanted, telling = WORDINGS[number]
    places: dict[str, list[int]] = {wanted[i]: [] for i in telling}
    for at, word in enumerate(words):
        if word in places:
            places[word].append(at)
    if not all(places.values()):
        return []
    anchor = min(telling, key=lambda i: len(places[wanted[i]]))
    most_lacking = int((1 - LEAST_WORDS) * len(wanted) + 1e-9)
    most_besides = int(MOST_OTHERS * len(wanted))
    found = []
    for at in places[wanted[anchor]]:
        before = words[max(0, at - anchor - most_besides) : at]
        after = words[at + 1 : at + len(wanted) - anchor + most_besides]
        near = Counter([*before, words[at], *after])
        if (Counter(wanted) - near).total() > most_lacking:
            continue
        left_lacking, left_besides, left = _extended(
            tuple(wanted[:anchor][::-1]), tuple(before[::-1])
        )
        lacking, besides, right = _extended(tuple(wanted[anchor + 1 :]), tuple(after))
        lacking = left_lacking[::-1] + lacking
        besides = left_besides[::-1] + besides
        if (
            len(lacking) <= most_lacking
            and len(besides) <= most_besides
            and not any(wanted[i] in lacking for i in telling)
        ):
            found.append((len(lacking) + len(besides), at - left, at + right, lacking, besides))
    return _apart(sorted(found))


def _apart(ranked: list[tuple]) -> list[tuple]:
    """Of matches from the best on, those without a word of a better one, in the text's order."""
    taken: set[int] = set()
    chosen = []
    for _, first, last, *rest in ranked:
        if taken.isdisjoint(range(first, last + 1)):
            taken.update(range(first, last + 1))
            chosen.append((first, last, *rest))
    return sorted(chosen, key=lambda match: match[0])


def windows(text: str, spots: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """Candidate blocks of a paragraph, as first word and word after the last.

    Each trigger takes the words around it that a match could have; blocks that meet
    are one, and one of more than STRETCH words is dealt out in several that share as
    many words as a match can have.
    """
    ends = [b for _, b in spots]
    found: list[list[int]] = []
    for trigger in TRIGGER.finditer(text, start, end):
        at = bisect_right(ends, trigger.start())
        first, last = max(0, at - WIDEST), min(len(spots), at + WIDEST)
        if found and first <= found[-1][1]:
            found[-1][1] = last
        else:
            found.append([first, last])
    return [
        (at, min(at + STRETCH, last))
        for first, last in found
        for at in range(first, max(first + 1, last - WIDEST), STRETCH - WIDEST)
    ]


def confirmed(
    text: str, spots: list[tuple[int, int]], words: list[str], first: int, last: int
) -> list[tuple[int, int, int, list[str], list[str]]]:
    """First and last word, template, words lacking and besides of the notices in a block.

    The block is compressed with every template; the ranking by size reduction is gone
    down until the exact wording confirms a template. As a block may hold several
    notices, each place of this winner is ranked again by itself. The words before,
    between and after are blocks of their own if they have a trigger.
    """

    def winner(first, last):
        block = text[spots[first][0] : spots[last - 1][1]] if first < last else ""
        for number in ranking(block) if TRIGGER.search(block) else ():
            held = matches(words[first:last], number)
            if held:
                return [(first + a, first + b, number, *told) for a, b, *told in held]
        return []

    found, blocks = [], [(first, last)]
    while blocks:
        first, last = blocks.pop()
        left = first
        for match in winner(first, last):
            near = max(first, match[0] - MARGIN), min(last, match[1] + 1 + MARGIN)
            found += (winner(*near) if near != (first, last) else []) or [match]
            blocks.append((left, match[0]))
            left = match[1] + 1
        if left > first:
            blocks.append((left, last))
    return found


def notices(text: str) -> list[tuple[int, int, str, float, str]]:
    """Start, end, license, size reduction and wording differences of each confirmed notice.

    A notice is the sentences or lines that a match touches, its reduction that of
    them by the template. Of matches from two stretches of one block that share words
    the longer one stands.
    """
    found = []
    for start, end in candidates(text):
        spots = [(m.start(), m.end()) for m in WORD.finditer(text, start, end)]
        words = [_word(text[a:b]) for a, b in spots]
        matched = [
            (first - last, first, last, number, lacking, besides)
            for left, right in windows(text, spots, start, end)
            for first, last, number, lacking, besides in confirmed(text, spots, words, left, right)
        ]
        if not matched:
            continue
        starts, stops = [start], []
        for gap in SENTENCE_END.finditer(text, start, end):
            stops.append(gap.start())
            starts.append(gap.end())
        stops.append(end)
        for first, last, number, lacking, besides in _apart(sorted(matched)):
            here = starts[bisect_right(starts, spots[first][0]) - 1]
            there = stops[bisect_left(stops, spots[last][1])]
            told = " ".join([*(f"-{w}" for w in lacking), *(f"+{w}" for w in besides)])
            shrunk = reduction(text[here:there], number)
            found.append((here, there, TEMPLATES[number][0], shrunk, told))
    return found


def document_licenses(documents: DataFrame) -> DataFrame:
    """Every document with its license notices, in the order of the text.

    ``n_blocks`` counts paragraphs with a trigger, confirmed or not; the lists of licenses,
    spans (``license:start:end``), reductions (three digits) and differences (words
    lacking with ``-``, others with ``+``) hold confirmed ones, joined by commas, the
    last by ``|``. Null and empty texts have none; repeated rows are scanned each; an
    empty table gives an empty one; other columns are not read.
    """

    def scanned(block):
        rows = []
        for doc_id, text in zip(block.column("doc_id").to_pylist(), texts(block), strict=True):
            blocks = len(candidates(text))
            found = notices(text) if blocks else []
            rows.append(
                (
                    doc_id,
                    blocks,
                    ",".join(name for _, _, name, _, _ in found),
                    ",".join(f"{name}:{start}:{end}" for start, end, name, _, _ in found),
                    ",".join(f"{reduction:.3f}" for _, _, _, reduction, _ in found),
                    "|".join(told for *_, told in found),
                )
            )
        return list(map(list, zip(*rows, strict=True)))

    return map_blocks(documents.select("doc_id", "text"), "text", scanned, SCHEMA)
