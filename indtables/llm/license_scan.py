"""License scan by patience alignment.

A text is aligned with a license template word by word: equal beginnings and
ends are taken off, words that are unique in both sides are anchors, the
longest increasing subsequence of their places is kept, and the gaps between
are aligned the same way. Coverage is the share of the template's words that
are aligned; a place of a text with coverage of at least ``min_coverage`` is a
finding.

Coverage alone does not tell licences apart that differ in a word. A template may
name phrases that must be aligned, word for word (its family, its version), and
words that must not stand among the words put in between, nor just before
("not", "Lesser"). Of findings that overlap, whatever their templates, the one with
the most aligned words stays (ties: the shorter place, the first, the name).

Where to align: findings miss at most ``1 - min_coverage`` of the template's
words, so among any larger number of template words one is aligned. The
longest (rarest) such words vote: an occurrence at place p of the template's
word o proposes the window of the template's length at p - o, as it is (next
to another copy, words are unique only there), widened by ``slack`` words on
both sides, and, while that gains words, by the template's length on both sides: a
notice with markup or line numbers in between is found up to ``SPREAD`` times its
length. Every proposed window is aligned.

Templates are a bounded argument (checked) and travel with the tasks;
documents are not shuffled.

Defined results: null and empty texts and templates without words have no
findings; repeated rows each give their findings; an empty table gives none;
other columns are ignored; long texts are scanned whole."""

from __future__ import annotations

import bisect
import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from indtables.llm.common import id_text, map_batches
from indtables.llm.decontaminate import char_spans, words

MIN_COVERAGE = 0.8
MAX_TEMPLATE_BYTES = 16 * 1024 * 1024
SPREAD = 3
BEFORE = 2


@dataclass(frozen=True)
class Notice:
    """A template: its text, phrases that must be aligned, words that must not be in
    between or up to ``BEFORE`` words ahead."""

    text: str
    required: tuple[str, ...] = ()
    excluded: str = "not never no nor without"


# Public license notices and headers, the phrases that tell them apart.
_GPL_WORDS = "not never no nor without lesser library affero"
_GPL_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {family}General "
    "Public License as published by the Free Software Foundation, either version {version} of the License, or (at your "
    "option) any later version."
)
_GPL_NOTICE = "This work is licensed under the GNU {family}General Public License, version {version}."
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
TEMPLATES = {
    "MIT": Notice("Released under the MIT License.", ("mit",)),
    "BSD": Notice("Released under the BSD License.", ("bsd",)),
    "GPL": Notice("Released under the GPL License.", ("gpl",)),
    "Apache-2.0": Notice("Licensed under the Apache License, Version 2.0.", ("apache", "2 0")),
    "GPL-2.0": Notice(_GPL_NOTICE.format(family="", version="2"), ("general public", "2"), _GPL_WORDS),
    "GPL-3.0": Notice(_GPL_NOTICE.format(family="", version="3"), ("general public", "3"), _GPL_WORDS),
    "LGPL-2.1": Notice(_GPL_NOTICE.format(family="Lesser ", version="2.1"), ("lesser", "2 1")),
    "LGPL-3.0": Notice(_GPL_NOTICE.format(family="Lesser ", version="3"), ("lesser", "3")),
    "AGPL-3.0": Notice(_GPL_NOTICE.format(family="Affero ", version="3"), ("affero", "3")),
    "CC-BY-4.0": Notice("Licensed under CC BY 4.0.", ("cc by 4 0",), "not never no nor without nc nd sa"),
    "CC-BY-SA-4.0": Notice("Licensed under CC BY-SA 4.0.", ("cc by sa 4 0",)),
    "CC-BY-NC-4.0": Notice("Licensed under CC BY-NC 4.0.", ("cc by nc 4 0",)),
    "proprietary": Notice("All rights reserved.", ("all rights reserved",)),
    "Apache-2.0 header": Notice(
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at", ("apache", "2 0"), ""),
    "MIT grant": Notice(
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction", ("restriction",), ""),
    "ISC": Notice(
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("fee",), ""),
    "BSD-2-Clause": Notice(_REDISTRIBUTION, ("binary",), "neither"),
    "BSD-3-Clause": Notice(
        _REDISTRIBUTION + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
        ("endorse", "promote"), ""),
    "GPL-2.0 header": Notice(_GPL_HEADER.format(family="", version="2"), ("gnu", "general", "version 2"), _GPL_WORDS),
    "GPL-3.0 header": Notice(_GPL_HEADER.format(family="", version="3"), ("gnu", "general", "version 3"), _GPL_WORDS),
    "LGPL-2.1 header": Notice(_GPL_HEADER.format(family="Lesser ", version="2.1"), ("lesser", "version 2 1")),
    "LGPL-3.0 header": Notice(_GPL_HEADER.format(family="Lesser ", version="3"), ("lesser", "version 3")),
    "AGPL-3.0 header": Notice(_GPL_HEADER.format(family="Affero ", version="3"), ("affero", "version 3")),
    "MPL-2.0 header": Notice(
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at", ("mozilla", "2 0"), ""),
    "Unlicense": Notice(
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software", ("unencumbered",), "not never"),
    "Boost-1.0": Notice("Distributed under the Boost Software License, Version 1.0.", ("boost", "1 0")),
}


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        at = bisect.bisect_left(tops, v)
        back[i] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[at], piles[at] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1}
        pairs = [(place[w], j) for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and w in place]
        anchors = [pairs[i] for i in increasing([p for p, _ in pairs])]
        if not anchors:
            continue
        out += anchors
        before = (a0 - 1, b0 - 1)
        for i, j in [*anchors, (a1, b1)]:
            todo.append((before[0] + 1, i, before[1] + 1, j))
            before = (i, j)
    return sorted(out)


class Template:
    def __init__(self, name: str, notice: Notice | str, min_coverage: float):
        notice = Notice(notice, excluded="") if isinstance(notice, str) else notice
        self.name, self.words, self.min_coverage = name, words(notice.text), min_coverage
        self.excluded = frozenset(words(notice.excluded))
        self.required = [self._places(words(phrase)) for phrase in notice.required]
        n = len(self.words)
        self.slack = max(2, n // 5)
        missing = n - math.ceil(min_coverage * n - 1e-9)
        by_length = sorted(range(n), key=lambda i: (-len(self.words[i]), i))
        self.votes: dict[bytes, list[int]] = {}
        for i in by_length[: missing + 1]:
            self.votes.setdefault(self.words[i], []).append(i)

    def _places(self, phrase: list[bytes]) -> list[range]:
        """Where a phrase stands in the template."""
        k = len(phrase)
        found = [range(i, i + k) for i in range(len(self.words) - k + 1) if self.words[i : i + k] == phrase]
        if not found:
            raise ValueError(f"{self.name}: a required phrase is not in the template")
        return found

    def fits(self, text: list[bytes], pairs: list[tuple[int, int]]) -> bool:
        """Whether an alignment (place in the text, in the template) is a finding."""
        n = len(self.words)
        if not pairs or len(pairs) < self.min_coverage * n - 1e-9:
            return False
        first, last = pairs[0][0], pairs[-1][0]
        if last + 1 - first > SPREAD * n:
            return False
        at = {j: i for i, j in pairs}
        for places in self.required:
            if not any(all(j in at and at[j] == at[p[0]] + j - p[0] for j in p) for p in places if p[0] in at):
                return False
        aligned = {i for i, _ in pairs}
        between = (text[i] for i in range(max(0, first - BEFORE), last) if i not in aligned)
        return not any(w in self.excluded for w in between)

    def findings(self, text: list[bytes], places: list[int]) -> list[tuple[int, int, int]]:
        """(words aligned, first word, past the last word); ``places``: of voting words."""
        n = len(self.words)
        starts = sorted({p - o for p in places for o in self.votes.get(text[p], ())})
        found = set()
        for s in starts:
            best = 0
            for slack in (0, self.slack, n):
                low, high = max(0, s - slack), min(len(text), s + n + slack)
                pairs = [(low + i, j) for i, j in align(text[low:high], self.words)]
                if self.fits(text, pairs):
                    found.add((len(pairs), pairs[0][0], pairs[-1][0] + 1))
                if slack and len(pairs) <= best or len(pairs) == n:
                    break
                best = len(pairs)
        return apart([(k, a, b, self.name) for k, a, b in found])

    def __len__(self) -> int:
        return len(self.words)


def apart(found: list[tuple]) -> list[tuple]:
    """Findings (words aligned, first word, past the last, name, ...) that do not
    overlap: the most words first, then the shorter place; in order of place."""
    kept: list[tuple] = []
    for f in sorted(found, key=lambda f: (-f[0], f[2] - f[1], *f[1:])):
        if all(f[2] <= x[1] or f[1] >= x[2] for x in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[1:])


class Scanner:
    def __init__(self, templates: dict[str, Notice | str], min_coverage: float):
        self.templates = [t for t in (Template(n, x, min_coverage) for n, x in templates.items()) if t.words]
        self.votes = frozenset().union(*(t.votes for t in self.templates))

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, past the last word), apart and in order."""
        w = words(text)
        places = [i for i, x in enumerate(w) if x in self.votes]
        found = []
        for t in self.templates if places else ():
            own = [i for i in places if w[i] in t.votes]
            found += [(*f, len(t)) for f in t.findings(w, own)]
        return [(name, k / n, a, b) for k, a, b, name, n in apart(found)]


def licenses(
    docs: DataFrame,
    templates: dict[str, Notice | str] | None = None,
    min_coverage: float = MIN_COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per finding: id, template, coverage, start and end (characters)."""
    templates = TEMPLATES if templates is None else templates
    if sum(len((t if isinstance(t, str) else t.text).encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates of over {MAX_TEMPLATE_BYTES} bytes: scan them in parts")
    rows = id_text(docs, id_col, text_col)
    scanner = Scanner(templates, min_coverage)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, names, coverage, starts, ends = [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            found = scanner.scan(text)
            spans = char_spans(text, [(a, b) for _, _, a, b in found]) if found else []
            for (name, c, _, _), span in zip(found, spans):
                at.append(i)
                names.append(name)
                coverage.append(c)
                starts.append(span["start"])
                ends.append(span["end"])
        return pa.record_batch(
            [batch.column("id").take(pa.array(at, pa.int64())), pa.array(names, pa.string()),
             pa.array(coverage, pa.float64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
            names=[id_col, "template", "coverage", "start", "end"],
        )

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, f"{id_col} {kind}, template string, coverage double, start long, end long", fn)
