"""Licence scan: normalised passages compared to templates by the Dice coefficient over word bigrams.

Passages are runs of whole lines, and then, in the words that these leave over, runs of
words at any place. A coefficient of ``t`` is out of reach unless the number of bigrams
lies between t / (2 - t) and (2 - t) / t times the template's, so only passages and
templates of fitting size are compared. Every text is judged where it is read; nothing
is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

# Short public licence notices, by SPDX identifier.
NOTICES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-3-Clause-short": "Licensed under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1": "GNU Lesser General Public License version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License version 3",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "MIT-terms": "Licensed under the terms of the MIT license.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Identifiers that files name in a tag.
TAGGED = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-NC-4.0",
    "CC-BY-SA-4.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
TEMPLATES = {**NOTICES, **{f"{name}-tag": f"SPDX-License-Identifier: {name}" for name in TAGGED}}


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def bigrams(run: list[str]) -> Counter:
    return Counter(zip(run, run[1:]))


def dice(a: Counter, b: Counter) -> float:
    size = a.total() + b.total()
    return 2 * (a & b).total() / size if size else 0.0


class Scanner:
    """Templates by number of bigrams; ``least`` is the coefficient that counts as a match."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> None:
        made = sorted((bigrams(words(t)).total(), name, bigrams(words(t))) for name, t in templates.items())
        self.templates = [m for m in made if m[0]]
        self.sizes = [m[0] for m in self.templates]
        self.least, self.ratio = least, least / (2 - least)
        self.having: dict[tuple[str, str], list[int]] = defaultdict(list)
        for t, (_, _, own) in enumerate(self.templates):
            for pair in own:
                self.having[pair].append(t)
        self.vocabulary = {w for _, _, b in self.templates for pair in b for w in pair}

    def fitting(self, size: int) -> list[tuple[int, str, Counter]]:
        """Templates that a passage of ``size`` bigrams can match."""
        low = bisect_left(self.sizes, size * self.ratio - 1e-9)
        return self.templates[low : bisect_right(self.sizes, size / self.ratio + 1e-9)]

    def best(self, run: list[str]) -> tuple[float, str] | None:
        """The best matching template of a passage; of equal ones the first by name."""
        size = len(run) - 1
        if size < 1 or not (candidates := self.fitting(size)):
            return None
        own = bigrams(run)
        score, name = min((-dice(own, other), name) for _, name, other in candidates)
        return (-score, name) if -score >= self.least else None

    def window(self, pairs: list[tuple[str, str]], hits: list[int], at: int, t: int, end: int) -> tuple[float, int] | None:
        """(coefficient, last bigram) of the best match of a template that begins at its bigram ``hits[at]``
        and ends before bigram ``end``; of equal ones the longest.

        A best match begins and ends with a bigram of the template: any other only lowers it.
        """
        size, _, own = self.templates[t]
        first, need = hits[at], max(1, int(size * self.ratio + 1 - 1e-9))
        end = min(end, first + int(size / self.ratio + 1e-9))
        if at + need > len(hits) or hits[at + need - 1] >= end:
            return None
        left, common, best = dict(own), 0, None
        for k in range(at, len(hits)):
            p = hits[k]
            if p >= end:
                break
            if left[pairs[p]]:
                left[pairs[p]] -= 1
                common += 1
                score = 2 * common / (size + p - first + 1)
                if score >= self.least and (best is None or score >= best[0]):
                    best = (score, p)
        return best

    def windows(self, flat: list[str], covered: bytearray) -> list[tuple[int, int, str, float]]:
        """(first word, last word, template, coefficient) of the matches in words not ``covered``, which are marked then.

        The best goes first, then the longer (a short notice may be part of a long one), the
        earlier, the first by name; one that meets a chosen match is sought again in
        what is left.
        """
        pairs = list(zip(flat, flat[1:]))
        hits: dict[int, list[int]] = defaultdict(list)
        having = self.having
        # No match of a template is longer, so what is covered further on does not matter.
        reach = [int(size / self.ratio + 1e-9) + 3 for size in self.sizes]
        for p, pair in enumerate(pairs):
            if pair in having and not covered[p] and not covered[p + 1]:
                for t in having[pair]:
                    hits[t].append(p)

        def found(t: int, at: int) -> list:
            first = hits[t][at]
            stop = covered.find(1, first, first + reach[t])
            best = self.window(pairs, hits[t], at, t, stop - 1 if stop >= 0 else len(pairs))
            return [] if best is None else [(-best[0], first - best[1], first, self.templates[t][1], t, at)]

        heap = [f for t, own in hits.items() for at in range(len(own)) for f in found(t, at)]
        heapify(heap)
        chosen = []
        while heap:
            score, less, first, name, t, at = heappop(heap)
            length = -less
            if covered.find(1, first, first + length + 2) < 0:
                covered[first : first + length + 2] = b"\1" * (length + 2)
                chosen.append((first, first + length + 1, name, -score))
            elif not covered[first]:
                for f in found(t, at):
                    heappush(heap, f)
        return chosen

    def scan(self, text: str) -> list[tuple[int, int, str, float]]:
        """(first line, last line, template, coefficient) of the matches, lines from 0.

        Of passages that overlap the best stays, then the shorter, then the earlier. A match
        of whole lines takes up the words of these lines that match its template best.
        """
        if not self.sizes:
            return []
        lines = [words(line) for line in text.split("\n")]
        most = int(self.sizes[-1] / self.ratio + 1e-9) + 1
        found = []
        for i, line in enumerate(lines):
            if not line or len(line) > most:
                continue
            # A match may miss 1 - least of its words, so its first line shares a word with a template
            # unless the line alone is that small a part; such lines only lower the coefficient.
            if self.vocabulary.isdisjoint(line):
                continue
            run: list[str] = []
            for j in range(i, len(lines)):
                run = run + lines[j]
                if len(run) > most:
                    break
                if lines[j] and (hit := self.best(run)):
                    found.append((i, j, hit[1], hit[0]))
        chosen: list[tuple[int, int, str, float]] = []
        taken = bytearray(len(lines))
        for i, j, name, score in sorted(found, key=lambda f: (-f[3], f[1] - f[0], f[0])):
            if taken.find(1, i, j + 1) < 0:
                taken[i : j + 1] = b"\1" * (j + 1 - i)
                chosen.append((i, j, name, score))
        flat = [w for line in lines for w in line]
        of_word = [i for i, line in enumerate(lines) for _ in line]
        covered = bytearray(len(flat))
        for i, j, name, _ in chosen:
            start, end = bisect_left(of_word, i), bisect_right(of_word, j)
            first, last = self.closest(flat[start:end], name)
            covered[start + first : start + last + 1] = b"\1" * (last - first + 1)
        chosen += [(of_word[a], of_word[b], name, score) for a, b, name, score in self.windows(flat, covered)]
        return sorted(chosen)

    def closest(self, run: list[str], name: str) -> tuple[int, int]:
        """First and last word of the part of a matching passage that matches best."""
        t = next(t for t, m in enumerate(self.templates) if m[1] == name)
        pairs = list(zip(run, run[1:]))
        hits = [p for p, pair in enumerate(pairs) if pair in self.templates[t][2]]
        best = [(-w[0], hits[k] - w[1], hits[k]) for k in range(len(hits)) if (w := self.window(pairs, hits, k, t, len(pairs)))]
        _, less, first = min(best)
        return first, first - less + 1


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST, doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """For each row its id, ``n_matches``, ``licenses`` (distinct names, sorted), ``best`` and ``best_dice``,
    and ``matches`` (first and last line, name, coefficient).

    NULL and empty texts match nothing; repeated rows each give a row; other columns
    are not read; an empty table gives no row. Ties of ``best`` go to the first name.
    """
    kind = docs.schema[doc].dataType.simpleString()
    match = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("name", pa.string()), ("dice", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        keys = ("first", "last", "name", "dice")
        for batch in batches:
            rows = [[dict(zip(keys, m, strict=True)) for m in scanner.scan(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(match))], names=["doc", "matches"])

    found = docs.select(F.col(doc).alias("doc"), F.col(text)).mapInArrow(
        run, f"doc {kind}, matches array<struct<first:bigint,last:bigint,name:string,dice:double>>"
    )
    ordered = F.array_sort(F.transform("matches", lambda m: F.struct((-m["dice"]).alias("d"), m["name"].alias("name"))))
    top = F.try_element_at(ordered, F.lit(1))
    return found.select(
        F.col("doc").alias(doc), F.size("matches").cast("long").alias("n_matches"),
        F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["name"]))).alias("licenses"),
        top["name"].alias("best"), (-top["d"]).alias("best_dice"), "matches",
    )
