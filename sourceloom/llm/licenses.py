"""License scans: patience alignment of texts with license templates."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sourceloom.llm.common import ship

# Notices by which texts state their license, as their publishers word them.
TEMPLATES = {
    "MIT notice": "Released under the MIT license.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "All rights reserved": "All rights reserved.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                 "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                 "conditions are met",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                 "provided that the above copyright notice and this permission notice appear in all copies.",
}
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal words, rising on both sides: words unique to both are anchors, the longest increasing run of
    them is kept, and the gaps between are aligned the same way; equal ends of a gap match directly."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        here, there = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(b[b0:b1], b0) if there[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if here[w] == 1 and w in place]
        if not pairs:
            continue
        tops: list[int] = []
        last: list[int] = []
        back: list[int] = []
        for n, (_, j) in enumerate(pairs):  # patience piles
            pile = bisect_left(tops, j)
            back.append(last[pile - 1] if pile else -1)
            tops[pile:pile + 1], last[pile:pile + 1] = [j], [n]
        n, chain = last[-1], []
        while n >= 0:
            chain.append(pairs[n])
            n = back[n]
        edge = (a0 - 1, b0 - 1)
        for i, j in [*reversed(chain), (a1, b1)]:
            todo.append((edge[0] + 1, i, edge[1] + 1, j))
            edge = (i, j)
        found += chain
    return sorted(found)


def scan(words: list[str], counts: Counter, template: list[str], need: Counter, threshold: float) -> tuple[int, int, int, int] | None:
    """Best place of a template in a text: words matched, first and last word, and number of places that reach the threshold.

    A place lacks at most ``size - least`` template words, so it matches one of any ``size - least + 1`` different ones: the
    windows around the rarest of these hold every place, also of edited notices.
    """
    size = len(template)
    least = max(math.ceil(threshold * size), 1)
    if sum(min(n, counts[w]) for w, n in need.items()) < least:
        return None  # no alignment can match more words than both sides have
    rarest = sorted(need, key=lambda w: (counts[w] * need[w], template.index(w)))[:size - least + 1]
    at = {w: [j for j, t in enumerate(template) if t == w] for w in rarest}
    windows = set()
    for p, w in enumerate(words):
        for j in at.get(w, ()):
            # The narrow window keeps neighbouring notices apart; the wide one holds any place of up to 2 * size words.
            for slack in (size // 2 + 2, 2 * size - least):
                windows.add((max(p - j - slack, 0), min(p + size - j + slack, len(words))))
    hits = set()
    for low, high in windows:
        part = words[low:high]
        here = Counter(w for w in part if w in need)
        if sum(min(n, here[w]) for w, n in need.items()) < least:
            continue
        pairs = align(part, template)
        if len(pairs) >= least and pairs[-1][0] - pairs[0][0] < 2 * size:
            hits.add((low + pairs[-1][0], low + pairs[0][0], len(pairs)))
    if not hits:
        return None
    places, end = 0, -1
    for last, first, _ in sorted(hits):
        if first > end:
            places, end = places + 1, last
    last, first, matched = min(hits, key=lambda x: (-x[2], x[0], -x[1]))
    return matched, first, last, places


def _scanned(batches: Iterator[pa.RecordBatch], templates: dict[str, str], threshold: float) -> Iterator[pa.RecordBatch]:
    ready = [(name, ws, Counter(ws)) for name, text in templates.items() if (ws := words_of(text))]
    marks = {w for _, ws, _ in ready for w in ws}
    for batch in batches:
        out: list[tuple] = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist()):
            words = words_of(text)
            counts = Counter(w for w in words if w in marks)
            for name, ws, need in ready:
                if counts and (hit := scan(words, counts, ws, need, threshold)):
                    out.append((doc, name, len(ws), hit[0], hit[0] / len(ws), hit[1], hit[2], hit[3]))
        columns = list(zip(*out)) or [()] * 8
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                         names=["doc_id", "license", "n_template", "n_matched", "coverage", "first_word", "last_word", "n_places"])


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.85, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """One row per document and license whose template is covered to ``threshold`` or more in one place of the text.

    Words are lower-cased letters and digits.  A bound on the words in common leaves out pairs that no alignment can save; the rest
    is aligned around the occurrences of the template's rarest words in the text, of so many that each place holds one of them.

    Null, empty and wordless texts give no row, nor do wordless templates.  Of equally good places the first is given.  Repeated rows
    are scanned each; null ids are kept; other columns are not read.  Memory is one text's words.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return source.mapInArrow(partial(_scanned, templates=dict(templates), threshold=threshold),
                             "doc_id bigint, license string, n_template bigint, n_matched bigint, coverage double, first_word bigint, last_word bigint, n_places bigint")
