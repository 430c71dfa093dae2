"""Licence scans by the Dice coefficient over word bigrams.

A document's lines, and windows of up to 4 consecutive lines, are compared with licence templates
after the same normalisation: lower case, everything but ASCII letters, digits and dots between
digits taken as space. The score of two texts is 2|A & B| / (|A| + |B|) over their sets of word
bigrams (of a single word: that word). A template is only scored against texts whose number of
bigrams can reach the threshold: with sizes a and b the score is at most 2 min(a, b) / (a + b).

A document's result is its best match (ties: the template's name, then the earlier, shorter
window). Null, empty and wordless texts match nothing; every line of a whole text is scanned, of
any length; repeated rows give repeated results; other columns are kept.

That is scanned(). stated() gives every statement, wherever it stands: windows of words, inside
lines and across line breaks, against these templates, further notices and whole licence texts. A
window has at most (2 - threshold) / threshold times a template's running bigrams, which is its
size bound, and begins with a bigram of it (leaving others off never lowers a score). For each template, the best window is taken (ties: earlier, shorter), then the best of
those that share no word with a taken one, until none is left. Windows of different templates may
overlap: wordings of one family score alike, and the highest score is the nearest wording.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator, Mapping
from itertools import repeat
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from libretto.llm.common import batches, lean

THRESHOLD, LINES = 0.8, 4

#: Licence names and the wording that states them; fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "all-rights-reserved": "All rights reserved.",
}

#: Further notices that only stated() looks for.
NOTICES = {
    "AGPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "BSD": "Released under the BSD License.",
    "CC-BY": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "ISC": "Released under the ISC License.",
    "LGPL notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def wordings() -> dict[str, str]:
    """Every template of stated(): TEMPLATES, NOTICES and the whole texts in licence_texts."""
    texts = {f"{p.stem} text": p.read_text("utf-8") for p in sorted(Path(__file__).with_name("licence_texts").glob("*.txt"))}
    return {**TEMPLATES, **NOTICES, **texts}


WORDS, BREAK = re.compile(rb"[a-z0-9]+(?:\.[0-9]+)*"), re.compile(rb"\r\n|\r|\n")


def words(text: bytes) -> list[bytes]:
    return WORDS.findall(text.lower())


def bigrams(found: list[bytes]) -> set:
    return set(zip(found, found[1:], strict=False)) if len(found) > 1 else {(w,) for w in found}


def scanned(df: DataFrame, text: str = "text", templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD, most_lines: int = LINES) -> DataFrame:
    """df with licence, score, first_line (from 0) and n_lines of its best match, else nulls."""
    added = {"licence": StringType(), "score": DoubleType(), "first_line": IntegerType(), "n_lines": IntegerType()}
    lean(df.sparkSession)
    keep = [c for c in df.columns if c not in added]
    schema = df.select(keep).schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    known = sorted((name, bigrams(words(t.encode()))) for name, t in templates.items())
    known = [(name, grams) for name, grams in known if grams]

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(known, threshold, most_lines)
        for batch in batches(frame, text):
            found = [scan.best(x) if x else (None,) * 4 for x in batch.column(text).cast(pa.binary()).to_pylist()]
            cols = [pa.array(x, type=t) for x, t in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.int32(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *cols], names=[*keep, *added])

    return df.mapInArrow(run, schema)


class Scan:
    """known: (name, bigrams) by name. A match needs |A & B| >= threshold |B| / (2 - threshold), as |A| >= |A & B|."""

    def __init__(self, known: list[tuple[str, set]], threshold: float, most_lines: int):
        self.known, self.threshold, self.most_lines = known, threshold, most_lines
        self.needs = [threshold * len(g) / (2 - threshold) - 1e-9 for _, g in known]
        self.every = frozenset().union(*(g for _, g in known))

    def best(self, text: bytes) -> tuple:
        lines = [words(x) for x in BREAK.split(text)]
        every, top = self.every, None
        hits = [{p for p in zip(x, x[1:], strict=False) if p in every} for x in lines]
        for i in range(len(lines)):
            joined: list[bytes] = []
            shared: set = set()
            for n in range(1, min(self.most_lines, len(lines) - i) + 1):
                more = lines[i + n - 1]
                if joined and more and (joined[-1], more[0]) in every:
                    shared = shared | {(joined[-1], more[0])}
                shared = shared | hits[i + n - 1] if hits[i + n - 1] else shared
                joined = joined + more if n > 1 else more
                for score, name in self.scores(joined, shared if len(joined) != 1 else every & {(joined[0],)}):
                    if top is None or (-score, name, i, n) < top:
                        top = (-score, name, i, n)
        return (None,) * 4 if top is None else (top[1], -top[0], top[2], top[3])

    def scores(self, found: list[bytes], shared: set) -> Iterator[tuple[float, str]]:
        """shared: those of the bigrams of found that any template has."""
        if not shared:
            return
        a = None
        for (name, own), need in zip(self.known, self.needs, strict=True):
            if len(shared) < need or (both := len(shared & own)) < need:
                continue
            a = len(bigrams(found)) if a is None else a
            b = len(own)
            if 2 * min(a, b) < self.threshold * (a + b):  # the size bound
                continue
            score = 2 * both / (a + b)
            if score > 0 and score >= self.threshold:
                yield score, name


def stated(df: DataFrame, text: str = "text", templates: Mapping[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """df with statements: array of (licence, score, first_word, n_words, first_line, n_lines), by place."""
    lean(df.sparkSession)
    fields = (("licence", StringType()), ("score", DoubleType()), *((n, IntegerType()) for n in ("first_word", "n_words", "first_line", "n_lines")))
    keep = [c for c in df.columns if c != "statements"]
    schema = df.select(keep).schema.add("statements", ArrayType(StructType([StructField(n, t) for n, t in fields])))
    texts = dict(wordings() if templates is None else templates)

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Statements(texts, threshold)
        kind = pa.list_(pa.struct([("licence", pa.string()), ("score", pa.float64()), *((n, pa.int32()) for n, _ in fields[2:])]))
        names = [n for n, _ in fields]
        for batch in batches(frame, text):
            found = [[dict(zip(names, s, strict=True)) for s in scan.all(x)] if x else [] for x in batch.column(text).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, kind)], names=[*keep, "statements"])

    return df.mapInArrow(run, schema)


class Statements:
    """Windows of words that match templates; a template's bigrams anchor its windows."""

    def __init__(self, texts: Mapping[str, str], threshold: float):
        import numpy as np

        self.threshold, self.ids, self.single, self.known = threshold, {}, {}, []
        for name, text in sorted(texts.items()):
            ws = words(text.encode())
            if len(ws) == 1:
                self.single.setdefault(ws[0], []).append(name)
            elif ws:
                grams = {self.ids.setdefault(g, len(self.ids)) for g in zip(ws, ws[1:], strict=False)}
                self.known.append((name, grams, int((len(ws) - 1) * (2 - threshold) / threshold + 1e-9)))
        self.member = np.zeros((len(self.known), len(self.ids) + 1), dtype=bool)  # the last column is for unknown bigrams
        for t, (_, grams, _) in enumerate(self.known):
            self.member[t, list(grams)] = True
        self.needs = np.array([threshold * len(g) / (2 - threshold) - 1e-9 for _, g, _ in self.known])

    def all(self, text: bytes) -> list[tuple]:
        """(licence, score, first word, words, first line, lines) by place."""
        import numpy as np

        ws = words(text)
        out = [(n, 1.0, i, 1) for i, w in enumerate(ws) for n in self.single.get(w, ())] if self.single and not self.single.keys().isdisjoint(ws) else []
        if len(ws) > 1 and self.known:
            none = len(self.ids)
            ids = np.fromiter(map(self.ids.get, zip(ws, ws[1:], strict=False), repeat(none)), dtype=np.int64, count=len(ws) - 1)
            met = np.unique(ids)
            counts = self.member[:, met[met < none]].sum(1)
            before = None
            for t in np.flatnonzero((counts > 0) & (counts >= self.needs)):
                anchors = np.flatnonzero(self.member[t][ids])
                name, grams, most = self.known[t]
                near = np.searchsorted(anchors, anchors + most) - np.arange(len(anchors))
                starts = anchors[near >= self.needs[t]]
                if not len(starts):
                    continue
                before = earlier(ws) if before is None else before
                out += [(name, score, i, n) for score, i, n in self.windows(starts, self.member[t][ids], before, len(grams), most)]
        if not out:
            return []
        ends = np.cumsum([len(words(x)) for x in BREAK.split(text)])
        out = [(*x, int(a := np.searchsorted(ends, x[2], side="right")), int(np.searchsorted(ends, x[2] + x[3] - 1, side="right") - a + 1)) for x in out]
        return sorted(out, key=lambda x: (x[2], x[3], x[0]))

    def windows(self, starts, shared, before, size: int, most: int) -> list[tuple[float, int, int]]:
        """(score, first word, words) of windows that share no word, the best first."""
        import numpy as np

        def best(i: int, end: int) -> tuple | None:
            """(-score, i, words, end): the best window of bigrams from i that ends before bigram `end`."""
            end = min(end, i + most, len(shared))
            if end <= i:
                return None
            new = before[i:end] < i
            scores = 2 * np.cumsum(new & shared[i:end]) / (np.cumsum(new) + size)
            n = int(scores.argmax())
            return (-float(scores[n]), i, n + 2, end) if scores[n] >= self.threshold else None

        heap = [x for i in starts.tolist() if (x := best(i, len(shared)))]
        heapq.heapify(heap)
        taken: list[tuple[int, int]] = []  # first word, end
        out = []
        while heap:
            score, i, n, end = heapq.heappop(heap)
            at = bisect.bisect_right(taken, (i, len(shared) + 2))
            if at and taken[at - 1][1] > i:
                continue
            if at < len(taken) and i + n > taken[at][0]:
                if x := best(i, taken[at][0] - 1):
                    heapq.heappush(heap, x)
                continue
            taken.insert(at, (i, i + n))
            out.append((-score, i, n))
        return out


def earlier(ws: list[bytes]):
    """For each bigram of ws the place of the one before that equals it, else -1."""
    import numpy as np

    last: dict = {}
    out = np.empty(len(ws) - 1, dtype=np.int64)
    for i, g in enumerate(zip(ws, ws[1:], strict=False)):
        out[i] = last.get(g, -1)
        last[g] = i
    return out
