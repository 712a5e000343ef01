"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

Units of a text are each of its lines, the whole text (a licence file), and windows of consecutive lines, for headers
wrapped over lines and for licences inside longer files: from each line on, as many lines as come nearest to a template's
number of words from below and from above.
Comment marks are no words and so do not count. Templates are notices, titles, and the full texts in the folder licenses.
A unit is a sparse vector over words: count times idf, with the document frequency of every template word
counted over all texts (a table as long as the templates have words); a word outside the templates is a
dimension of its own with the idf of a word never seen. A unit's license is the template of the largest
cosine if that reaches THRESHOLD; a text's is that of its best unit, first line and template of equals. An SPDX tag
names its license (without -only, -or-later, +) with score 1. The line of a window is its first. A sentence that several
licences share (SHARED) decides for none of them: a line that comes nearest to one is no header, but windows and whole texts around it may be.

A text is a licence file if its name says so (LICENSE, LICENCE, COPYING, NOTICE) or if its whole text
reaches the threshold with the full text of a license; a file that is all header is no licence file. A directory has the license of its best licence file. A text without a license of its own inherits
that of the nearest directory on its path, its own first, then upwards to the root: distinct directories
are exploded to their ancestors, joined with the licensed directories, and the longest match stays.

Nulls, ties, repeats: a null or empty text has no license of its own, a null path has no directory and
inherits nothing. Equal scores go to the license first in code-point order. Repeated rows are decided
alike. An empty table gives no rows. Clashing names of carried columns are left out. Very long texts are hashed in
windows; all their lines and windows of lines are scored, so a task must hold a text and its word numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow
from weft.llm.sums import pack, summed, unpack
from weft.llm.textops import LOWER, U64, blocks, hashed_words, prefix_sums, span_hash, spans
from weft.workspace import Workspace

THRESHOLD = 0.75
SPDX = re.compile(rb"(?i:SPDX-License-Identifier):[ \t]*(\(*[A-Za-z0-9.+-]*[A-Za-z0-9+]\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9.+-]*[A-Za-z0-9+]\)*)*)")
NO_WORD = np.ones(256, bool)
NO_WORD[48:58] = NO_WORD[65:91] = NO_WORD[97:123] = NO_WORD[128:] = False
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"

#: Notices of public licenses, as their texts recommend them or as they are commonly shortened.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Sentences of several licenses, which name none of them.
SHARED: tuple[tuple[str, str], ...] = (
    ("", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)


def full_texts() -> tuple[tuple[str, str], ...]:
    """Full licence texts, read by the driver."""
    folder = Path(__file__).parent / "licenses"
    return tuple((f.stem, f.read_text(encoding="utf-8")) for f in sorted(folder.glob("*.txt")))


class Terms:
    """Words of the templates: hash look-up, counts by template."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        vectors = []
        for _, text in templates:
            data = np.frombuffer(text.encode(), np.uint8)
            starts, ends, _ = spans(data, np.array([0, len(data)]), NO_WORD)
            vectors.append(Counter(span_hash(prefix_sums(LOWER[data]), starts, ends).tolist()))
        self.names = [name for name, _ in templates]
        self.sizes = [sum(v.values()) for v in vectors]
        self.hashes = np.array(sorted(set().union(*vectors)), U64)
        self.counts = np.array([[v.get(int(h), 0) for v in vectors] for h in self.hashes], float)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hashes >> U64(48)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for other words."""
        out = np.full(len(h), -1, np.int64)
        maybe = np.flatnonzero(self.seen[(h >> U64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        hit = self.hashes[at] == h[maybe]
        out[maybe[hit]] = at[hit]
        return out


def _terms_of(data: np.ndarray, at: np.ndarray, terms: Terms):
    hashes, starts, _, first = hashed_words(LOWER[data], at, NO_WORD)
    return starts, first, terms.find(hashes)


def idf(docs: DataFrame, terms: Terms, text_col: str) -> tuple[np.ndarray, float]:
    """idf of the template words over all texts, and of a word never seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 + len(terms.hashes), np.int64)  # texts, then texts with each term
        for batch in batches:
            for lo, hi, data, at in blocks(batch.column(0)):
                _, first, term = _terms_of(data, at, terms)
                text = np.repeat(np.arange(hi - lo), np.diff(first))
                hit = term >= 0
                pairs = np.unique(text[hit] * len(terms.hashes) + term[hit])
                found[1:] += np.bincount(pairs % len(terms.hashes), minlength=len(terms.hashes))
                found[0] += hi - lo
        yield pa.record_batch([pa.array([0]), pa.array([pack(found)], pa.binary())], names=["key", "values"])

    parts = docs.select(text_col).transform(map_arrow, count, "key long, values binary")
    found = summed(parts, np.int64).collect()
    found = unpack(found[0]["values"], np.int64) if found else np.zeros(1 + len(terms.hashes), np.int64)
    n, df = int(found[0]), found[1:]
    return np.log((n + 1) / (df + 1)) + 1, float(np.log(n + 1) + 1)


def unit_scores(data, at, units: np.ndarray, terms: Terms, weight: np.ndarray, unseen: float, matrix: np.ndarray):
    """Best cosine and template of each unit; units are the starts of ascending spans that cover data."""
    starts, _, term = _terms_of(data, at, terms)
    unit = np.searchsorted(units, starts, "right") - 1
    hit = term >= 0
    norm = np.bincount(unit[~hit], minlength=len(units)) * unseen * unseen
    pair, count = np.unique(unit[hit] * len(weight) + term[hit], return_counts=True)
    own, which = pair // len(weight), pair % len(weight)
    w = count * weight[which]
    norm += np.bincount(own, weights=w * w, minlength=len(units))
    best, template = np.zeros(len(units)), np.zeros(len(units), np.int64)
    if len(pair):
        head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        dots = np.add.reduceat(w[:, None] * matrix[which], head, axis=0)
        best[own[head]] = dots.max(axis=1) / np.sqrt(norm[own[head]])
        template[own[head]] = dots.argmax(axis=1)
    return best, template


def window_scores(data, at, terms: Terms, weight: np.ndarray, unseen: float, matrix: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
    """By text: best cosine, template and first byte of a window of two or more lines, where that reaches the threshold; no window has a shared template.

    A window's dot product is a difference of sums over words; its norm is at least that with every word counted once
    for each occurrence, so the cosine is computed only where this bound reaches the threshold.
    """
    starts, first, term = _terms_of(data, at, terms)
    if not len(starts):
        return {}
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])[starts]
    text = np.searchsorted(first, np.arange(len(starts)), "right") - 1
    begin = np.flatnonzero(np.concatenate([[True], (np.diff(breaks) != 0) | (np.diff(text) != 0)]))
    edge = np.append(begin, len(starts))
    of = text[begin]
    last = np.searchsorted(edge, first[of + 1])
    hit = term >= 0
    each = np.where(hit, weight[term], unseen)
    norms = np.concatenate([[0.0], np.cumsum(each * each)])
    found: dict[int, tuple[float, int, int]] = {}
    for t in range(len(terms.sizes)):
        if not terms.names[t]:
            continue
        dots = np.concatenate([[0.0], np.cumsum(np.where(hit, weight[term] * matrix[term, t], 0.0))])
        above = np.searchsorted(edge, begin + terms.sizes[t])
        for end in (np.minimum(above - 1, last), np.minimum(above, last)):
            stop = edge[end]
            bound = (dots[stop] - dots[begin]) / np.sqrt(np.maximum(norms[stop] - norms[begin], 1e-300))
            for i in np.flatnonzero((end >= np.arange(len(begin)) + 2) & (bound >= threshold - 1e-9)):
                inside = term[begin[i] : stop[i]]
                own = inside[inside >= 0]
                which, count = np.unique(own, return_counts=True)
                w = count * weight[which]
                score = float(w @ matrix[which, t] / np.sqrt(w @ w + (len(inside) - len(own)) * unseen * unseen))
                if score >= threshold and score > found.get(int(of[i]), (0.0,))[0]:
                    found[int(of[i])] = score, t, int(starts[begin[i]])
    return found


def spdx_tags(data: np.ndarray, at: np.ndarray) -> dict[int, tuple[str, int]]:
    """By text: the first SPDX tag's license and its place."""
    found: dict[int, tuple[str, int]] = {}
    for tag in SPDX.finditer(data.tobytes()):
        i = int(np.searchsorted(at, tag.start(), "right")) - 1
        if tag.end() <= at[i + 1]:
            found.setdefault(i, (re.sub(r"(-only|-or-later|\+)$", "", tag[1].decode()), tag.start()))
    return found


def own_licenses(docs: DataFrame, *, text_col: str, carry: tuple[str, ...], templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """Carried columns with own_license, score, line (null: the whole text) and whole (the whole text matches a license's full text).

    Units nearest to a template without a name are none's.
    """
    templates = tuple(sorted(TEMPLATES + SHARED + full_texts() if templates is None else templates))
    full_text = {text for _, text in full_texts()}
    is_full = np.array([text in full_text for _, text in templates])
    terms = Terms(templates)
    named = np.array([bool(name) for name in terms.names])
    weight, unseen = idf(docs, terms, text_col)
    matrix = terms.counts * weight[:, None]
    matrix /= np.sqrt((matrix**2).sum(axis=0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, lines, wholes = [], [], [], []
            for lo, hi, data, at in blocks(batch.column(0), 1 << 19):
                lead = np.unique(np.concatenate([at[:-1][np.diff(at) > 0], np.flatnonzero(data == 0x0A) + 1]))
                lead = lead[lead < len(data)]
                best, template = unit_scores(data, at, lead, terms, weight, unseen, matrix)
                best[~named[template]] = 0.0
                full = at[:-1][np.diff(at) > 0]
                of_whole, whole_template = unit_scores(data, at, full, terms, weight, unseen, matrix)
                of_whole[~named[whole_template]] = 0.0
                place = {int(s): i for i, s in enumerate(full)}
                windows = window_scores(data, at, terms, weight, unseen, matrix, threshold)
                tags = spdx_tags(data, at)
                for i in range(hi - lo):
                    a, b = np.searchsorted(lead, [at[i], at[i + 1]])
                    if at[i + 1] == at[i]:
                        names.append(None), scores.append(0.0), lines.append(None), wholes.append(False)
                        continue
                    k = a + int(best[a:b].argmax())
                    p = place[int(at[i])]
                    whole = bool(of_whole[p] >= threshold and is_full[whole_template[p]])
                    if of_whole[p] > best[k]:
                        score, name, line = of_whole[p], terms.names[whole_template[p]], None
                    else:
                        score, name, line = best[k], terms.names[template[k]], k - a
                    if i in windows and windows[i][0] > score + 1e-9:
                        score, name = windows[i][0], terms.names[windows[i][1]]
                        line = int(np.searchsorted(lead, windows[i][2], "right")) - 1 - a
                    if i in tags and score < 1 - 1e-9:
                        score, name = 1.0, tags[i][0]
                        line = int(np.searchsorted(lead, tags[i][1], "right")) - 1 - a
                    names.append(name if score >= threshold else None)
                    scores.append(float(score))
                    lines.append(line if score >= threshold else None)
                    wholes.append(whole)
            yield pa.record_batch(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lines, pa.int32()), pa.array(wholes, pa.bool_())],
                names=[*carry, "own_license", "score", "line", "whole"],
            )

    slim = docs.select(F.col(text_col).alias("__text"), *carry)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[1:])
    return slim.transform(map_arrow, run, f"{kinds}, own_license string, score double, line int, whole boolean")


def scan(docs: DataFrame, workspace: Workspace, *, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path") -> DataFrame:
    """id, path, license, how (header, file, inherited, none), from_directory, score and line of each row."""
    files = docs.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    found = own_licenses(files, text_col="text", carry=("id", "path"))
    parts = F.split("path", "/")
    directory = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")
    is_file = F.col("own_license").isNotNull() & (F.col("whole") | F.coalesce(F.col("path").rlike(LICENCE_NAME), F.lit(False)))
    found = workspace.save(found.withColumns({"directory": directory, "is_file": is_file}), "own")
    licensed = workspace.save(
        found.where("is_file AND directory IS NOT NULL")
        .groupBy("directory")
        .agg(F.min(F.struct(-F.col("score"), "own_license")).getField("own_license").alias("license"))
        .select(F.col("directory").alias("__from"), "license"),
        "licensed",
    )
    wanting = found.where("own_license IS NULL AND directory IS NOT NULL").select("directory").distinct()
    steps = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))
    climbed = wanting.select("directory", F.explode(F.array_distinct(above)).alias("ancestor"))
    nearest = (
        climbed.join(licensed, F.col("ancestor") == F.col("__from"))
        .groupBy("directory")
        .agg(F.max_by(F.struct("license", "__from"), F.length("__from")).alias("n"))
        .select(F.col("directory").alias("__directory"), F.col("n.license").alias("inherited"), F.col("n.__from").alias("from_directory"))
    )
    nearest = workspace.save(nearest, "nearest")
    joined = found.join(nearest, F.col("own_license").isNull() & (F.col("directory") == F.col("__directory")), "left")
    how = (
        F.when(F.col("is_file"), "file").when(F.col("own_license").isNotNull(), "header")
        .when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    )
    return joined.select(
        F.col("id").alias(id_col), "path", F.coalesce("own_license", "inherited").alias("license"), how.alias("how"),
        "from_directory", "score", "line",
    )
