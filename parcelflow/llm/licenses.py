"""Licences of documents: headers and licence files by TF-IDF, then inheritance by folder.

Passages of a text are compared with notice templates, and with passages of whole licences,
by the cosine of sparse TF-IDF vectors: each line, each block of neighbouring lines in licence
language, and runs of words of the sizes of templates wherever they begin.  Document
frequencies of the templates' terms are counted over all documents; any other term weighs as
much as one seen once.  The licence with the most words in its passages names a document.  A document whose words are mostly licence passages is a licence file and speaks for
its folder; documents without a notice of their own take that of the nearest folder above.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import slices
from parcelflow.llm.licence_bodies import BODIES
from parcelflow.session import work_dir

#: Cosine from which a passage counts as a notice.
SIMILAR = 0.7
#: Share of a document's words in notices from which it is a licence file.
FILE_SHARE = 0.5
#: Words of a passage of a whole licence, and between the starts of two; texts are read alike.
PASSAGE, PASSAGE_STEP = 60, 20
#: Sizes of the runs of words held against the short notices.
RUNS = (8, 16, 32, 64)
TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")

#: Short forms of public licence notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Proprietary": ("All rights reserved.", "Copyright. All rights reserved."),
}


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


def passages(count: int) -> list[int]:
    """Where the passages of a text of ``count`` words begin; the last one ends with it."""
    last = max(count - PASSAGE, 0)
    return sorted({*range(0, last, PASSAGE_STEP), last})


NOTICES = [(name, terms(text)) for name, forms in TEMPLATES.items() for text in forms]
PASSAGES = [(name, words[at : at + PASSAGE]) for name, text in BODIES.items() for words in [terms(text)] for at in passages(len(words))]
VOCABULARY = frozenset(w for _, ws in NOTICES + PASSAGES for w in ws)


@dataclass
class Templates:
    """TF-IDF vectors of templates, of length one, by term."""

    idf: dict[str, float]
    other: float
    names: list[str]
    which: np.ndarray
    by_term: dict[str, tuple[np.ndarray, np.ndarray]]
    least_terms: int
    needed: frozenset[str]

    def near(self, words: list[str], similar: float) -> dict[str, float]:
        """The licences with a template near enough to a passage, and how near."""
        counts = Counter(words)
        if sum(w in self.by_term for w in counts) < self.least_terms:
            return {}
        square = known = 0.0
        for word, n in counts.items():
            weight = n * self.idf.get(word, self.other)
            square += weight * weight
            known += weight * weight if word in self.by_term else 0.0
        if known < similar * similar * square * (1 - 1e-9):  # a cosine is at most the norm of the part in known terms
            return {}
        dot = np.zeros(len(self.which))
        for word, n in counts.items():
            if word in self.by_term:
                at, share = self.by_term[word]
                dot[at] += n * self.idf[word] * share
        score = np.minimum(dot / math.sqrt(square), 1.0)
        best: dict[str, float] = {}
        for k in np.flatnonzero(score >= similar).tolist():
            name = self.names[self.which[k]]
            best[name] = max(best.get(name, 0.0), float(score[k]))
        return best


def _fit(texts: list[tuple[str, list[str]]], frequencies: dict[str, int], documents: int, similar: float) -> Templates:
    idf = {w: math.log((documents + 1) / (frequencies.get(w, 0) + 1)) + 1 for _, ws in texts for w in ws}
    names = sorted({name for name, _ in texts})
    by_term: dict[str, tuple[list[int], list[float]]] = {}
    least, needed = 10**9, set()
    for k, (_, ws) in enumerate(texts):
        vector = {w: n * idf[w] for w, n in Counter(ws).items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        shares = sorted(((v / norm, w) for w, v in vector.items()), reverse=True)
        total, need = 0.0, 0
        for share, _ in shares:  # a cosine is at most the norm of the template's part that is matched
            total, need = total + share * share, need + 1
            if math.sqrt(total) >= similar - 1e-9:
                break
        least = min(least, need)
        left = 1.0
        for share, w in shares:  # without all of these no passage is near enough
            if math.sqrt(max(left, 0.0)) < similar - 1e-9:
                break
            left -= share * share
            needed.add(w)
        for w, v in vector.items():
            at, share = by_term.setdefault(w, ([], []))
            at.append(k)
            share.append(v / norm)
    arrays = {w: (np.array(at), np.array(share)) for w, (at, share) in by_term.items()}
    return Templates(idf, math.log(documents + 1) + 1, names, np.array([names.index(n) for n, _ in texts]), arrays, least, frozenset(needed))


def fit_templates(frequencies: dict[str, int], documents: int, similar: float = SIMILAR) -> tuple[Templates, Templates]:
    """Templates of the short notices and of the passages of whole licences."""
    return _fit(NOTICES, frequencies, documents, similar), _fit(PASSAGES, frequencies, documents, similar)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each term of the templates, counted over a batch, and of all documents under null."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column("text"):
            counts.update(VOCABULARY.intersection(terms(text.as_py() or "")))
        names = [None, *counts]
        yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), "n": pa.array([batch.num_rows, *counts.values()], pa.int64())})


def _sum(flags: list[bool]) -> list[int]:
    return [0, *accumulate(flags)]


def find_notice(text: str, templates: tuple[Templates, Templates], similar: float = SIMILAR) -> tuple[str | None, float, float, int]:
    """The notice of a whole text, its best score, the share of the text's words in notices, and the words in this one."""
    short, whole = templates
    words: list[str] = []
    lines = [0]
    for line in text.split("\n"):
        words += terms(line)
        lines.append(len(words))
    total = len(words)
    scores: dict[str, float] = {}
    inside: dict[str, bytearray] = {}

    def hold(against: Templates, start: int, end: int) -> None:
        for name, score in against.near(words[start:end], similar).items():
            scores[name] = max(scores.get(name, 0.0), score)
            inside.setdefault(name, bytearray(total))[start:end] = b"\1" * (end - start)

    matched, needed = _sum([w in short.by_term for w in words]), _sum([w in short.needed for w in words])
    block = 0
    for start, end in zip(lines, lines[1:], strict=False):
        if start == end:
            continue
        if 2 * (matched[end] - matched[start]) < end - start:  # not licence language: ends a block
            if needed[start] > needed[block]:
                hold(short, block, start)
            block = end
        if needed[end] > needed[start]:
            hold(short, start, end)
    if needed[total] > needed[block]:
        hold(short, block, total)
    if needed[total]:
        found: list[tuple[float, int, int, str]] = []
        for size in RUNS:
            for start in range(0, total - size + 1, size // 4):
                end = start + size
                if needed[end] > needed[start] and 2 * (matched[end] - matched[start]) >= size:
                    found += [(-score, start, end, name) for name, score in short.near(words[start:end], similar).items()]
        for score, start, end, name in sorted(found):  # words beside a notice that is known already are not part of it
            scores[name] = max(scores.get(name, 0.0), -score)
            if not any(inside.setdefault(name, bytearray(total))[start:end]):
                inside[name][start:end] = b"\1" * (end - start)
    known = _sum([w in whole.by_term for w in words])
    for start in passages(total) if total else ():
        end = min(start + PASSAGE, total)
        if 2 * (known[end] - known[start]) >= end - start:
            hold(whole, start, end)
    if not scores:
        return None, 0.0, 0.0, 0
    covered = int(np.count_nonzero(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in inside.values()])))
    words_in, score, name = min((-inside[n].count(1), -scores[n], n) for n in scores)
    return name, -score, covered / total, -words_in


def scan_licenses(files: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per file of (doc_id, path, text): doc_id, path, license, score, scope, from_dir.

    ``scope`` is ``own`` for a notice in the text, ``inherited`` for that of a licence file
    in the nearest folder from the file's own upwards (``from_dir``), null with a null
    licence if there is neither.  Among a folder's licence files the one with the most words
    in its notice speaks, then the best score, then the least name.  Null and empty texts have no notice.  A null path lies in no
    folder and inherits nothing.  Repeated rows give repeated results.  Whole texts are
    compared, where they are read; what reaches the driver is one count per template term.
    """
    spark = files.sparkSession
    folder = work_dir(spark, "licences")
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"), "text")
    counted = rows.select("text").mapInArrow(_frequencies, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    frequencies = {r["term"]: r["n"] for r in counted}
    templates = fit_templates(frequencies, frequencies.pop(None, 0), similar)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [find_notice(t.as_py() or "", templates, similar) for t in part.column("text")]
                name, score, share, size = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "path": part.column("path"), "notice": pa.array(name, pa.string()), "score": pa.array(score), "share": pa.array(share), "size": pa.array(size, pa.int64())}
                )

    own = rows.mapInArrow(scan, "doc_id long, path string, notice string, score double, share double, size long")
    parent = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), ""))
    own.withColumn("dir", parent).write.parquet(f"{folder}/own")
    own = spark.read.parquet(f"{folder}/own")

    speaks = own.where((F.col("share") >= FILE_SHARE) & F.col("notice").isNotNull() & F.col("dir").isNotNull())
    speaks = speaks.groupBy("dir").agg(F.min(F.struct(-F.col("size"), -F.col("score"), "notice")).alias("s"))
    speaks = speaks.select(F.col("dir").alias("from_dir"), F.col("s.notice").alias("inherited"))
    dirs = own.where("notice IS NULL AND dir IS NOT NULL").select("dir").distinct()
    depth = F.size(F.split("dir", "/"))
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(
        F.concat(F.transform(F.sequence(F.lit(1), depth), lambda n: F.call_function("substring_index", F.col("dir"), F.lit("/"), n)), F.array(F.lit("")))
    )
    nearest = dirs.select("dir", F.explode(above).alias("from_dir")).join(speaks, "from_dir")
    nearest = nearest.groupBy("dir").agg(F.max(F.struct(F.length("from_dir"), "from_dir", "inherited")).alias("s"))
    nearest.select("dir", "s.from_dir", "s.inherited").write.parquet(f"{folder}/nearest")
    nearest = spark.read.parquet(f"{folder}/nearest")
    out = own.join(nearest, "dir", "left")
    mine = F.col("notice").isNotNull()
    return out.select(
        "doc_id", "path",
        F.coalesce("notice", "inherited").alias("license"),
        F.when(mine, F.col("score")).alias("score"),
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").alias("scope"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"),
    )
