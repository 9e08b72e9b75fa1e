"""License scans: cosine of passages to licence templates, and inheritance from the nearest directory above."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import decontamination
from affinity.llm.decontamination import words_of
from affinity.llm.frames import travels
from affinity.sources.scratch import materialize

travels(__name__)
travels(decontamination.__name__)

# Short notices by which works state their licence, by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Least cosine of a passage to a template.
LEAST = 0.75
#: Lines of a notice that is broken over several: with a word or more of it in each, it has no more than the longest template has words.
MOST_LINES = max(len(words_of(t)) for _, t in TEMPLATES)
#: Summed term by term, a cosine may be off by rounding; from so much below a limit on it is taken again as a whole.
SLACK = 1e-9


def _vocabulary() -> list[str]:
    return sorted({w.decode() for _, t in TEMPLATES for w in words_of(t)})


class Matcher:
    """Sparse TF-IDF vectors of the templates; passages are compared to them term by term."""

    def __init__(self, lines: int, held: dict[str, int]):
        self.unseen = log(lines + 1) + 1
        self.idf = {w.encode(): log((lines + 1) / (held.get(w, 0) + 1)) + 1 for w in _vocabulary()}
        self.terms: dict[bytes, list[tuple[int, float]]] = {}
        for t, (_, text) in enumerate(TEMPLATES):
            tf = Counter(words_of(text))
            norm = sqrt(sum((n * self.idf[w]) ** 2 for w, n in tf.items()))
            for w, n in tf.items():
                self.terms.setdefault(w, []).append((t, n * self.idf[w] / norm))

    def bound(self, words: list[bytes]) -> float:
        """At least as large as the cosine to any template: only the known words count in it."""
        known = Counter(w for w in words if w in self.idf)
        if not known:
            return 0.0
        inside = sum((n * self.idf[w]) ** 2 for w, n in known.items())
        return sqrt(inside / (inside + (len(words) - sum(known.values())) * self.unseen**2))

    def best(self, words: list[bytes]) -> tuple[float, int]:
        """The nearest template (the first of equals) and its cosine."""
        tf, dots, norm = Counter(words), {}, 0.0
        for w, n in tf.items():
            x = n * self.idf.get(w, self.unseen)
            norm += x * x
            for t, weight in self.terms.get(w, ()):
                dots[t] = dots.get(t, 0.0) + x * weight
        if not dots:
            return 0.0, -1
        t = min(dots, key=lambda t: (-round(dots[t], 12), t))
        return dots[t] / sqrt(norm), t

    def growing(self, run: list[tuple[int, list[bytes]]]) -> Iterator[tuple[int, float]]:
        """The largest cosine of the first two, three, ... lines of a run, each from the one before it."""
        tf: Counter = Counter()
        dots, norm = {}, 0.0
        for b, (_, words) in enumerate(run, 1):
            for w in words:
                idf = self.idf.get(w, self.unseen)
                norm += (2 * tf[w] + 1) * idf * idf
                tf[w] += 1
                for t, weight in self.terms.get(w, ()):
                    dots[t] = dots.get(t, 0.0) + idf * weight
            if b > 1:
                yield b, max(dots.values(), default=0.0) / sqrt(norm)

    def scan(self, text: str | None) -> tuple[str | None, float, int]:
        """(licence, cosine, line) of the passage nearest to a template; passages are lines and up to MOST_LINES licence-like ones in a row."""
        top = (0.0, -1, -1)
        run: list[tuple[int, list[bytes]]] = []
        lines = (text or "").split("\n")
        for i, line in enumerate([*lines, ""]):
            words = words_of(line)
            near = self.bound(words) if words else 0.0
            if near >= LEAST:
                found, t = self.best(words)
                if found >= LEAST and round(found, 12) > round(top[0], 12):
                    top = (found, t, i)
            if near >= LEAST / 2:
                run.append((i, words))
                continue
            for a in range(len(run) - 1):
                for b, about in self.growing(run[a : a + MOST_LINES]):
                    if about < max(LEAST, top[0]) - SLACK:
                        continue
                    found, t = self.best([w for _, ws in run[a : a + b] for w in ws])
                    if found >= LEAST and round(found, 12) > round(top[0], 12):
                        top = (found, t, run[a][0])
            run = []
        return (TEMPLATES[top[1]][0], top[0], top[2]) if top[1] >= 0 else (None, 0.0, -1)


def _line_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = {w.encode() for w in _vocabulary()}
    for batch in batches:
        held: Counter = Counter()
        lines = 0
        for text in batch["text"]:
            for line in (text or "").split("\n"):
                words = words_of(line)
                if words:
                    lines += 1
                    held.update(known.intersection(words))
        yield pd.DataFrame([("", lines), *((w.decode(), n) for w, n in held.items())], columns=["word", "n"])


def matcher(files: DataFrame) -> Matcher:
    """Counts lines over all files; what reaches the driver is a number for each word of the templates."""
    counts = files.select("text").mapInPandas(_line_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    held = {r.word: r.n for r in counts}
    return Matcher(held.pop("", 0), held)


def own_licenses(files: DataFrame) -> DataFrame:
    """(id, path, license, similarity, line) of each row of ``files`` (id, path, text)."""
    shared = files.sparkSession.sparkContext.broadcast(matcher(files))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [shared.value.scan(t) for t in batch["text"]]
            out = batch.drop(columns="text")
            out["license"], out["similarity"], out["line"] = zip(*made) if made else ([], [], [])
            yield out

    return files.select(F.col("id").cast("bigint").alias("id"), "path", "text").mapInPandas(run, "id bigint, path string, license string, similarity double, line int")


def directory(path: Column) -> Column:
    """The part before the last slash; empty at the top."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan(files: DataFrame, is_licence_file: Column | None = None) -> DataFrame:
    """(id, path, own, similarity, line, license, origin) of each row of ``files`` (id, path, text).

    own: the licence of the file's own notice. A file without one inherits from
    the nearest directory at or above its own that holds a licence file with a
    notice: by default one named LICENSE, LICENCE, COPYING or NOTICE. Of
    several, the nearest to its template counts, then the first path and
    licence. origin is own, inherited or null.

    A null text has no notice, a null path lies at the top; repeated rows stay;
    an empty table gives an empty one. Directories are expanded to the ones
    above once for each distinct one, never for each file.
    """
    named = F.upper(F.regexp_extract("path", "([^/]*)$", 1)).rlike("^(LICEN[CS]E|COPYING|NOTICE)([.].*)?$")
    rows = materialize(own_licenses(files).withColumn("dir", directory(F.coalesce("path", F.lit("")))), "licenses")
    told = rows.where((named if is_licence_file is None else is_licence_file) & F.col("license").isNotNull())
    first = F.min(F.struct((-F.round("similarity", 9)).alias("s"), F.col("path"), F.col("license")))["license"]
    by_dir = told.groupBy(F.col("dir").alias("above")).agg(first.alias("from_dir"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    # The top is the empty name, which a path with directories has above them.
    dirs = rows.select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("above"))
    nearest = dirs.join(by_dir, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), F.col("from_dir").alias("from_dir")))["from_dir"].alias("inherited"))
    out = rows.join(materialize(nearest, "nearest"), "dir", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited")
    return out.select("id", "path", F.col("license").alias("own"), "similarity", "line", F.coalesce("license", "inherited").alias("license"), origin.alias("origin"))
