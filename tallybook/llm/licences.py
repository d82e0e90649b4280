"""Licences of files, by their own words or from the nearest directory above."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.common import materialized, small_batches

# Short notices as they stand in headers and at the top of licence files. Fixed values.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
        "Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The MIT License (MIT)",
        "MIT License",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU General Public License Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "GNU Lesser General Public License Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "GNU Lesser General Public License Version 2.1, February 1999",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License Version 3, 19 November 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "ISC": [
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "CC0-1.0": ["CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "SPDX-License-Identifier: BSD-2-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved."],
}
LICENCE_FILES = r"(?i)^(licen[cs]e|copying|unlicense|notice)(\.[a-z]+)?$"

# Notices are wrapped: lines that follow one another are also read as one, up to so many.
JOINED = 8

_TERM = re.compile(r"[a-z]+|[0-9]+")
_LINE = re.compile(r"[\r\n]+")


def terms(line: str) -> list[str]:
    """Words and numbers, and the pairs of neighbours."""
    words = _TERM.findall(line.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


class Scorer:
    """TF-IDF vectors of the templates; terms that no template has count as the rarest."""

    def __init__(self, templates: Mapping[str, list[str]], held: Mapping[str, int], n_lines: int, least: float):
        self.least = least
        self.longest = max((len(text) for texts in templates.values() for text in texts), default=0)
        self.unknown = float(np.log((n_lines + 1) / 1.0) + 1)
        self.idf = {t: float(np.log((n_lines + 1) / (held.get(t, 0) + 1)) + 1) for t in vocabulary(templates)}
        self.vectors: list[tuple[str, dict[str, float]]] = []
        anchors: set[str] = set()
        for name in sorted(templates):
            for text in templates[name]:
                vector = {t: (1 + float(np.log(n))) * self.idf[t] for t, n in Counter(terms(text)).items()}
                norm = float(np.sqrt(sum(w * w for w in vector.values())))
                vector = {t: w / norm for t, w in vector.items()}
                self.vectors.append((name, vector))
                # A line without any of the heaviest terms can reach no more than what the rest weighs.
                rest, ranked = 1.0, sorted(vector, key=lambda t, v=vector: (-v[t], t))
                for term in ranked:
                    if rest < least * least * 0.999:
                        break
                    anchors.add(term)
                    rest -= vector[term] ** 2
        # A line with a pair has its rarer word.
        self.words = frozenset(max(a.split(" "), key=lambda w: (self.idf[w], w)) for a in anchors)
        self.anchors = re.compile("|".join(sorted(map(re.escape, self.words), key=len, reverse=True)))
        self.by_term: dict[str, list[tuple[int, float]]] = {}
        for i, (_, vector) in enumerate(self.vectors):
            for term, weight in vector.items():
                self.by_term.setdefault(term, []).append((i, weight))

    def score(self, line: str) -> tuple[str, float] | None:
        """The template of the greatest cosine, if that is at least ``least``; ties go to the name that sorts first."""
        counts = Counter(terms(line))
        if not counts:
            return None
        weights = {t: (1 + float(np.log(n))) * self.idf.get(t, self.unknown) for t, n in counts.items()}
        norm = float(np.sqrt(sum(w * w for w in weights.values())))
        near = [0.0] * len(self.vectors)
        for term, weight in weights.items():
            for i, other in self.by_term.get(term, ()):
                near[i] += weight * other
        best = max(range(len(near)), key=lambda i: (near[i], -i))
        cosine = min(1.0, near[best] / norm)
        return (self.vectors[best][0], cosine) if cosine >= self.least else None

    def best(self, text: str | None) -> tuple[str | None, float, str | None]:
        """The best line of a text, or the best of up to JOINED lines read as one; of equals the first, then the shortest.

        Every line is looked at. Lines are joined around those that hold a telling word, as long as together they
        are not far longer than any template: notices stand in comment headers and licence files wrapped at any width.
        """
        found: tuple[str | None, float, str | None] = (None, 0.0, None)
        lower = (text or "").lower()
        if not any(word in lower for word in self.words):
            return found
        lines = [line for line in _LINE.split(text) if line and not line.isspace()]
        telling = [i for i, line in enumerate(lines) if self.anchors.search(low := line.lower()) and not self.words.isdisjoint(_TERM.findall(low))]
        sizes = [min(len(line), 8 * self.longest) for line in lines] if telling else []
        tried: set[tuple[int, int]] = set()
        for i in telling:
            for size in range(1, JOINED + 1):
                for start in range(max(0, i - size + 1), min(i, len(lines) - size) + 1):
                    if (start, size) in tried or size > 1 and sum(sizes[start : start + size]) > 4 * self.longest:
                        continue
                    tried.add((start, size))
                    joined = " ".join(map(str.strip, lines[start : start + size])) if size > 1 else lines[start]
                    hit = self.score(joined)
                    if hit and hit[1] > found[1] + 1e-12:
                        found = (*hit, joined)
        return found


def vocabulary(templates: Mapping[str, list[str]]) -> set[str]:
    return {t for texts in templates.values() for text in texts for t in terms(text)}


def line_frequencies(files: DataFrame, templates: Mapping[str, list[str]]) -> tuple[dict[str, int], int]:
    """In how many lines of all texts each term of the templates occurs, and the number of lines."""
    held = vocabulary(templates)
    words = {t for t in held if " " not in t}

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                for line in _LINE.split(text or ""):
                    found = _TERM.findall(line.lower())
                    if found:
                        counts[""] += 1
                        known = set(found) & words
                        if known:
                            counts.update(known)
                            if len(known) > 1:
                                counts.update({f"{a} {b}" for a, b in zip(found, found[1:], strict=False) if a in known and b in known} & held)
        yield pd.DataFrame(list(counts.items()), columns=["term", "n"])

    rows = files.select("text").mapInPandas(tally, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}  # as many rows as the templates have terms
    return found, found.pop("", 0)


def own_licence(text: str | Column, scorer: Scorer) -> Column:
    @pandas_udf("licence string, cosine double, line string")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scorer.best(t) for t in texts], columns=["licence", "cosine", "line"]).astype({"licence": object, "line": object})

    return of(text)


def _parents(path: Column) -> Column:
    """The directories above a path, nearest first, with their distance; the root is empty."""
    parts = F.split(path, "/")
    depth = F.size(parts) - 1
    return F.transform(F.sequence(F.lit(0), depth), lambda up: F.struct(
        up.cast("int").alias("up"), F.array_join(F.slice(parts, F.lit(1), depth - up), "/").alias("directory")))


def scan_licences(files: DataFrame, *, least: float = 0.8, templates: Mapping[str, list[str]] | None = None) -> DataFrame:
    """All rows of ``files`` (``path``, ``text`` and others): ``path``, ``licence``, ``origin``, ``cosine``, ``line``, ``from_path``.

    Each line of a text, and up to JOINED lines around a telling word read as one, as headers and licence files wrap them, is
    compared with the templates by the cosine of TF-IDF vectors of words and neighbouring words; line frequencies are
    counted over all texts. A file whose best line or lines reach ``least`` has that licence (``origin`` is ``header``, or ``file`` for a licence file, by name).
    Otherwise it has that of the nearest directory above, its own included, with a licence file that
    has one (``origin`` ``inherited``, ``from_path`` names the file), or none (all null).

    Of several licence files of a directory the one with the greatest cosine counts, then the least
    path. Null and empty texts have no lines; a null path is in no directory. Rows repeated are rows of their own. An
    empty table gives an empty result. ``files`` keeps its other columns, except that former results are replaced.
    """
    templates = TEMPLATES if templates is None else templates
    small_batches(files.sparkSession)
    held, n_lines = line_frequencies(files, templates)
    scorer = Scorer(templates, held, n_lines, least)
    results = ["licence", "origin", "cosine", "line", "from_path"]
    plain = files.drop(*results)
    others = [c for c in plain.columns if c not in ("text", "path")]
    scanned = plain.select(F.struct("path", *others).alias("row"), "path", own_licence("text", scorer).alias("own"))
    scanned = materialized(scanned, "licences")

    parts = F.split("path", "/")
    directory = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")
    named = scanned.where(F.col("own.licence").isNotNull() & F.element_at(parts, -1).rlike(LICENCE_FILES))
    best = F.min(F.struct((-F.col("own.cosine")).alias("order"), F.col("path").alias("from_path"), F.col("own.licence").alias("licence")))
    given = named.groupBy(directory.alias("directory")).agg(best.alias("best")).select("directory", "best.from_path", "best.licence")

    # Directories are joined, not files: each distinct directory looks for its nearest ancestor once.
    wanting = scanned.where(F.col("own.licence").isNull() & F.col("path").isNotNull()).select(directory.alias("below")).distinct()
    above = wanting.select("below", F.explode(_parents(F.concat("below", F.lit("/")))).alias("above")).select("below", "above.up", F.col("above.directory").alias("directory"))
    nearest = above.join(given, "directory").groupBy("below").agg(F.min(F.struct("up", "from_path", "licence")).alias("near"))
    nearest = nearest.select("below", "near.from_path", F.col("near.licence").alias("inherited"))

    joined = scanned.withColumn("own_directory", F.when(F.col("own.licence").isNull(), directory)).join(nearest, F.col("own_directory") == F.col("below"), "left")
    named_file = F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILES)
    origin = F.when(F.col("own.licence").isNotNull(), F.when(named_file, F.lit("file")).otherwise(F.lit("header"))).when(F.col("inherited").isNotNull(), F.lit("inherited"))
    return joined.select(
        "row.*", F.coalesce("own.licence", "inherited").alias("licence"), origin.alias("origin"),
        F.when(F.col("own.licence").isNotNull(), F.col("own.cosine")).alias("cosine"), F.col("own.line").alias("line"), "from_path")
