"""Licence scans: sparse TF-IDF cosines of headers and licence files to templates, and inheritance from the nearest directory."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import written

MIN_COSINE = 0.6
#: A notice of so many words or more is sought in windows of half its length as well, for one that is cut short.
LONG_NOTICE = 16
#: Cosines are rounded to so many digits, beyond what the order of a sum may change.
DIGITS = 6
#: Directories that are sent to every task rather than shuffled.
MOST_SENT = 1 << 17

_WORDS = re.compile(r"[a-z0-9]+")
_FILE_NAME = r"(?i)(^|/)(un)?(licen[sc]e|copying|copyright|notice)([.-][^/]*)?$"

# Licence notices by SPDX identifier; fixed values.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "ISC": ("Released under the ISC License", "SPDX-License-Identifier: ISC"),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0"),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Proprietary": ("All rights reserved", "All rights reserved. Unauthorized copying of this file is strictly prohibited. Proprietary and confidential",),
}


#: Reserved rights stand beside notices that grant some, and count only where there is no other.
LAST = frozenset(["Proprietary"])


def terms_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


class TemplateIndex:
    """Weighted templates by term.

    The anchors of a template are chosen so that its other terms hold less than ``min_cosine`` squared of its squared length: a
    text without any of them is then below ``min_cosine`` to it, whatever else it holds, and is passed over.
    """

    def __init__(self, templates: dict[str, tuple[str, ...]], frequencies: dict[str, int], n_docs: int, min_cosine: float):
        self.min_cosine = min_cosine
        self.unseen = self._idf(0, n_docs)
        vocabulary = sorted({term for texts in templates.values() for text in texts for term in terms_of(text)})
        self.place = {term: k for k, term in enumerate(vocabulary)}
        self.idf = {term: self._idf(frequencies.get(term, 0), n_docs) for term in vocabulary}
        self.postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.names: list[str] = []
        self.sizes: list[tuple[int, ...]] = []
        self.anchors: set[str] = set()
        telling: list[list[int]] = []
        for name, texts in sorted(templates.items()):
            for text in texts:
                words = terms_of(text)
                weights = {term: count * self.idf[term] for term, count in Counter(words).items()}
                length = sqrt(sum(weight**2 for weight in weights.values()))
                left = (min_cosine * length) ** 2
                telling.append([])
                for term, weight in sorted(weights.items(), key=lambda x: (self.idf[x[0]], x[0])):
                    left -= weight**2
                    if left <= 1e-9:
                        self.anchors.add(term)
                        telling[-1].append(self.place[term])
                    self.postings[term].append((len(self.names), weight / length))
                self.names.append(name)
                self.sizes.append((len(words), (len(words) + 1) // 2) if len(words) >= LONG_NOTICE else (len(words),))
        # The same by number of the term; the last column stands for all terms that no template has.
        self.parts = np.zeros((len(self.names), len(vocabulary) + 1))
        self.telling = np.zeros(self.parts.shape, bool)
        for term, shares in self.postings.items():
            for template, share in shares:
                self.parts[template, self.place[term]] = share * self.idf[term]
        for template, places in enumerate(telling):
            self.telling[template, places] = True
        self.weights = np.array([self.idf[term] for term in vocabulary] + [self.unseen])

    @staticmethod
    def _idf(frequency: int, n_docs: int) -> float:
        return log((n_docs + 1) / (frequency + 1)) + 1

    def best(self, terms: Counter[str]) -> tuple[float, str]:
        """Highest cosine of a bag of terms and its licence; of equals, the first name; those in ``LAST`` only if no other reaches the limit."""
        scores: dict[int, float] = defaultdict(float)
        squares = 0.0
        for term, count in terms.items():
            weight = count * self.idf.get(term, self.unseen)
            squares += weight**2
            for template, share in self.postings.get(term, ()):
                scores[template] += weight * share
        if not scores:
            return 0.0, ""
        length = sqrt(squares)
        cosines = ((round(min(1.0, score / length), DIGITS), self.names[template]) for template, score in scores.items())
        return min(cosines, key=lambda found: (2 if found[0] < self.min_cosine else int(found[1] in LAST), -found[0], found[1]))

    def windows(self, words: list[str]) -> list[tuple[float, int, int, int]]:
        """``(cosine, template, start, end)`` of every window of a template's size, or what of it lies in the text, that reaches the limit."""
        at = [k for k, word in enumerate(words) if word in self.anchors]
        reach = max((size for sizes in self.sizes for size in sizes), default=0)
        found: list[tuple[float, int, int, int]] = []
        # Stretches within reach of the anchors: every window with an anchor lies in one, whole.
        while at:
            last = next((k for k in range(len(at) - 1) if at[k + 1] - at[k] >= 2 * reach), len(at) - 1)
            low, high = max(0, at[0] - reach + 1), min(len(words), at[last] + reach)
            found += [(cosine, template, low + start, low + end) for cosine, template, start, end in self._stretch(words[low:high])]
            at = at[last + 1 :]
        return found

    def _stretch(self, words: list[str]) -> Iterator[tuple[float, int, int, int]]:
        """All windows of a stretch of words at once, by running sums; the squared length of a window counts each pair of equal words twice."""
        n, others = len(words), len(self.place)
        number = dict(self.place)
        ids = np.array([number.setdefault(word, len(number) + 1) for word in words])
        known = np.minimum(ids, others)
        squares = self.weights[known] ** 2
        order = np.argsort(ids, kind="stable")
        before = np.full(n, -1)
        same = ids[order[1:]] == ids[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        run = np.concatenate([[0.0], np.cumsum(squares)])
        lengths: dict[int, np.ndarray] = {}
        present = np.bincount(known, minlength=others + 1) > 0
        for template in np.flatnonzero((self.telling & present).any(axis=1)).tolist():
            dots = np.concatenate([[0.0], np.cumsum(self.parts[template, known])])
            anchors = np.concatenate([[0], np.cumsum(self.telling[template, known])])
            for size in self.sizes[template]:
                ends = np.arange(1, n + size)
                starts, ends = np.maximum(ends - size, 0), np.minimum(ends, n)
                if size not in lengths:
                    twice = np.zeros(n + size)
                    later = np.flatnonzero(before >= 0)
                    earlier = before[later]
                    while True:
                        near = later - earlier < size
                        later, earlier = later[near], earlier[near]
                        if not len(later):
                            break
                        twice += np.bincount(later, squares[later], n + size) - np.bincount(earlier + size, squares[later], n + size)
                        earlier = before[earlier]
                        later, earlier = later[earlier >= 0], earlier[earlier >= 0]
                    lengths[size] = np.sqrt(run[ends] - run[starts] + 2 * np.cumsum(twice)[:-1])
                cosines = np.round(np.minimum(1.0, (dots[ends] - dots[starts]) / lengths[size]), DIGITS)
                for k in np.flatnonzero((cosines >= self.min_cosine) & (anchors[ends] > anchors[starts])).tolist():
                    yield float(cosines[k]), template, int(starts[k]), int(ends[k])

    def notices(self, words: list[str]) -> list[tuple[float, str, int, int]]:
        """Notices that do not overlap, the best first; those in ``LAST`` only where there is no other."""
        taken = bytearray(len(words))
        found: list[tuple[float, str, int, int]] = []
        ranked = sorted((self.names[template] in LAST, -cosine, start - end, self.names[template], start, end) for cosine, template, start, end in self.windows(words))
        for last, cost, _, name, start, end in ranked:
            if last and found and found[0][1] not in LAST:
                break
            if not any(taken[start:end]):
                taken[start:end] = b"\1" * (end - start)
                found.append((-cost, name, start, end))
        return found

    def scan(self, text: str | None) -> tuple[float, str, list[str], float, str]:
        """Best notice and all licences of a text, the best first; best cosine of the whole text and its licence."""
        words = terms_of(text or "")
        if self.anchors.isdisjoint(words):
            return 0.0, "", [], 0.0, ""
        notices = self.notices(words)
        first = notices[0][:2] if notices else (0.0, "")
        return *first, list(dict.fromkeys(name for _, name, _, _ in notices)), *self.best(Counter(words))


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: set[str]) -> tuple[dict[str, int], int]:
    """In how many of all texts each term of the templates occurs, and the number of rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(vocabulary.intersection(terms_of(text or "")))
            found[""] += len(batch)
        yield pd.DataFrame({"term": pd.Series(list(found), dtype=object), "n": pd.Series(list(found.values()), dtype="int64")})

    counts = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {row["term"]: row["n"] for row in counts.collect()}
    return found, found.pop("", 0)


def folder_of(path: Column) -> Column:
    """The directory of a path; empty at the top."""
    return F.regexp_replace(F.regexp_replace(path, "[^/]*$", ""), "/+$", "")


def _ancestors(folder: Column) -> Column:
    """A directory and those above it, the nearest first, up to the top (empty)."""
    parts = F.filter(F.split(folder, "/"), lambda part: part != "")
    sizes = F.sequence(F.size(parts), F.lit(0))
    return F.transform(sizes, lambda size: F.array_join(F.slice(parts, 1, size), "/"))


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", templates: dict[str, tuple[str, ...]] | None = None, min_cosine: float = MIN_COSINE
) -> DataFrame:
    """``(doc_id, path, license, score, licenses, origin, origin_path)`` per row.

    Notices are windows of a template's words, wherever lines break, with a cosine of ``min_cosine`` or more; of those that overlap
    the closest counts. ``license`` is the closest of all, ``licenses`` has each that the text grants.
    A row's own notices decide (origin ``header``), else the licence file in the nearest directory above
    (origin ``directory``; the row itself if it is that file), else there is none (``license`` null, origin ``none``). Of several
    licence files in one directory, the closest to its template counts, then the first path. Null and empty texts have
    no notice but inherit; a null path is at the top; repeated rows stay; other columns are ignored.
    """
    templates = templates or TEMPLATES
    vocabulary = {term for texts in templates.values() for text in texts for term in terms_of(text)}
    path = F.coalesce(F.col(path_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), path.alias("path"), F.col(text_col).alias("text"))
    index = TemplateIndex(templates, *document_frequencies(rows, "text", vocabulary), min_cosine)

    @F.pandas_udf("header_score double, header string, headers array<string>, whole_score double, whole string")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            found = [index.scan(text) for text in batch]
            yield pd.DataFrame(found, columns=["header_score", "header", "headers", "whole_score", "whole"])

    folder = F.regexp_replace(F.regexp_replace(folder_of(F.col("path")), "^/+", ""), "/+", "/")
    found = rows.select("doc_id", "path", folder.alias("folder"), scan("text").alias("found"))
    found = written(found.select("doc_id", "path", "folder", "found.*"), "licences")

    # A licence file is one by name; its whole text or a window of it may be closer to a template.
    score = F.greatest("header_score", "whole_score")
    is_file = F.col("path").rlike(_FILE_NAME) & (score >= min_cosine)
    name = F.when(F.col("whole_score") >= F.col("header_score"), F.col("whole")).otherwise(F.col("header"))
    all_names = F.array_distinct(F.concat(F.array(name), "headers"))
    files = found.where(is_file).select("folder", F.struct((-score).alias("cost"), F.col("path").alias("origin_path"), name.alias("license"), all_names.alias("licenses")).alias("file"))
    files = files.groupBy("folder").agg(F.min("file").alias("file"))
    # Each directory once, so a directory with most of the documents is one row here.
    above = found.select("folder").distinct().select("folder", F.posexplode(_ancestors(F.col("folder"))).alias("steps", "ancestor"))
    nearest = above.join(files.withColumnRenamed("folder", "ancestor"), "ancestor").groupBy("folder").agg(F.min(F.struct("steps", "file")).alias("nearest"))
    # Directories that inherit are few; sent to every task, one with most of the documents is no hot key. More of them are
    # joined by Spark's sort-merge, whose large partitions it splits.
    nearest = written(nearest, "nearest")
    nearest = F.broadcast(nearest) if nearest.count() <= MOST_SENT else nearest
    own = F.col("header_score") >= min_cosine
    inherited = F.col("nearest.file")
    return found.join(nearest, "folder", "left").select(
        "doc_id",
        "path",
        F.when(own, F.col("header")).otherwise(inherited["license"]).alias("license"),
        F.when(own, F.col("header_score")).otherwise(-inherited["cost"]).alias("score"),
        F.coalesce(F.when(own, F.col("headers")).otherwise(inherited["licenses"]), F.array().cast("array<string>")).alias("licenses"),
        F.when(own, "header").when(inherited.isNotNull(), "directory").otherwise("none").alias("origin"),
        F.when(own, F.col("path")).otherwise(inherited["origin_path"]).alias("origin_path"),
    )


def op2_license_scan(docs: DataFrame) -> DataFrame:
    """The digest of the query: documents as files of a tree, a directory for 64 ids below one for 1,024, below source and language.

    ``documents`` has no paths, so a text that mentions a licence or reserved rights stands for a licence file by its name.
    """
    mentions = F.coalesce(F.col("text").rlike("(?i)licen[sc]e|rights reserved"), F.lit(False))
    doc_id = F.col("doc_id").cast("long")
    name = F.concat(F.when(mentions, "LICENSE-").otherwise("doc-"), doc_id.cast("string"))
    path = F.concat_ws("/", "source", "lang", F.shiftright(doc_id, 10).cast("string"), F.shiftright(doc_id, 6).cast("string"), name)
    return scan_licenses(docs.select("doc_id", path.alias("path"), "text"))
