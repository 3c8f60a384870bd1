"""Licence scan: TF-IDF cosine of passages to templates, then inheritance from the nearest directory above.

Weights come from the whole corpus: one pass counts in how many files each word of the templates occurs; all other words weigh as words that
occur in none. Every passage of a template's length is compared as a sparse vector, but for those whose words cannot reach the bound: by Cauchy and
Schwarz, their part of the template's norm is below it. A file is passed over by that with one set operation, a passage with one difference of sums.

A file that states no licence takes that of the nearest directory above it that has a licence file: directories, not files, are expanded to
their ancestors and joined.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import ship, stage

THRESHOLD = 0.75
#: fixed values: short notices as licences and their users word them
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense|notice)([._-].*)?$"
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
_SPDX = "spdx-license-identifier:"
#: for rounding, the share of the bound that a sum may lack
_SLACK = 1e-6


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Matcher:
    """Templates as weighted vectors, given the number of files and how many have each word."""

    def __init__(self, templates: tuple[tuple[str, str], ...], files: int, having: dict[str, int], threshold: float):
        idf = lambda n: math.log((files + 1) / (n + 1)) + 1
        self.other, self.threshold, self.templates, self.vocabulary = idf(0), threshold, [], set()
        self.idf = {w: idf(having.get(w, 0)) for _, t in templates for w in tokens(t)}
        for name, text in templates:
            words = tokens(text)
            vector = {w: n * self.idf[w] for w, n in Counter(words).items()}
            # an SPDX line is of no licence but the one that it names
            needed = frozenset(tokens(text[len(_SPDX) :])) if text.lower().startswith(_SPDX) else frozenset()
            self.templates.append((name, vector, math.sqrt(sum(v * v for v in vector.values())), len(words), needed))
            self.vocabulary |= vector.keys()

    def best(self, text: str) -> tuple[str | None, float, int, int]:
        """(licence, cosine, start and end in code points) of the best passage; of equals the template listed first, then the first place."""
        found = self.vocabulary.intersection(tokens(text))
        out, place = (None, 0.0, 0, 0), None
        for name, vector, norm, length, needed in self.templates:
            bound = (self.threshold * norm) ** 2 * (1 - _SLACK)
            if not needed <= found or sum(vector[w] ** 2 for w in found & vector.keys()) < bound:
                continue
            place = place or [(m[0], *m.span()) for m in _WORD.finditer(text.lower())]
            # words that come again count again: never less than the part of the norm
            sums = [0.0, *accumulate(vector.get(w, 0.0) ** 2 for w, _, _ in place)]
            for start in range(len(place)):
                if sums[min(start + length, len(place))] - sums[start] < bound:
                    continue
                part = place[start : start + length]
                counts = Counter(w for w, _, _ in part)
                if not needed <= counts.keys():
                    continue
                dot = sum(n * self.idf[w] * vector[w] for w, n in counts.items() if w in vector)
                size = math.sqrt(sum((n * self.idf.get(w, self.other)) ** 2 for w, n in counts.items()))
                cosine = min(dot / (size * norm), 1.0)
                if cosine >= self.threshold and cosine > out[1] + 1e-9:
                    out = (name, cosine, part[0][1], part[-1][2])
        return out


def count_words(files: DataFrame, words: set[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """(number of files, files that have each of some words); the result has the size of the templates' vocabulary."""
    ship(files.sparkSession)
    wanted = frozenset(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            total[""] += batch.num_rows
            for text in batch.column(0):
                total.update(wanted.intersection(tokens(text.as_py() or "")))
        yield pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = files.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "word string, n long")
    counts = {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return counts.pop("", 0) or 0, counts


def stated(
    files: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
) -> DataFrame:
    """(id, path, licence, score, start, end): for each file the licence that its whole text states best, null if none reaches the threshold."""
    matcher = Matcher(templates, *count_words(files, {w for _, t in templates for w in tokens(t)}, text_col), threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [matcher.best(t.as_py() or "") for t in batch.column(2)]
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.int32())
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], ["id", "path", "licence", "score", "start", "end"])

    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, path string, licence string, score double, start int, end int")


def directory(path):
    """What is before the last slash; empty for a file at the top, null of null."""
    return F.when(F.locate("/", path) > 0, F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def scan(
    files: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    licence_file: str = LICENCE_FILE,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, path, licence, how, score, start, end, from_dir): one row for each row of ``files``.

    ``how`` is "stated", "inherited" or "none". Of several licence files of a directory (their last part matches ``licence_file``) the best
    score counts, then the first licence by name. A null text states nothing; a null path has no directory and inherits nothing; a path without a slash is at
    the top, whose licence files hold for all paths. Start and end are code points of the lower-cased text. Repeated rows are returned as often as they come; an
    empty table gives no rows. Other columns are not looked at.
    """
    own = stage(stated(files, templates, threshold, id_col, path_col, text_col).withColumn("dir", directory(F.col("path"))), "stated")
    named = own.filter(F.col("licence").isNotNull() & F.regexp_extract("path", "([^/]*)$", 1).rlike(licence_file))
    of_dir = named.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("licence").alias("licence"))).alias("best"))
    of_dir = of_dir.select(F.col("dir").alias("above"), F.col("best.licence").alias("given"))
    # each directory once, with itself and all that are above it; the top is the empty one
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.concat_ws("/", F.slice(parts, 1, n)).alias("above")))
    dirs = own.filter("dir IS NOT NULL").select("dir").distinct().select("dir", F.inline(above)).filter("depth = 0 OR above <> ''")
    nearest = dirs.join(of_dir, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "given")).alias("up"))
    nearest = stage(nearest.select("dir", "up.above", "up.given"), "nearest")
    inherits = F.col("licence").isNull() & F.col("given").isNotNull()
    return own.join(nearest, "dir", "left").select(
        F.col("id").alias("doc_id"),
        "path",
        F.coalesce("licence", "given").alias("licence"),
        F.when(F.col("licence").isNotNull(), "stated").when(inherits, "inherited").otherwise("none").alias("how"),
        "score",
        "start",
        "end",
        F.when(inherits, F.col("above")).alias("from_dir"),
    )


def shelved(docs: DataFrame) -> DataFrame:
    """``documents`` as files: source / language / shelf / number. Each fiftieth is the licence file of its shelf or, by turns, of its language."""
    top = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")))
    shelf = F.concat_ws("/", top, F.expr("doc_id div 200 % 100").cast("string"))
    name = F.col("doc_id").cast("string")
    path = (
        F.when(F.col("doc_id") % 50 != 0, F.concat(shelf, F.lit("/"), name, F.lit(".txt")))
        .when(F.col("doc_id") % 100 == 0, F.concat(shelf, F.lit("/LICENSE."), name))
        .otherwise(F.concat(top, F.lit("/LICENSE."), name))
    )
    return docs.select("doc_id", path.alias("path"), "text")
