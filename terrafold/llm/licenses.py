"""License scan: TF-IDF cosine to templates, then inheritance down the directories (operator 1).

Words are runs of letters and digits, A-Z lower-cased. Each line, paragraph and whole text is a sparse
vector of term counts times inverse document frequencies; the frequencies of the templates' words are
counted over the lines of all documents, and any other word weighs as the rarest of them. A text's own
licence is the template of highest cosine with any of these, from `threshold` up. A file named as a
licence file gives its licence to its directory. A file without a licence of its own gets that of the
nearest directory above it, up to the root of its tree, found by joining each distinct directory's ancestors to the
licensed ones; files then join to their directory. Empty steps of a path, as in a//b, count for nothing above a file.
Texts are scored once.

Defined cases: a null text, or one without words, has no licence of its own and may inherit; a null path
inherits nothing; ties go to the earlier template name; of several licence files in a directory the one of
highest cosine counts, then the smaller name; repeated rows each get a result; an empty table gives an
empty result; very long texts are read whole; columns with the names of the results, in any case, are replaced, all
others stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import LOWER_ASCII, U64, Words, aside, byte_lists, cut, restored, with_results, without

THRESHOLD = 0.7
# Public licence statements and headers, by SPDX identifier.
TEMPLATES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-1.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
FILE_NAMES = ("LICENSE", "LICENSE.txt", "LICENSE.md", "LICENCE", "COPYING")
_WORDS = bytes(b if chr(b).isascii() and chr(b).isalnum() or b >= 0x80 else b if b == 10 else 0x20 for b in LOWER_ASCII)


class Segments:
    """Words of texts with the line, paragraph (blank lines part them) and text that each stands in."""

    def __init__(self, texts: list[bytes]):
        self.words = Words([t.translate(_WORDS) for t in texts])
        raw = np.frombuffer(self.words.data, np.uint8)
        breaks = np.flatnonzero(raw == 10)
        self.text = np.repeat(np.arange(len(texts)), self.words.count)
        line = np.searchsorted(breaks, self.words.start)
        gap = np.concatenate([[0], (np.diff(line) > 1) | (np.diff(self.text) > 0)]) if len(line) else line
        self.line = np.unique(line, return_inverse=True)[1] if len(line) else line
        self.paragraph = np.cumsum(gap)


class Templates:
    """The templates' words, term counts and, once frequencies are known, unit vectors."""

    def __init__(self, templates: tuple = TEMPLATES):
        self.names = [n for n, _ in templates]
        parts = Segments([t.encode() for _, t in templates])
        self.keys, inverse = np.unique(parts.words.hash, return_inverse=True)
        self.counts = np.zeros((len(templates), len(self.keys)))
        np.add.at(self.counts, (parts.text, inverse), 1)

    def columns(self, words: np.ndarray) -> np.ndarray:
        """Column of each word, -1 for words that no template has."""
        at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        return np.where(self.keys[at] == words, at, -1)

    def weigh(self, lines: int, found: np.ndarray) -> None:
        self.idf = np.log((1 + lines) / (1 + found)) + 1
        self.other = float(self.idf.max(initial=1.0))
        self.vectors = self.counts * self.idf
        self.vectors /= np.sqrt((self.vectors**2).sum(axis=1, keepdims=True))

    def cosines(self, segment: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best cosine and template of each segment (rising numbers from 0)."""
        n = int(segment.max(initial=-1)) + 1
        best, which = np.zeros(n), np.zeros(n, np.int64)
        col = self.columns(words)
        ours = col >= 0
        pair = np.lexsort((words[~ours], segment[~ours]))
        s, w = segment[~ours][pair], words[~ours][pair]
        head = np.flatnonzero(np.concatenate([np.ones(min(1, len(s)), bool), (s[1:] != s[:-1]) | (w[1:] != w[:-1])]))
        times = np.diff(np.append(head, len(s)))
        rest = np.bincount(s[head], (times * self.other) ** 2.0, n) if len(s) else np.zeros(n)
        s, c = segment[ours], col[ours]
        for at in range(0, n, 4096):
            lo, hi = np.searchsorted(s, [at, at + 4096])
            rows = min(4096, n - at)
            x = np.bincount((s[lo:hi] - at) * len(self.keys) + c[lo:hi], minlength=rows * len(self.keys)).reshape(rows, -1) * self.idf
            norm = np.sqrt((x**2).sum(axis=1) + rest[at : at + rows])
            cos = (x @ self.vectors.T) / np.maximum(norm, 1e-12)[:, None]
            which[at : at + rows] = cos.argmax(axis=1)
            best[at : at + rows] = cos.max(axis=1)
        return best, which


def line_frequencies(docs: DataFrame, templates: Templates) -> tuple[int, np.ndarray]:
    """Number of lines with words in all documents, and in how many each template word stands."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(templates.keys) + 1, np.int64)
        for whole in batches:
            for i in range(0, len(whole), 256):
                parts = Segments(byte_lists(whole.column("text").slice(i, 256)))
                total[-1] += int(parts.line.max(initial=-1)) + 1
                col = templates.columns(parts.words.hash)
                seen = np.unique(parts.line[col >= 0] * len(templates.keys) + col[col >= 0])
                total[:-1] += np.bincount(seen % len(templates.keys), minlength=len(templates.keys))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["word", "n"])

    sums = docs.select("text").mapInArrow(step, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(templates.keys) + 1, np.int64)
    for row in sums:  # one row a template word
        out[row["word"]] = row["n"]
    return int(out[-1]), out[:-1]


def own_license(docs: DataFrame, threshold: float = THRESHOLD, templates: tuple = TEMPLATES) -> DataFrame:
    """`docs` and own_license, own_score."""
    known = Templates(templates)
    known.weigh(*line_frequencies(docs, known))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), 256):
                batch = whole.slice(i, 256)
                parts = Segments(byte_lists(batch.column("text")))
                score, name = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
                texts, of_text = np.unique(parts.text, return_inverse=True)
                for segment in (parts.line, parts.paragraph, of_text):
                    if not len(segment):
                        continue
                    best, which = known.cosines(segment, parts.words.hash)
                    text = np.zeros(len(best), np.int64)
                    text[segment] = parts.text
                    order = np.lexsort((which, -best, text))
                    first = order[np.concatenate([[True], text[order][1:] != text[order][:-1]])]
                    t = text[first]
                    better = best[first] > score[t] + 1e-12
                    score[t[better]], name[t[better]] = best[first][better], which[first][better]
                own = [known.names[k] if s >= threshold else None for s, k in zip(score, name, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.string()), pa.array(np.round(score, 6))], names=[*batch.schema.names, "own_license", "own_score"])

    return with_results(docs, step, "own_license string, own_score double", "text")


def inherit(files: DataFrame) -> DataFrame:
    """`files` (path, own_license, own_score, ...) and license, origin (own, directory or none), origin_dir."""
    files = without(files, "license", "origin", "origin_dir")
    names = files.columns
    slim, others = aside(files, "path", "own_license", "own_score")
    files = cut(slim.withColumn("dir", directory("path")))  # three reads of it follow, and scoring is dear
    named = F.element_at(F.split("path", "/"), -1).isin(*FILE_NAMES)
    licensed = files.where(named & F.col("own_license").isNotNull()).groupBy("dir").agg(F.min(F.struct(-F.col("own_score"), "own_license")).alias("best"))
    licensed = licensed.select(F.col("dir").alias("up"), F.col("best.own_license").alias("given"))
    dirs = files.where("own_license is null and path is not null").select("dir").distinct()
    ups = dirs.select("dir", F.posexplode(ancestors("dir")).alias("depth", "up"))
    nearest = ups.join(licensed, "up").groupBy("dir").agg(F.max_by(F.struct("up", "given"), "depth").alias("n"))
    out = files.join(nearest, "dir", "left")
    own, back = F.col("own_license").isNotNull(), dict(zip(others, restored(others), strict=True))
    return out.select(
        *[back[c] if c in back else F.col(c) for c in names],
        F.coalesce("own_license", "n.given").alias("license"),
        F.when(own, "own").when(F.col("n").isNotNull() & F.col("path").isNotNull(), "directory").otherwise("none").alias("origin"),
        F.when(~own, F.col("n.up")).alias("origin_dir"),
    )


def directory(path: str) -> Column:
    """The directory of a path: "" for a name alone, "/" for a file at the root of an absolute path."""
    found = F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)
    return F.when((found == "") & F.col(path).startswith("/"), "/").otherwise(found)


def ancestors(dir: str) -> Column:
    """A directory's path from the root ("" for relative ones, "/" for absolute ones) down to itself."""
    parts = F.filter(F.split(dir, "/"), lambda p: p != "")
    down = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    absolute = F.col(dir).startswith("/")
    down = F.when(F.size(parts) > 0, F.transform(down, lambda d: F.concat(F.when(absolute, "/").otherwise(""), d))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(F.when(absolute, "/").otherwise("")), down)


def query(spark, sf_dir: str) -> DataFrame:
    """Documents as files thousand / hundred / ten / id.txt, where a number divisible by 10 is the licence
    file of its ten, by 100 of its hundred, and by 1000 of its thousand."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    parts = [F.expr(f"cast(doc_id div {n} as string)") for n in (1000, 100, 10)]
    depth = F.when(F.col("doc_id") % 1000 == 0, 1).when(F.col("doc_id") % 100 == 0, 2).otherwise(3)
    name = F.when(F.col("doc_id") % 10 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.when(F.col("doc_id").isNotNull(), F.array_join(F.concat(F.slice(F.array(*parts), F.lit(1), depth), F.array(name)), "/"))
    found = own_license(docs.select("doc_id", path.alias("path"), "text")).drop("text")
    return inherit(found).select("doc_id", "path", "own_license", "own_score", "license", "origin", "origin_dir")
