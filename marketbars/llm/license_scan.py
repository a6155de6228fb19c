"""License scan: sparse TF-IDF cosine to templates, then directory inheritance.

Every line of a file that mentions licensing is a header candidate; a licence
file (by its name) is a candidate as a whole too. Candidates and templates become
TF-IDF vectors over the templates' words: term counts times
``log((1 + N) / (1 + df)) + 1``, with df counted over all candidates of all files.
A file's own licence is the template of the highest cosine, if that reaches the
threshold. Words outside the templates count in a candidate's length, so long
prose that mentions a licence scores low. Their df is counted too with ``all_words``,
as the registered query has it, so that weights follow the words' shares of the
candidates; without, it is taken as 0, and their weight grows with N.

A file without a licence of its own inherits from the nearest directory above it
(its own first) whose licence file has one: distinct directories are expanded
into their ancestors, joined to the directories' licences on the path, and the
deepest match is joined back to the files.

Defined cases: null and empty texts have no candidates; a null path has no
directory and inherits nothing; equal scores go to the template listed first; of
several licence files of a directory the highest score counts, then the smallest
path; repeated rows are separate files; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import (LOWER_BYTES, alnum_words, ascii_lower, binary_rows,
                                   record_batches, stage)

THRESHOLD = 0.55
LICENSE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"

# fixed values: the short notices of the licences looked for
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without "
            "restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)
MENTIONS = (b"licen", b"copyright", b"spdx", b"redistribut", b"permission is", b"warrant",
            b"public domain", b"creative commons", b"cc by", b"cc0")

_CANDIDATES = "file long, text string"


def directory(path: Column) -> Column:
    """Up to the last ``/``, which it ends with; the empty string at the top."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 1)


def is_license_file(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)([^/]*)$", 1).rlike(LICENSE_NAMES)


def candidates(text: bytes, whole: bool) -> Iterator[bytes]:
    """The lines that mention licensing; and the text, if it has one and ``whole``."""
    lower = text.translate(LOWER_BYTES)
    if any(m in lower for m in MENTIONS):
        for line, low in zip(text.split(b"\n"), lower.split(b"\n")):
            if any(m in low for m in MENTIONS):
                yield line
        if whole and b"\n" in text:
            yield text


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("id", pa.int64()), ("text", pa.string())])

    def rows():
        for batch in batches:
            for path, key, whole, text in zip(batch.column(0).to_pylist(),
                                              batch.column(1).to_pylist(),
                                              batch.column(2).to_pylist(),
                                              binary_rows(batch, "text")):
                for found in candidates(text or b"", bool(whole)):
                    yield path, key, found.decode()
    yield from record_batches(rows(), schema, 2_000)


class Scorer:
    """Cosines to the templates, with idf from the candidates' counts; the square
    length of a candidate's words that no template has is given."""

    def __init__(self, templates, total: int, df: dict[str, int]):
        self.idf = lambda w: log((1 + total) / (1 + df.get(w, 0))) + 1
        self.names = [name for name, _ in templates]
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, (_, text) in enumerate(templates):
            weights = self._weights(Counter(words_of(text.encode())))
            norm = sqrt(sum(x * x for x in weights.values()))
            for word, x in weights.items():
                self.postings.setdefault(word, []).append((i, x / norm))

    def _weights(self, counts: Counter) -> dict[str, float]:
        return {w: c * self.idf(w) for w, c in counts.items()}

    def others(self, text: bytes) -> dict[str, int]:
        """The words that no template has, with their counts."""
        return {w: c for w, c in Counter(words_of(text)).items() if w not in self.postings}

    def best(self, text: bytes, others: float) -> tuple[str, float]:
        scores = [0.0] * len(self.names)
        square = others
        for word, c in Counter(words_of(text)).items():
            if word in self.postings:
                x = c * self.idf(word)
                square += x * x
                for i, y in self.postings[word]:
                    scores[i] += x * y
        # rounded: equal texts score equally, however their terms were added up
        found = [round(s / sqrt(square), 12) if square else 0.0 for s in scores]
        top = max(range(len(found)), key=lambda i: (found[i], -i))
        return self.names[top], found[top]

    def at_most(self, text: bytes) -> float:
        """No less than the best score: no word weighs less than 1."""
        return self.best(text, float(sum(c * c for c in self.others(text).values())))[1]


def words_of(text: bytes) -> list[str]:
    return [w.decode() for w in alnum_words(text)]


def own_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
                 all_words: bool = False) -> DataFrame:
    """(path, id, license, score): each file's best candidate that reaches the
    threshold; ``files(path, id, text)``.

    The words of all candidates stay on Spark: only the templates' words are
    collected, and only the other words of candidates that can still reach the
    threshold are joined to their counts."""
    spark = files.sparkSession
    found = stage(files.select("path", F.col("id").cast("long"),
                               F.coalesce(is_license_file(F.col("path")), F.lit(False))
                               .alias("whole"), F.col("text"))
                  .mapInArrow(_find, "path string, id long, text string")
                  .withColumn("c", F.monotonically_increasing_id()), "license-lines")
    vocabulary = sorted({w for _, t in templates for w in words_of(t.encode())})
    words = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")),
                                                  F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"),
                                                  F.lit(1)))
    counts = found.select(F.explode(words).alias("w"))
    if not all_words:
        counts = counts.where(F.col("w").isin(vocabulary))
    counts = stage(counts.groupBy("w").agg(F.count(F.lit(1)).alias("df")), "license-words")
    total = found.count()
    known = counts.where(F.col("w").isin(vocabulary)).collect()         # the templates' words
    scorer = spark.sparkContext.broadcast((templates, total, {row.w: row.df for row in known}))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*scorer.value)
        for batch in batches:
            yield batch.filter(pa.array([own.at_most(t) >= threshold - 1e-9
                                         for t in binary_rows(batch, "text")], pa.bool_()))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*scorer.value)
        schema = pa.schema([("c", pa.int64()), ("w", pa.string()), ("n", pa.int64())])
        yield from record_batches(((c, w, n) for batch in batches
                                   for c, t in zip(batch.column(0).to_pylist(),
                                                   binary_rows(batch, "text"))
                                   for w, n in own.others(t).items()), schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*scorer.value)
        for batch in batches:
            best = [own.best(t, x) for t, x in zip(binary_rows(batch, "text"),
                                                   batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([b[0] for b in best], pa.string()),
                 pa.array([b[1] for b in best], pa.float64())],
                names=["path", "id", "license", "score"])
    kept = stage(found.mapInArrow(near, found.schema), "license-near")
    weight = F.col("n") * (F.log((1 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1)
    square = (kept.select("c", "text").mapInArrow(others, "c long, w string, n long")
              .join(counts, "w", "left").groupBy("c").agg(F.sum(weight * weight).alias("others")))
    return (kept.join(square, "c", "left")
            .select("path", "id", "text", F.coalesce("others", F.lit(0.0)).alias("others"))
            .mapInArrow(score, "path string, id long, license string, score double")
            .where(F.col("score") >= threshold).groupBy("path", "id")
            .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
            .select("path", "id", F.col("b.license").alias("license"),
                    (-F.col("b.s")).alias("score")))


def nearest_directories(dirs: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, license, from_dir): the nearest of ``licensed(dir, license)`` at or
    above each of ``dirs(dir)``."""
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.when(
        k > 0, F.concat(F.array_join(F.slice(parts, F.lit(1), F.greatest(k, F.lit(1))), "/"),
                        F.lit("/"))).otherwise(F.lit("")))
    return (dirs.select("dir").distinct()
            .select("dir", F.posexplode(above).alias("depth", "from_dir"))
            .join(licensed.withColumnRenamed("dir", "from_dir"), "from_dir")
            .groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "license")).alias("n"))
            .select("dir", F.col("n.license").alias("license"),
                    F.col("n.from_dir").alias("from_dir")))


def scan_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
                  all_words: bool = False) -> DataFrame:
    """One row per file: id, path, own (licence or null), score, license (own, else
    inherited, else null), from_dir (where it is inherited from)."""
    own = stage(own_licenses(files, templates, threshold, all_words), "own-licenses")
    licensed = (own.where(is_license_file(F.col("path")))
                .groupBy(directory(F.col("path")).alias("dir"))
                .agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("b"))
                .select("dir", F.col("b.license").alias("license")))
    named = files.select("id", "path", directory(F.col("path")).alias("dir"))
    near = nearest_directories(named.where("dir is not null"), licensed)
    return (named.alias("f")
            .join(own.alias("o"), F.expr("f.path <=> o.path and f.id <=> o.id"), "left")
            .join(near.alias("n"), F.expr("f.dir = n.dir"), "left")
            .select("f.id", "f.path", F.col("o.license").alias("own"), "o.score",
                    F.coalesce("o.license", "n.license").alias("license"),
                    F.when(F.col("o.license").isNull(), F.col("n.from_dir")).alias("from_dir")))
