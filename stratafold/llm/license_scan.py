"""License scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a text and the text as a whole are compared with each template;
weights are sqrt(tf) * idf with document frequencies over all files. Words outside
the templates count in a line's norm with the weight of an unseen word, so one
bound on the cosine leaves few lines to compare. A file without a match of its own
takes the licence of the nearest directory above it that holds a licence file.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.decontamination import Lookup, document_frequencies, plain_lowered
from stratafold.llm.shared import Stages, column, small_batches, sorted_join
from stratafold.llm.words import word_hashes

# Short notices of common licences and the first words of their texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Licensed directories of so many bytes at most are broadcast; a row has some 64 beside its path.
BROADCAST_BYTES = 4 << 20
ROW_BYTES = 64
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z0-9]+)?$"


@dataclass(frozen=True)
class LicenseRule:
    """``cosine`` from which a line matches; a matched line of at least ``file_share`` of a file's
    words, or a telling name, makes the file one that stands for its directory."""

    cosine: float = 0.75
    file_share: float = 0.2
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    tables: int = 1 << 16


@dataclass(frozen=True)
class Matcher:
    """Template rows of norm one over the known words, and the weights."""

    lookup: Lookup
    idf: np.ndarray
    unknown: float
    names: list[str]
    rows: np.ndarray
    cosine: float

    def best(self, data: bytes) -> tuple[str, float, int, int] | None:
        """(licence, cosine, words of the matched line, words of the text) of a lower-cased text's best line."""
        hashes, starts, _ = word_hashes(data)
        if not len(hashes):
            return None
        known = self.lookup.rows(hashes)
        inside = known >= 0
        square = np.where(inside, self.idf[np.where(inside, known, 0)] ** 2, 0.0)
        whole = np.where(inside, square, self.unknown**2)
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        line = np.searchsorted(ends, starts)
        heads = np.flatnonzero(np.diff(line, prepend=-1))
        tails = np.append(heads[1:], len(hashes))
        spans = list(zip(heads.tolist(), tails.tolist()))
        inner, total = np.add.reduceat(square, heads), np.add.reduceat(whole, heads)
        possible = [spans[i] for i in np.flatnonzero(inner >= self.cosine**2 * total)]
        if len(spans) > 1 and inner.sum() >= self.cosine**2 * total.sum():
            possible.append((0, len(hashes)))
        found = None
        for begin, end in possible:
            here = known[begin:end]
            words, tf = np.unique(here[here >= 0], return_counts=True)
            scores = self.rows[:, words] @ (np.sqrt(tf) * self.idf[words]) / math.sqrt(whole[begin:end].sum())
            at = int(scores.argmax())
            if scores[at] >= self.cosine and (found is None or scores[at] > found[1] + 1e-12):
                found = (self.names[at], float(scores[at]), end - begin, len(hashes))
        return found


def fit(files: DataFrame, rule: LicenseRule) -> Matcher:
    """Weights from all files; templates are a bounded list."""
    words = [word_hashes(text.lower().encode())[0] for _, text in rule.templates]
    lookup = Lookup(np.unique(np.concatenate(words)), rule.tables)
    seen, total = document_frequencies(files, lookup.known, rule)
    idf = np.log((1 + total) / (1 + seen)) + 0.1
    rows = np.zeros((len(words), len(lookup.known)))
    for i, own in enumerate(words):
        known, tf = np.unique(lookup.rows(own), return_counts=True)
        weights = np.sqrt(tf) * idf[known]
        rows[i, known] = weights / np.sqrt((weights**2).sum())
    return Matcher(lookup, idf, math.log(1 + total) + 0.1, [n for n, _ in rule.templates], rows, rule.cosine)


def own_licenses(files: DataFrame, rule: LicenseRule) -> DataFrame:
    """(file_id, path, license, cosine, share) of every file; nulls where nothing matches."""
    spark = files.sparkSession
    matcher = spark.sparkContext.broadcast(fit(files, rule))
    small_batches(spark)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [matcher.value.best(t) for t in column(batch, "text")]
            arrays = [
                batch.column("file_id"),
                batch.column("path"),
                pa.array([h and h[0] for h in hits], pa.string()),
                pa.array([h and h[1] for h in hits], pa.float64()),
                pa.array([h and h[2] / h[3] for h in hits], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["file_id", "path", "license", "cosine", "share"])

    schema = "file_id long, path string, license string, cosine double, share double"
    return files.select("file_id", "path", plain_lowered(F.col("text")).alias("text")).mapInArrow(matched, schema)


def parent(path: Column) -> Column:
    """The directory of a path, empty at the top; null for a null path."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, rule: LicenseRule | None = None) -> DataFrame:
    """file_id, path, license, cosine, origin and license_dir of every file.

    ``origin`` is own, inherited or none. Of several licence files in a directory the
    one with the greatest cosine stands for it, then the least licence name. A file's
    own match goes first. Null texts match nothing; files without a path inherit
    nothing; repeated rows are judged alike; an empty table gives no rows. A
    directory's licence is found once per directory, by a join over its ancestors,
    before files join their directory.
    """
    rule = rule or LicenseRule()
    stages = Stages(files.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    files = files.select(F.col("file_id").cast("long").alias("file_id"), F.regexp_replace("path", "^/+|/+$", "").alias("path"), text)
    own = stages.write(own_licenses(files, rule).withColumn("dir", parent(F.col("path"))), "licenses")

    telling = (F.col("share") >= rule.file_share) | F.regexp_like("path", F.lit(FILE_NAMES))
    stands = own.where(F.col("license").isNotNull() & F.col("dir").isNotNull() & telling)
    stands = stands.groupBy(F.col("dir").alias("above")).agg(F.min(F.struct((-F.col("cosine")).alias("cosine"), "license")).alias("best"))
    stands = stages.write(stands, "stands")
    size = stands.agg(F.sum(F.octet_length("above") + ROW_BYTES)).first()[0] or 0
    steps = F.split("dir", "/")
    climb = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    dirs = own.where("dir IS NOT NULL").select("dir").distinct()
    ancestors = dirs.select("dir", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), climb))).alias("above"))
    # the ancestors of all directories are the larger side, though Spark takes them to be as few as the directories
    met = ancestors.join(F.broadcast(stands), "above") if size <= BROADCAST_BYTES else sorted_join(ancestors).join(stands, "above")
    nearest = met.groupBy("dir")
    nearest = nearest.agg(F.max_by(F.struct(F.col("above").alias("license_dir"), F.col("best.license").alias("given")), F.length("above")).alias("near"))
    joined = own.join(nearest, "dir", "left")
    has = F.col("license").isNotNull()
    return joined.select(
        "file_id",
        "path",
        F.coalesce("license", "near.given").alias("license"),
        "cosine",
        F.when(has, "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~has, F.col("near.license_dir")).alias("license_dir"),
    )


def documents_as_files(docs: DataFrame) -> DataFrame:
    """Documents in a tree of directories: the source, then the digits of the id.

    Document 425 of src1 is src1/4/2/5, and src1/4/2 a directory of it as well as a file.
    """
    digits = F.array_join(F.split(F.abs(F.col("doc_id")).cast("string"), ""), "/")
    path = F.concat(F.coalesce("source", F.lit("unknown")), F.lit("/"), digits)
    return docs.select(F.col("doc_id").cast("long").alias("file_id"), path.alias("path"), "text")
