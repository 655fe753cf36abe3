"""License notices in documents: MinHash bands over overlapping windows, verified by exact shingle containment."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quire.llm import words
from quire.llm.decontamination import _bits, _filter_words, FILTER_BITS
from quire.llm.store import stored

#: Chance that a window which holds a template shares no band with it.
MISS = 1e-6

# Notices as licenses ask for them, and common short forms.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                "furnished to do so, subject to the following conditions:",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met:",
    "Apache-2.0-header": "Unless required by applicable law or agreed to in writing, software distributed under the "
                         "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
                         "KIND, either express or implied.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def layout(size: int) -> tuple[int, int]:
    """Shingles of a window and from one window to the next, for templates of 2 ** size to 2 ** (size + 1) - 1."""
    step = max(1, 2 ** size // 2)
    return 2 ** (size + 1) - 1 + step, step


def n_bands(size: int, percent: int) -> int:
    """Bands of one MinHash value each, so that a window that holds a template of the size shares one, but for MISS."""
    least, window = 2 ** size, layout(size)[0]
    shared = least * percent / 100
    return math.ceil(math.log(MISS) / math.log(1 - shared / (window + least - shared)))


def _least(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, count: int) -> np.ndarray:
    """`count` MinHash values of each range of hashes."""
    random = np.random.default_rng(7)
    masks = random.integers(0, 1 << 63, count, dtype=np.uint64)
    factors = random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sizes = ends - starts
    at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    own, first = words.mix(hashes[at]), np.cumsum(sizes) - sizes
    return np.stack([np.minimum.reduceat((own ^ m) * f, first) for m, f in zip(masks, factors)], axis=1)


def _positions(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the shingle of n words at each place, and where each row's places begin; none for shorter rows."""
    hashes, first = words.word_hashes(column, words.PUNCTUATION)
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    last = max(len(hashes) - n + 1, 0)
    total = np.zeros(last, np.uint64)
    for j in range(n):
        total += hashes[j:last + j] * words.PLACES[j]
    whole = rows[:last] == rows[len(rows) - last:]
    return words.mix(total[whole]), np.concatenate([[0], np.cumsum(np.maximum(counts - n + 1, 0))])


def _template_sets(batches, n_words: int, percent: int):
    """Templates with their shingle length, size class, distinct shingles and bands."""
    for batch in batches:
        for row in range(batch.num_rows):
            text = batch.column("text").slice(row, 1)
            count = len(words.word_hashes(text, words.PUNCTUATION)[0])
            if not count:
                continue
            n = min(n_words, count)
            hashes, _ = _positions(text, n)
            size = len(hashes).bit_length() - 1
            unique = np.unique(hashes)
            keys = _least(unique, np.array([0]), np.array([len(unique)]), n_bands(size, percent))[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("license").slice(row, 1), pa.array([n]), pa.array([size]), pa.array([len(unique)]),
                 pa.array([unique.view(np.int64).tolist()], pa.list_(pa.int64())),
                 pa.array([keys.view(np.int64).tolist()], pa.list_(pa.int64()))],
                ["license", "n", "size", "n_shingles", "hashes", "bands"])


def _windows(batches, kinds: list[tuple[int, int]], bitmap: np.ndarray, percent: int):
    """Windows with shingles that may be a template's: their bands, and those shingles with their places."""
    lengths = sorted({n for n, _ in kinds})
    for batch in words.portions(batches, "text"):
        for n in lengths:
            hashes, first = _positions(batch.column("text"), n)
            may = np.ones(len(hashes), bool)
            for at in _bits(hashes):
                may &= (bitmap[at >> 6] >> (at & 63)) & 1 == 1
            hits = np.flatnonzero(may)
            if not len(hits):
                continue
            row = np.searchsorted(first, hits, "right") - 1
            for size in [s for m, s in kinds if m == n]:
                width, step = layout(size)
                place = hits - first[row]
                # All windows over each hit.
                high = place // step
                low = np.maximum(-(-(place - width + 1) // step), 0)
                counts = high - low + 1
                no = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                of = np.repeat(np.arange(len(hits)), counts)
                key = row[of].astype(np.int64) << 40 | no
                order = np.argsort(key, kind="stable")
                key, of = key[order], of[order]
                heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                rows, starts = key[heads] >> 40, (key[heads] & ((1 << 40) - 1)) * step
                begin = first[rows] + starts
                bands = _least(hashes, begin, np.minimum(begin + width, first[rows + 1]), n_bands(size, percent))
                found = pa.StructArray.from_arrays(
                    [pa.array(hashes[hits[of]].view(np.int64)), pa.array(place[of])], ["hash", "place"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows)), batch.column("row").take(pa.array(rows)),
                     pa.array(np.full(len(rows), n)), pa.array(np.full(len(rows), size)), pa.array(starts),
                     pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).ravel()), bands.shape[1]).cast(
                         pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(pa.array(np.append(heads, len(of)).astype(np.int32)), found)],
                    ["doc_id", "row", "n", "size", "start", "bands", "hits"])


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def find_licenses(documents: DataFrame, templates: DataFrame, n_words: int = 5, percent: int = 80,
                  id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, license, n_shingles, n_shared, first_word, end_word): stretches of documents that hold a template.

    Shingles are n_words words with A-Z lower-cased, ended by ASCII white space or punctuation; a template of fewer
    words is one shingle. Templates are grouped by size; documents are cut into overlapping windows to fit each size,
    and a window that holds percent % of a template's distinct shingles shares a MinHash band with it, but for a
    chance of MISS. Such windows are verified exactly; those of one template that overlap in a document become one row
    with the most shingles that a window has, and from the first to behind the last word of them all.

    A fixed-size filter of the templates' shingles skips windows without any of them. Null and empty texts hold
    nothing, null and empty templates are nowhere. Ids may be null; rows with one id are reported together. Other
    columns are ignored.
    """
    sets = stored(templates.select("license", "text").filter("license IS NOT NULL AND text IS NOT NULL").mapInArrow(
        lambda batches: _template_sets(batches, n_words, percent),
        "license string, n long, size long, n_shingles long, hashes array<long>, bands array<long>"), "templates")
    filled = (sets.select("hashes").mapInArrow(_filter_words, "word long, bits long")
              .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    shared_bitmap = documents.sparkSession.sparkContext.broadcast(bitmap)
    # At most n_words shingle lengths and some twenty sizes.
    kinds = sorted((row.n, row.size) for row in sets.select("n", "size").distinct().collect())

    docs = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    doc_type = dict(docs.dtypes)["doc_id"]
    windows = stored(docs.withColumn("row", F.xxhash64("doc_id", "text")).mapInArrow(
        lambda batches: _windows(batches, kinds, shared_bitmap.value, percent),
        f"doc_id {doc_type}, row long, n long, size long, start long, bands array<long>, "
        "hits array<struct<hash: long, place: long>>"), "windows")
    banded = ["n", "size", "band", "least"]
    index = sets.select("license", "n", "size", F.posexplode("bands").alias("band", "least"))
    candidates = (windows.select("row", "start", "n", "size", F.posexplode("bands").alias("band", "least"))
                  .join(index, banded).select("row", "start", "n", "size", "license").distinct())
    own = F.filter("hits", lambda hit: F.array_contains("hashes", hit["hash"]))
    verified = (candidates.join(windows.drop("bands").dropDuplicates(["row", "start", "n", "size"]),
                                ["row", "start", "n", "size"])
                .join(sets.select("license", "n_shingles", "hashes"), "license").withColumn("own", own)
                .withColumn("n_shared", F.size(F.array_distinct(F.transform("own", lambda hit: hit["hash"]))))
                .filter(100 * F.col("n_shared") >= percent * F.col("n_shingles"))
                .select("doc_id", "license", "n_shingles", F.col("n_shared").cast("long"),
                        F.array_min(F.transform("own", lambda hit: hit["place"])).alias("first_word"),
                        (F.array_max(F.transform("own", lambda hit: hit["place"])) + F.col("n")).alias("end_word")))
    by_doc = Window.partitionBy("doc_id", "license").orderBy("first_word", "end_word")
    reached = F.max("end_word").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    return (verified.withColumn("new", F.coalesce((F.col("first_word") >= reached).cast("int"), F.lit(1)))
            .withColumn("stretch", F.sum("new").over(by_doc))
            .groupBy("doc_id", "license", "stretch").agg(
                F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"),
                F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word")).drop("stretch"))
