"""Removal of repeated byte strings: suffixes are sorted by most significant digits, to the depth of a threshold only.

Two bytes strings of `THRESHOLD` bytes are equal if and only if they fall into one group after all digits, and a group
of one at any digit is finished and leaves. So that not every suffix becomes a row, suffixes travel in runs:

digit 1: the least of the hashed GRAM-byte strings inside a suffix's first THRESHOLD bytes. Neighbouring suffixes share
         it, and equal ones have it at the same offset; a run is a maximal row of suffixes with the same occurrence.
digit 2: all bytes that a run's suffixes cover, and the offset. Runs in a group are repeated as a whole.
digit 3: what is left (runs at the ends of repeated passages, in groups of several contents) is sorted by the
         THRESHOLD bytes of each single suffix.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm import words
from quire.llm.store import stored

THRESHOLD = 200
GRAM = 32
#: Offsets of suffixes that travel together in the last digit.
BLOCK = 13
_PORTION = 1 << 18


def _least_grams(grams: np.ndarray, span: int) -> np.ndarray:
    """For each start, the place of the least gram among `span` neighbours, the first of equals."""
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    rest = span - width
    keys = np.minimum(keys[:len(keys) - rest], keys[rest:])
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _runs(batches, threshold: int):
    """Runs of suffixes: digits 1 and 2, and the place (start in the text, offset of the gram, suffixes less one)."""
    for batch in words.portions(batches, "text", _PORTION):
        data, offsets = words.text_bytes(batch.column("text"))
        if len(data) < threshold:
            continue
        sums = words.prefix_sums(data, words.PLAIN)
        at = np.arange(len(data) - GRAM + 1)
        grams = words.range_hashes(sums, at, at + GRAM)
        rows = np.repeat(np.arange(len(batch), dtype=np.int32), np.diff(offsets))
        starts = np.flatnonzero(rows[:len(data) - threshold + 1] == rows[threshold - 1:])
        if not len(starts):
            continue
        anchors = _least_grams(grams, threshold - GRAM + 1)[starts]
        rows = rows[starts]
        begins = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])]))
        first, last = starts[begins], starts[np.append(begins[1:], len(starts)) - 1]
        anchors, rows = anchors[begins], rows[begins]
        lead = anchors - first
        whole = words.range_hashes(sums, first, last + threshold) + lead.astype(np.uint64) * words.PLACES[0]
        place = (first - offsets[rows]) << 16 | lead << 8 | (last - first)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams[anchors].view(np.int64)), pa.array(words.mix(whole).view(np.int64)),
             batch.column("row").take(pa.array(rows)), pa.array(place)], ["gram", "whole", "row", "place"])


def _contents(batches, threshold: int):
    """The bytes that the listed runs cover."""
    for batch in words.portions(batches, "text", _PORTION):
        data, offsets = words.text_bytes(batch.column("text"))
        runs = batch.column("runs")
        flat, counts = runs.flatten(), np.diff(runs.offsets.to_numpy())
        rows = np.repeat(np.arange(len(batch)), counts)
        place = flat.field("place").to_numpy()
        first = offsets[rows] + (place >> 16)
        sizes = (place & 255) + threshold
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)
        content = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)),
                                            pa.py_buffer(data[at])]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [flat.field("gram"), batch.column("row").take(pa.array(rows)), flat.field("place"), content],
            ["gram", "row", "place", "content"])


def _stretches(rows: np.ndarray, starts: np.ndarray, threshold: int):
    """Row, start and end of maximal stretches of neighbouring suffixes."""
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)])
    begins = np.flatnonzero(new)
    return rows[begins], starts[begins], starts[np.append(begins[1:], len(starts)) - 1] + threshold


def _single_suffixes(batches, threshold: int):
    """Digit 3, over runs sorted by gram.

    Groups that lie inside a batch are settled at once: start to end is repeated, `core` is null. The first and last
    gram of a batch may go on in another. Suffixes repeated in the batch are settled there too, and one of each kind
    is passed on to be compared with those of other batches, up to BLOCK neighbouring ones in a row, together with the
    hash of the bytes that all suffixes with such offsets share.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = words.text_bytes(batch.column("content").cast(pa.large_binary()).view(pa.large_string()))
        sums = words.prefix_sums(data, words.PLAIN)
        place = batch.column("place").to_numpy()
        gram = batch.column("gram").to_numpy()
        sizes = np.diff(offsets) - threshold + 1
        runs = np.repeat(np.arange(len(sizes)), sizes)
        within = np.arange(len(runs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = offsets[runs] + within
        window = words.range_hashes(sums, at, at + threshold)
        key = words.mix(window + gram.view(np.uint64)[runs] * words.PLACES[1])
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        head = np.zeros(len(key), bool)
        head[order] = np.concatenate([[True], ~same])
        row = batch.column("row").to_numpy()
        start = (place >> 16)[runs] + within
        if twice.any():
            done = _stretches(row[runs[twice]], start[twice], threshold)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in done), *[pa.nulls(len(done[0]), pa.int64())] * 2,
                 pa.nulls(len(done[0]), pa.list_(pa.int64()))], ["row", "start", "end", "gram", "core", "windows"])
        open_ = np.flatnonzero(((gram == gram[0]) | (gram == gram[-1]))[runs] & head)
        if len(open_):
            lead = ((place >> 8) & 255)[runs[open_]] - within[open_]
            block = lead // BLOCK
            new = np.ones(len(open_), bool)
            new[1:] = ((runs[open_][1:] != runs[open_][:-1]) | (block[1:] != block[:-1])
                       | (within[open_][1:] != within[open_][:-1] + 1))
            heads = np.flatnonzero(new)
            first = open_[heads]
            # All windows of the block hold the bytes from the anchor less BLOCK * block on, BLOCK - 1 fewer than a window.
            core = at[first] + lead[heads] - BLOCK * block[heads]
            hashes = words.range_hashes(sums, core, core + threshold - BLOCK + 1) + block[heads].astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[runs[first]]), pa.array(start[first]), pa.nulls(len(first), pa.int64()),
                 pa.array(gram[runs[first]]), pa.array(words.mix(hashes).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.append(heads, len(open_)).astype(np.int32)),
                                          pa.array(window[open_].view(np.int64)))],
                ["row", "start", "end", "gram", "core", "windows"])


def _without(batches):
    """Lengths, removed bytes and maximal removed runs of each text, and the SHA-256 of what stays."""
    for batch in words.portions(batches, "text", _PORTION):
        data, offsets = words.text_bytes(batch.column("text"))
        spans = batch.column("spans")
        sizes = np.diff(offsets)
        removed, n_spans, digests, texts = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), [], []
        whole = data.tobytes()
        for k, found in enumerate(spans):
            text = whole[offsets[k]:offsets[k + 1]]
            if found.is_valid and len(found.values):
                starts = found.values.field("start").to_numpy()
                ends = found.values.field("end").to_numpy()
                order = np.argsort(starts, kind="stable")
                starts, ends = starts[order], np.maximum.accumulate(ends[order])
                new = np.concatenate([[True], starts[1:] > ends[:-1]])
                begins = np.flatnonzero(new)
                starts, ends = starts[begins], ends[np.append(begins[1:], len(ends)) - 1]
                removed[k], n_spans[k] = (ends - starts).sum(), len(starts)
                text = b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)]))
            digests.append(hashlib.sha256(text).hexdigest())
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.array(removed), pa.array(n_spans), pa.array(digests),
             pa.array(texts, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_spans(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(row, start, end) in bytes: stretches covered by `threshold`-byte strings that also start elsewhere.

    `documents` has row (long, a name of the document's content and id) and text. Stretches may overlap. The suffixes
    of rows with one and the same name and text count as repeated in each other.
    """
    if not GRAM < threshold <= GRAM + 255:
        raise ValueError(f"threshold must be over {GRAM} and at most {GRAM + 255} bytes")
    texts = documents.select("row", "text")
    runs = texts.mapInArrow(lambda batches: _runs(batches, threshold), "gram long, whole long, row long, place long")
    shared = stored(runs.groupBy("gram").agg(F.count("*").alias("n"), F.min("whole").alias("low"),
                                             F.max("whole").alias("high"))
                    .filter("n > 1").select("gram", F.expr("low <> high").alias("several")), "grams")
    found = stored(runs.join(shared, "gram"), "runs")
    several = found.filter("several").drop("several")
    contents = several.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min("row").alias("first_row"))
    several = stored(several.join(contents, ["gram", "whole"])
                     .select("gram", "row", "place", "n", (F.col("row") == F.col("first_row")).alias("first")),
                     "several")
    listed = several.filter("n = 1 OR first").groupBy("row").agg(F.collect_list(F.struct("gram", "place")).alias("runs"))
    left = stored(texts.join(listed, "row").mapInArrow(
        lambda batches: _contents(batches, threshold), "gram long, row long, place long, content binary"), "contents")
    single = stored(left.repartitionByRange("gram", "row").sortWithinPartitions("gram", "row").mapInArrow(
        lambda batches: _single_suffixes(batches, threshold),
        "row long, start long, end long, gram long, core long, windows array<long>"), "suffixes")
    passed = single.filter("core IS NOT NULL").drop("end")
    cores = passed.groupBy("gram", "core").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    passed = (passed.join(cores, ["gram", "core"], "left_semi")
              .select("row", "start", "gram", F.posexplode("windows").alias("nth", "window"))
              .select("row", "gram", "window", (F.col("start") + F.col("nth")).alias("start")))
    twice = passed.groupBy("gram", "window").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    later = passed.join(twice, ["gram", "window"], "left_semi").withColumn("end", F.col("start") + threshold)
    whole = found.filter("NOT several").select("row", "place").union(several.filter("n > 1").select("row", "place"))
    start = F.shiftright("place", 16)
    return (whole.select("row", start.alias("start"),
                         (start + F.col("place").bitwiseAND(255) + threshold).alias("end"))
            .union(single.filter("core IS NULL").select("row", "start", "end"))
            .union(later.select("row", "start", "end")))


def remove_repeats(documents: DataFrame, threshold: int = THRESHOLD, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept, the remaining bytes.

    Every byte goes that is covered by a `threshold`-byte string which also starts anywhere else, in this document or
    another; strings do not cross documents. Null and empty texts, and those under the threshold, lose nothing.
    Rows that are copies of each other, ids included, are each a document. Ids may be null; other columns are ignored.
    Equality is decided by 64-bit hashes within groups of equal 64-bit hashes.
    """
    docs = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).withColumn(
        "row", F.xxhash64("doc_id", "text"))
    # Copies of one row have the same name and find the same spans: each is listed once. Written before the join, so that
    # Spark may split the copies.
    spans = stored(repeated_spans(docs, threshold).groupBy("row").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    doc_type = dict(docs.dtypes)["doc_id"]
    return docs.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(
        _without, f"doc_id {doc_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
