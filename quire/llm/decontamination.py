"""Test items inside documents: size-partitioned MinHash containment search, verified on exact shingles."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm import words
from quire.llm.store import stored

#: A document of up to 2 ** c shingles has 2 ** (c + SPREAD) MinHash bins, so that short items show at every size.
SPREAD = 2
#: Chance that one shingle of a document is the least of its bin, at least (bins are at most 1 / 2 ** SPREAD full).
LEAST = (1 - math.exp(-1 / 2 ** SPREAD)) * 2 ** SPREAD
#: Chance that the sketch misses an item that is contained.
MISS = 1e-6
#: Items with fewer shingles are looked for among all shingles of a document.
SMALL = 8
#: Bits of the filter that skips shingles of no item: a fixed 1 MB however many items there are.
FILTER_BITS = 23
_KEPT = 64 - words.ROW_BITS


def needed(n: int, percent: int) -> int:
    """Bin minima that a contained item of n shingles shares with a document, but for a chance of MISS."""
    trials = math.ceil(n * percent / 100)
    tail = 0.0
    for k in range(trials + 1):
        tail += math.comb(trials, k) * LEAST ** k * (1 - LEAST) ** (trials - k)
        if tail > MISS:
            return max(k, 1)
    return trials


def _runs(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of n words, for rows that have so many."""
    found, rows = words.shingles(hashes, first, n)
    whole = np.diff(first)[rows] >= n
    return found[whole], rows[whole]


def _item_sets(batches, n_words: int, percent: int):
    for batch in words.portions(batches, "text"):
        each, at = words.word_hashes(batch.column("text"), words.PUNCTUATION)
        lengths = np.minimum(np.diff(at), n_words)
        kept = []
        for length in np.unique(lengths[lengths > 0]):
            found, rows = _runs(each, at, int(length))
            mine = lengths[rows] == length
            kept.append((found[mine], rows[mine]))
        hashes, first = words.distinct(*(np.concatenate(part) for part in zip(*kept)), len(lengths)) if kept else (
            np.empty(0, np.uint64), np.zeros(len(lengths) + 1, np.int64))
        need = [needed(int(n), percent) if n else 0 for n in np.diff(first)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(lengths, pa.int64()), pa.array(np.diff(first)), pa.array(need, pa.int64()),
             pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))],
            ["item_id", "length", "n", "need", "hashes"])


def _bits(hashes: np.ndarray) -> list[np.ndarray]:
    """Three places of each hash in the filter."""
    mixed = words.mix(hashes.copy())
    return [((mixed >> np.uint64(k * 21)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            if k < 2 else (mixed >> np.uint64(64 - FILTER_BITS)).astype(np.int64) for k in range(3)]


def _filter_words(batches):
    """(word, bits) of the filter for lists of hashes."""
    for batch in batches:
        at = np.unique(np.concatenate(_bits(batch.column("hashes").flatten().to_numpy().view(np.uint64))))
        yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], ["word", "bits"])


def _hits(batches, n_words: int, short: list[int], bitmap: np.ndarray):
    """Rows with shingles that may be an item's: those shingles, and which are MinHash minima at the row's size.
    Runs of the `short` numbers of words are among the former only."""
    def may_be(hashes):
        may = np.ones(len(hashes), bool)
        for at in _bits(hashes):
            may &= (bitmap[at >> 6] >> (at & 63)) & 1 == 1
        return may

    for batch in words.portions(batches, "text"):
        each, word_first = words.word_hashes(batch.column("text"), words.PUNCTUATION)
        hashes, first = words.distinct(*words.shingles(each, word_first, n_words), len(batch))
        sizes = np.diff(first)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        classes = np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64) + SPREAD
        # Hashes are sorted within a row: the first of each bin is its minimum.
        bins = hashes >> (64 - classes[rows]).astype(np.uint64)
        least = np.ones(len(hashes), bool)
        least[1:] = (bins[1:] != bins[:-1]) | (rows[1:] != rows[:-1])
        may = may_be(hashes)
        minima = hashes[may & least], rows[may & least]
        found = [(hashes[may], rows[may])]
        for length in short:
            runs, starts = words.distinct(*_runs(each, word_first, length), len(batch))
            may = may_be(runs)
            found.append((runs[may], np.repeat(np.arange(len(batch)), np.diff(starts))[may]))
        found = [np.concatenate(part) for part in zip(*found)]
        by_row = np.argsort(found[1], kind="stable")
        found = found[0][by_row], found[1][by_row]
        some = np.unique(found[1])
        if len(some):
            lists = [pa.ListArray.from_arrays(
                pa.array(np.append(np.searchsorted(rows_of, some), len(rows_of)).astype(np.int32)),
                pa.array(kept.view(np.int64))) for kept, rows_of in (found, minima)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(some)) for c in ("doc_id", "row")), *lists],
                ["doc_id", "row", "hits", "minima"])


def contained_items(documents: DataFrame, items: DataFrame, n_words: int = 5, percent: int = 80,
                    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
                    item_text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared) where 100 * n_shared >= percent * n_item_shingles.

    Shingles are n_words words with A-Z lower-cased; words end at ASCII white space or punctuation. An item of fewer
    words is one shingle, which is looked for among all runs of as many words of every document. A document's
    sketch has a number of bins that grows with its size class, and holds the least shingle of each bin. Items whose
    shingles turn up among enough minima are candidates (a contained item is missed with chance MISS; items under
    SMALL shingles are looked up among all shingles), and candidates are verified on the full sets.

    A fixed-size filter of the items' shingles decides which shingles leave the scan, so a document without any of
    them sends nothing. Null or empty items and documents match nothing. A null doc_id or item_id is reported as null.
    Repeated pairs are one row, with the largest n_shared.
    """
    texts = items.filter(F.col(item_text_column).isNotNull()).select(
        F.col(item_column).alias("item_id"), F.col(item_text_column).alias("text")).distinct()
    item_type = dict(texts.dtypes)["item_id"]
    sets = stored(texts.mapInArrow(lambda batches: _item_sets(batches, n_words, percent),
                                   f"item_id {item_type}, length long, n long, need long, hashes array<long>").filter("n > 0")
                  .withColumn("item", F.xxhash64("item_id", "hashes")), "items")
    # At most n_words - 1 numbers.
    short = sorted(row.length for row in sets.select("length").filter(F.col("length") < n_words).distinct().collect())
    filled = (sets.select("hashes").mapInArrow(_filter_words, "word long, bits long")
              .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    shared_bitmap = documents.sparkSession.sparkContext.broadcast(bitmap)

    docs = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    doc_type = dict(docs.dtypes)["doc_id"]
    hits = stored(docs.withColumn("row", F.xxhash64("doc_id", "text")).mapInArrow(
        lambda batches: _hits(batches, n_words, short, shared_bitmap.value),
        f"doc_id {doc_type}, row long, hits array<long>, minima array<long>"), "hits")
    index = sets.select("item", "n", "need", F.explode("hashes").alias("hash"))
    large, small = index.filter(F.col("n") >= SMALL), index.filter(F.col("n") < SMALL)
    by_sketch = (hits.select("row", F.explode("minima").alias("hash")).distinct().join(large, "hash")
                 .groupBy("row", "item").agg(F.count("*").alias("found"), F.first("need").alias("need"))
                 .filter("found >= need").select("row", "item"))
    by_all = hits.select("row", F.explode("hits").alias("hash")).join(small, "hash").select("row", "item").distinct()
    shared = F.size(F.array_intersect("hits", "hashes"))
    return (by_sketch.union(by_all).join(hits.select("row", "doc_id", "hits"), "row")
            .join(sets.select("item", "item_id", "n", "hashes"), "item")
            .select("doc_id", "item_id", F.col("n").alias("n_item_shingles"), shared.cast("long").alias("n_shared"))
            .filter(100 * F.col("n_shared") >= percent * F.col("n_item_shingles"))
            .groupBy("doc_id", "item_id").agg(F.max("n_item_shingles").alias("n_item_shingles"),
                                              F.max("n_shared").alias("n_shared")))
