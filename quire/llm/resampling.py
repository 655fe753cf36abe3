"""Importance resampling of documents towards a target text, by hashed runs of one to three words.

Features are counted into a fixed number of buckets, over all documents and over the target. A bucket's gain is the
logarithm of how much likelier it is in the target; gains are an array, and a document's weight is the sum of the
gains of its features. Gumbel noise from a hash of the id turns the highest scores into a draw without replacement.

The draw is a parallel sort by regular sampling: every run (a task's rows) is sorted on its own and gives regular
samples, the sorted samples give regular splitters, runs exchange the segments between splitters, every segment is
merged on its own, and the counts of the segments before give exact ranks. Segments that begin behind the last drawn
rank need no merge.

- Null and empty texts have no features: n_features and weight are 0. A null id has the noise of an empty id and comes
  last among equal scores. Repeated rows are ranked one by one; of equal ones any may come first.
- An empty target gives gains by the smoothing alone. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quire.llm import words
from quire.llm.store import ship, stored

BUCKETS = 10_000
LONGEST = 3
#: Runs and segments of the sort. The samples that meet in one place are at most the square of it.
SEGMENTS = 256
#: Distinct words whose checksums a task remembers.
REMEMBERED = 200_000

_FOLD = np.full(256, 0x20, np.uint8)
for _byte in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _FOLD[_byte] = _byte
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD = _FOLD.tobytes()


def _byte_steps() -> np.ndarray:
    """What appending a zero byte does to each low byte of a CRC-32."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
    return steps


class _Shifts:
    """Appending a number of zero bytes to many CRC-32 values at once: it is linear in the four bytes of a value, so a
    table for each number below 64, and for each multiple of 64, 64 ** 2 and so on, needs four entries per value."""

    def __init__(self):
        steps = _byte_steps()
        none = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
        self.digits = [self._multiples(none, lambda x: (x >> np.uint32(8)) ^ steps[x & np.uint32(255)])]
        self.none = none

    @staticmethod
    def _multiples(none, step):
        tables = [none]
        for _ in range(64):
            tables.append(step(tables[-1]))
        return np.stack(tables)

    def _apply(self, tables, values, digit):
        at = digit.astype(np.int64) << 10
        flat = tables.reshape(-1)
        made = flat[at + (values & np.uint32(255))]
        for k in (1, 2, 3):
            made ^= flat[at + (k << 8) + ((values >> np.uint32(8 * k)) & np.uint32(255))]
        return made

    def shifted(self, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        values = self._apply(self.digits[0], values, lengths & 63)
        rest, place = lengths >> 6, 1
        while rest.any():
            if len(self.digits) == place:
                below = self.digits[-1]
                self.digits.append(self._multiples(self.none, lambda x: self._apply(
                    below, x.reshape(-1), np.full(x.size, 64)).reshape(x.shape)))
            some = np.flatnonzero(rest & 63)
            values[some] = self._apply(self.digits[place], values[some], rest[some] & 63)
            rest, place = rest >> 6, place + 1
        return values


class _Words(dict):
    """Word -> its row in three arrays: CRC-32, CRC-32 behind a space, and length with the space."""

    def __init__(self):
        self.crc, self.spaced, self.size = array("I"), array("I"), array("q")

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.crc)
        self.crc.append(zlib.crc32(word))
        self.spaced.append(zlib.crc32(b" " + word))
        self.size.append(len(word) + 1)
        return at


class Features:
    """Buckets of the word runs of many texts at once. The CRC-32 of a run follows from those of its words."""

    def __init__(self, n_buckets: int = BUCKETS, longest: int = LONGEST):
        self.n_buckets, self.longest, self.shifts, self.known = n_buckets, longest, _Shifts(), _Words()

    def of(self, column: pa.Array):
        """For every run length, the buckets of all runs and where each text's begin; and the texts' word counts."""
        data, offsets = words.text_bytes(column)
        data, offsets = data.tobytes().translate(_FOLD), offsets.tolist()
        if len(self.known) > REMEMBERED:
            self.known = _Words()
        rows, counts = [], []
        for start, end in zip(offsets, offsets[1:]):
            found = data[start:end].split()
            rows.extend(map(self.known.__getitem__, found))
            counts.append(len(found))
        rows, counts = np.array(rows, np.int64), np.array(counts, np.int64)
        spaced = np.array(self.known.spaced, np.uint32)[rows]
        sizes = np.array(self.known.size, np.int64)[rows]
        values = np.array(self.known.crc, np.uint32)[rows]
        left = np.repeat(np.cumsum(counts), counts) - np.arange(len(rows))   # words from here to the end of the text
        made = []
        at = np.arange(len(rows))
        for n in range(self.longest):
            if n:
                keep = left[at] > n
                at, values = at[keep], values[keep]
                values = self.shifts.shifted(values, sizes[at + n]) ^ spaced[at + n]
            first = np.concatenate([[0], np.cumsum(np.maximum(counts - n, 0))])
            made.append(((values % np.uint32(self.n_buckets)).astype(np.int64), first))
        return made, counts


def bucket_counts(texts: DataFrame, text_column: str = "text", n_buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Every task sends one row per bucket at most."""
    def count(batches):
        features, total = Features(n_buckets), np.zeros(n_buckets, np.int64)
        for batch in words.portions(batches, "text"):
            for buckets, _ in features.of(batch.column("text"))[0]:
                total += np.bincount(buckets, minlength=n_buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    ship(texts.sparkSession)
    counted = texts.select(F.col(f"`{text_column}`").alias("text")).mapInArrow(count, "bucket long, n long")
    counts = np.zeros(n_buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():   # n_buckets rows at most
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target, rounded down; both smoothed by one."""
    n = len(source)
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(documents: DataFrame, gain: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    def weigh(batches):
        features = Features(len(gain))
        for batch in words.portions(batches, "text"):
            made, counts = features.of(batch.column("text"))
            n_features, weight = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
            for buckets, first in made:
                sums = np.concatenate([[0], np.cumsum(gain[buckets])])
                weight += sums[first[1:]] - sums[first[:-1]]
                n_features += np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(n_features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])

    ship(documents.sparkSession)
    slim = documents.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return slim.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def with_noise(rows: DataFrame, seed: int) -> DataFrame:
    """Add ``score``: weight and Gumbel noise in thousandths, from the first 32 bits of SHA-256 of ``seed:id``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return rows.withColumn("score", F.col("weight") + noise)


def _order():
    """The order of the draw: score down, then id with null last."""
    return [F.desc("score"), F.asc_nulls_last("doc_id")]


def _key(score, doc_id, run, place):
    """The same order, then run and place so that no two rows are equal."""
    return (-score, doc_id is None, doc_id or 0, run, place)


def _sorted_runs(rows: DataFrame, n_runs: int) -> DataFrame:
    """Rows in at most n_runs sorted runs, with ``run`` and the ``place`` in it."""
    def number(batches):
        run, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(batch), run, np.int64)),
                 pa.array(np.arange(at, at + len(batch)))], [*batch.schema.names, "run", "place"])
            at += len(batch)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    local = rows.coalesce(n_runs).sortWithinPartitions(*_order())
    return stored(local.mapInArrow(number, f"{fields}, run long, place long"), "runs")


def _splitters(runs: DataFrame, n: int) -> list[tuple]:
    """At most n - 1 keys that cut the rows into even segments: every run gives n regular samples at most, and the
    sorted samples are cut regularly. No segment has more than about twice its share of the rows."""
    sizes = stored(runs.groupBy("run").agg(F.count("*").alias("size")), "sizes")
    samples = (runs.join(F.broadcast(sizes), "run")      # one row per run, n at most
               .filter(f"place > 0 AND place * {n} div size <> (place - 1) * {n} div size")
               .select("score", "doc_id", "run", "place"))
    keys = sorted(_key(*row) for row in samples.collect())   # n * n rows at most
    return [keys[len(keys) * i // n] for i in range(1, n)] if keys else []


def _exchanged(runs: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Add ``segment``, the number of splitters that are not above the row."""
    def assign(batches):
        for batch in batches:
            score, doc_id, run, place = (batch.column(c) for c in ("score", "doc_id", "run", "place"))
            ids = doc_id.to_pylist()
            key = lambda i: _key(score[i].as_py(), ids[i], run[i].as_py(), place[i].as_py())
            # A task reads the files of several runs, and a batch goes on from one to the next: each stretch is sorted.
            stretch = (np.diff(run.to_numpy()) != 0) | (np.diff(place.to_numpy()) != 1)
            ends = [*(np.flatnonzero(stretch) + 1).tolist(), len(batch)]
            segment = np.zeros(len(batch), np.int64)
            for start, end in zip([0, *ends], ends):
                cuts, low = [], start
                for splitter in splitters:      # a splitter is one place in a sorted stretch
                    high = end
                    while low < high:
                        middle = (low + high) // 2
                        low, high = (middle + 1, high) if key(middle) < splitter else (low, middle)
                    cuts.append(low)
                segment[start:end] = np.searchsorted(np.array(cuts, np.int64), np.arange(start, end), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], [*batch.schema.names, "segment"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    return runs.mapInArrow(assign, f"{fields}, segment long")


def drawn(rows: DataFrame, n: int, segments: int = SEGMENTS) -> DataFrame:
    """Rows (doc_id, score, ...) with ``rank``, 1 to n by score, then id; null behind the n-th row."""
    segments = min(segments, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = _sorted_runs(rows, segments)
    exchanged = stored(_exchanged(runs, _splitters(runs, segments)), "segments")
    offsets, before = {}, 0
    for row in exchanged.groupBy("segment").count().orderBy("segment").collect():   # one row per segment
        offsets[row["segment"]] = before
        before += row["count"]
    wanted = [s for s, offset in offsets.items() if offset < n]
    offset = F.try_element_at(F.create_map(*[F.lit(x) for s in wanted for x in (s, offsets[s])]), F.col("segment")) if wanted \
        else F.lit(None).cast("long")
    inside = F.row_number().over(Window.partitionBy("segment").orderBy(*_order(), "run", "place")).cast("long")
    merged = exchanged.filter(F.col("segment").isin(wanted)).withColumn("rank", inside + offset)
    others = exchanged.filter(~F.col("segment").isin(wanted)).withColumn("rank", F.lit(None).cast("long"))
    return (merged.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank"))).unionByName(others)
            .drop("run", "place", "segment"))


def resampled(documents: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
              id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document: `percent` of those with `least_words` words or more
    are drawn towards the texts of `target`, and ranked."""
    gain = gains(bucket_counts(documents, text_column), bucket_counts(target, text_column))
    scored = stored(with_noise(weighed(documents, gain, id_column, text_column), seed), "scored")
    long_enough = scored.filter(F.col("n_words") >= least_words)
    ranked = drawn(long_enough, percent * long_enough.count() // 100)
    others = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
