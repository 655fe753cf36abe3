"""Quality scores: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from quire.llm import words

#: Hashed features; the weights (8 bytes each) are the only thing that is broadcast.
BITS = 18
#: Labelled rows to learn from, at most about this many; they are taken by a hash of their text.
MAX_ROWS = 24_000
#: Rows of one shard; shards are trained side by side and their weights are averaged.
SHARD_ROWS = 3_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-4
#: Kinds of n-grams: words, pairs of words, shapes, pairs of shapes.
KINDS = 4

# A word's shape: letters x or X, digits 0, other ASCII as it is, runs of one class once.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("x")
_SHAPE[65:91] = ord("X")
_SHAPE[48:58] = ord("0")


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all rows, one for each n-gram, and where each row's begin (one more at the end).

    The n-grams are the words, pairs of neighbouring words, the shapes of words, and pairs of neighbouring shapes; a
    text's first word is paired with nothing. A word that repeats the one before has the shape "again", so that
    repetition is one feature and not one for each word.
    """
    data, offsets = words.text_bytes(column)
    n = len(column)
    if not len(data):
        return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    starts, ends, first = words.word_bounds(data, offsets)
    plain = words.range_hashes(words.prefix_sums(data), starts, ends)
    shape = _SHAPE[data]
    kept = np.ones(len(data), bool)
    kept[1:] = shape[1:] != shape[:-1]
    kept[starts] = True
    at = np.concatenate([[0], np.cumsum(kept)])
    shapes = words.range_hashes(words.prefix_sums(shape[kept], words.PLAIN), at[starts], at[ends])
    rows = np.repeat(np.arange(n), np.diff(first))
    follows = np.zeros(len(starts), bool)
    follows[1:] = rows[1:] == rows[:-1]
    again = follows.copy()
    again[1:] &= plain[1:] == plain[:-1]
    shapes[again] = words.PLACES[1]
    pairs = shapes.copy()
    pairs[1:] += shapes[:-1] * words.PLACES[2] * follows[1:]
    neighbours = plain * words.PLACES[6]
    neighbours[1:] += plain[:-1] * words.PLACES[7] * follows[1:]
    grams = np.concatenate([plain * words.PLACES[3], words.mix(neighbours), words.mix(shapes * words.PLACES[4]),
                            words.mix(pairs * words.PLACES[5])])
    # Each row's kinds of n-grams lie together.
    order = np.concatenate([(KINDS - 1) * first[rows] + np.arange(len(rows)) + k * np.diff(first)[rows]
                            for k in range(KINDS)])
    slots = np.empty(len(grams), np.int64)
    slots[order] = (grams >> np.uint64(64 - BITS)).astype(np.int64)
    return slots, KINDS * first


def _totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def logits(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Bias plus the dot product with each feature's share of the row's n-grams (times KINDS)."""
    slots, first = features(column)
    return weights[-1] + _totals(weights[slots], first) * KINDS / np.maximum(np.diff(first), 1)


class Learner:
    """Follow-the-regularised-leader (proximal) for sparse rows."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        present = self.weights(at)
        chance = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(present @ values)))))
        gradient = (chance - label) * values
        n = self.n[at]
        step = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - step * present
        self.n[at] = n + gradient * gradient


def _train(shard: pa.Table) -> pa.Table:
    """Weights of one shard; rows are learned in an order that does not depend on how they arrive."""
    learner, examples = Learner((1 << BITS) + 1), []
    for batch in words.portions(shard.sort_by("doc_id").combine_chunks().to_batches(), "text"):
        slots, first = features(batch.column("text"))
        for row, label in enumerate(batch.column("label").to_pylist()):
            at, counts = np.unique(slots[first[row]:first[row + 1]], return_counts=True)
            total = max(first[row + 1] - first[row], 1)
            examples.append((np.append(at, 1 << BITS).astype(np.int32),
                             np.append(counts * KINDS / total, 1.0).astype(np.float32), label))
    for epoch in range(EPOCHS):
        for place in np.random.default_rng(epoch).permutation(len(examples)):
            learner.learn(*examples[place])
    used = np.flatnonzero(learner.n)
    return pa.table({"slot": pa.array(used.astype(np.int32)), "weight": pa.array(learner.weights(used))})


def fit(documents: DataFrame, labels: DataFrame, label_column: str = "quality", id_column: str = "doc_id",
        text_column: str = "text", max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights of all slots and the bias, from `labels` (id, label 0 or 1) and the texts they name.

    Learns from about max_rows documents at most, taken by a hash of their id: the sample is a documented bound and
    does not grow with the table. Of several labels of one id the smallest counts, of several texts one; null ids,
    labels and texts are left out. Without any labelled text all weights are 0 and every score is 0.5.
    """
    known = (labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).alias("doc_id")).agg(F.min(F.col(label_column).cast("int")).alias("label")))
    labelled = known.count()
    share = min(1.0, max_rows / max(labelled, 1))
    n_shards = math.ceil(max(1, min(labelled, max_rows)) / SHARD_ROWS)
    sample = known.filter(F.expr(f"pmod(xxhash64(doc_id), 1048576) < {share * 1048576}"))
    texts = documents.filter(F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    # The sample is bounded by max_rows, so it may be broadcast.
    rows = texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    parts = (rows.withColumn("shard", F.expr(f"pmod(xxhash64(doc_id, 1), {n_shards})")).groupBy("shard")
             .applyInArrow(_train, "slot int, weight double"))
    summed = parts.groupBy("slot").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).toArrow()
    weights = np.zeros((1 << BITS) + 1)
    weights[summed["slot"].to_numpy()] = summed["weight"].to_numpy()
    shards = summed.filter(pc.equal(summed["slot"], 1 << BITS))["n"]
    return (weights / (shards[0].as_py() if len(shards) else 1)).astype(np.float32)


def score(documents: DataFrame, weights: np.ndarray, text_column: str = "text", into: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) and the chance, 0 to 1, that a text's label is 1.

    Whole texts are scored. A null text counts as empty; an empty text has no n-grams and gets the bias' score.
    """
    columns = [c for c in (keep or documents.columns) if c != into]
    rows = documents.select(*[F.col(f"`{c}`") for c in columns], F.col(text_column).alias("_text_to_score"))
    model = documents.sparkSession.sparkContext.broadcast(weights)

    def scored(batches):
        for batch in words.portions(batches, "_text_to_score"):
            chances = 1 / (1 + np.exp(-logits(batch.column("_text_to_score"), model.value)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(chances, pa.float64())], names=[*columns, into])

    schema = rows.drop("_text_to_score").schema.add(into, "double")
    return rows.mapInArrow(scored, schema)
