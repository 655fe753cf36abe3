"""Packing documents into sequences of a fixed number of tokens: reduction by dominance, then best fit.

A document is its token ids and an end id. Longer ones than a sequence are cut into full pieces behind a shorter first
one. How many pieces there are of each size (a table of `capacity` numbers) decides everything, so only that is planned
in one place; pieces are numbered within their size by many tasks and look their place up in the plan.

The reduction fixes sets of one or two pieces for good where no other set with the larger piece can be better (the
dominance criterion of Martello and Toth: whatever else would fit beside it could be exchanged for the partner):
a piece that nothing fits beside; two pieces that fill a sequence; a piece and the largest that fits beside it where
no set of two or more smaller ones would fill more than that one does. What remains is packed by best fit, large pieces
first; equal pieces are placed together, so the work depends on the number of sizes and not of documents.

- Null and empty texts are documents of the end id alone. Repeated rows and ids are packed one by one. An empty table
  gives no rows. A text may have any length; a task holds the ids of about 4 MB of text, or of one longer text.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm import words
from quire.llm.ordering import run_offsets, with_places
from quire.llm.pieces import read_model
from quire.llm.store import ship, stored

CAPACITY = 2048
#: Words whose ids a task remembers, and their longest length.
REMEMBERED, LONGEST = 500_000, 48

#: Unicode white space; letters that any version of Unicode knows; the other characters of ASCII.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_MARKS = r"!-/:-@\[-`{-~"
#: Chunks at whose borders the tokenizer also cuts, whatever stands around: letters, digits or marks up to an ASCII
#: character of another kind (a mark first may be an apostrophe, which can belong to the letters behind), else a run
#: without white space, else white space but for the one that belongs to what follows.
_CHUNKS = re.compile(
    f" ?[{_LETTERS}]++(?=[\0-@\\[-`{{-\x7f]|\\Z)| ?[0-9]++(?=[\0-/:-\x7f]|\\Z)"
    f"| ?(?!')[{_MARKS}]++(?=[A-Za-z0-9 \n]|\\Z)"
    f"| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class Encoder:
    """Token ids of texts; the ids of the words that come first, which frequent words do, are remembered."""

    def __init__(self, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark's tasks are the threads
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(model)
        self.tokenizer.encode_special_tokens = True                  # their strings in a text are ordinary text
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        found = [_CHUNKS.findall(text) for text in texts]
        new = list(set().union(*found).difference(self.known))
        encodings = self.tokenizer.encode_batch_fast(new, add_special_tokens=False) if new else []
        for chunk, encoding in zip(new, encodings):
            self.known[chunk] = array("I", encoding.ids).tobytes()
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, chunks)), "<u4") for chunks in found]
        room = len(new) - (len(self.known) - REMEMBERED)
        for at, chunk in enumerate(new):
            if at >= room or len(chunk) > LONGEST:
                del self.known[chunk]
        return ids


_encoders: dict[bytes, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """The encoder of a Python worker, which goes on to the worker's next task."""
    key = hashlib.sha256(model).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(model)
    return _encoders[key]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first one may be shorter, the others are full."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(start, capacity) for start in range(first, n, capacity)]


def tokenized(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0,
              id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every document, and its ids on request."""
    def encode(batches):
        encoded, end = encoder(shared.value), np.array([end_id], "<u4")
        for batch in words.portions(batches, "text", limit=4 << 20, rows=4096):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   encoded(["" if t is None else t for t in batch.column("text").to_pylist()])):
                ids = np.concatenate([ids, end])
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start:start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(part.tobytes()), *([part] if with_ids else [])))
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])

    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_model(spark, tokenizer_path))
    slim = documents.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return slim.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long"
                           + (", ids array<int>" if with_ids else ""))


def reachable(counts: np.ndarray) -> int:
    """All sums of pieces up to the capacity, as the bits of a number."""
    capacity, sums = len(counts) - 1, 1
    mask = (1 << (capacity + 1)) - 1
    for size in np.flatnonzero(counts).tolist():
        rest, step = min(int(counts[size]), capacity // size), 1
        while rest:
            step = min(step, rest)
            sums |= (sums << (size * step)) & mask
            rest, step = rest - step, step * 2
    return sums


def reduce_by_dominance(counts: np.ndarray) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Sets that some best packing holds, as (sizes, how often), and the counts that remain.

    counts[s] is the number of pieces of size s, up to the capacity. Sets are fixed in bulk: taking pieces away only
    takes alternatives away, so what dominates once goes on to dominate while both sizes last.
    """
    counts, capacity = counts.copy(), len(counts) - 1
    fixed = []

    def fix(sizes, copies):
        if copies:
            fixed.append((sizes, copies))
            for size in sizes:
                counts[size] -= copies

    def pairs(a, b):
        return int(counts[a]) // 2 if a == b else int(min(counts[a], counts[b]))

    fix((capacity,), int(counts[capacity]))
    for large in range(capacity - 1, (capacity - 1) // 2, -1):      # two that fill a sequence
        if large >= capacity - large:
            fix((large, capacity - large), pairs(large, capacity - large))
    changed = True
    while changed and counts.any():
        changed, sums = False, reachable(counts)
        for large in np.flatnonzero(counts)[::-1].tolist():
            while counts[large]:
                free = capacity - large
                own = counts.copy()
                own[large] -= 1
                beside = np.flatnonzero(own[:free + 1])
                if not len(beside):
                    fix((large,), 1 if large <= free else int(counts[large]))
                elif (sums & ((2 << free) - 1)) >> (int(beside[-1]) + 1) == 0:
                    fix((large, int(beside[-1])), pairs(large, int(beside[-1])))
                else:
                    break
                changed = True
    return fixed, counts


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit of what remains, large pieces first: (sizes, how often). Sequences of one content are kept as one entry
    with its number, and equal pieces go into all of them at once."""
    capacity = len(counts) - 1
    by_room: dict[int, list] = defaultdict(list)         # room left -> [(sizes, how often)]
    rooms = np.zeros(capacity + 1, bool)

    def put(room, sizes, copies):
        if copies:
            by_room[room].append((sizes, copies))
            rooms[room] = True

    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            fitting = np.flatnonzero(rooms[size:])
            if not len(fitting):
                each, copies = capacity // size, left // (capacity // size)
                put(capacity - size * each, (size,) * each, copies)
                rest = left - each * copies
                put(capacity - size * rest, (size,) * rest, 1 if rest else 0)
                break
            room = size + int(fitting[0])
            sizes, copies = by_room[room].pop()
            rooms[room] = bool(by_room[room])
            each = room // size
            full = min(copies, left // each)
            put(room - size * each, sizes + (size,) * each, full)
            left, copies = left - each * full, copies - full
            if copies and left:                          # fewer than one sequence takes
                put(room - size * left, sizes + (size,) * left, 1)
                left, copies = 0, copies - 1
            put(room, sizes, copies)
    return [entry for entries in by_room.values() for entry in entries]


def plan(counts: np.ndarray) -> tuple[np.ndarray, dict]:
    """Where pieces go: for every size, ranges of the pieces' numbers. Returns the ranges' keys (size, first number),
    sorted, and for each of them the first sequence, the offset and the first number, so that piece x of a range lies
    in sequence + x - first at the offset."""
    fixed, rest = reduce_by_dominance(counts)
    size_of, first_of, sequence_of, offset_of = [], [], [], []
    used, sequence = defaultdict(int), 0
    for sizes, copies in fixed + best_fit(rest):
        offset = 0
        for size in sizes:
            size_of.append(size)
            first_of.append(used[size])
            sequence_of.append(sequence)
            offset_of.append(offset)
            used[size] += copies
            offset += size
        sequence += copies
    made = [np.array(x, np.int64) for x in (size_of, first_of, sequence_of, offset_of)]
    order = np.lexsort((made[1], made[0]))
    size_of, first_of, sequence_of, offset_of = (x[order] for x in made)
    return np.stack([size_of, first_of]), {"sequence": sequence_of, "offset": offset_of}


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (length, ...) with ``sequence_id`` and ``offset``. The plan's size is bounded by the capacity."""
    placed = stored(with_places(pieces.withColumn("size", F.col("length").cast("string")), "size"), "pieces")
    offsets = run_offsets(placed, "size")
    counts = np.zeros(capacity + 1, np.int64)
    for row in offsets.groupBy("size").agg(F.max("total").alias("n")).collect():    # one row per size
        counts[int(row["size"])] = row["n"]
    keys, values = plan(counts)
    bounds = np.searchsorted(keys[0], np.arange(capacity + 2))      # where each size's ranges begin

    def place(batches):
        for batch in batches:
            size = batch.column("length").to_numpy(zero_copy_only=False)
            no = batch.column("no").to_numpy(zero_copy_only=False)
            at = np.empty(len(size), np.int64)
            for one in np.unique(size).tolist():
                rows = size == one
                low, high = bounds[one], bounds[one + 1]
                at[rows] = low + np.searchsorted(keys[1][low:high], no[rows], "right") - 1
            sequence = values["sequence"][at] + no - keys[1][at]
            names = [n for n in batch.schema.names if n != "no"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence), pa.array(values["offset"][at])],
                [*names, "sequence_id", "offset"])

    # There is a row for each run and size, too many to broadcast in the long run.
    numbered = (placed.join(offsets.drop("total").hint("merge"), ["size", "run"])
                .withColumn("no", F.col("before") + F.col("place")).drop("size", "run", "before", "place"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "no")
    return numbered.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, doc_ids, ids) from packed pieces with their ids: what a training job reads."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return pieces.groupBy("sequence_id").agg(inside.alias("parts")).select(
        "sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.flatten("parts.ids").alias("ids"))
