"""Packing: ids against the tokenizer, the reduction against an exact search, places against their definition."""

import math
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def test_ids_are_the_tokenizers(tokenizer):
    encode = packing.Encoder(open(PATH, "rb").read())
    # Every code point between letters, behind and before spaces.
    every = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b {c} {c}'s  {c}\n" for c in every[i:i + 500]) for i in range(0, len(every), 500)]
    texts += ["", " ", "\n\n", "  lead", "trail  ", "don't we'll  x", "a　　b", "x" * 20_000, "\t\x85\x1c a", "<|endoftext|>"]
    random.seed(2)
    texts += ["".join(random.choices(" \n\t  ab1'.é世🙂", k=60)) for _ in range(2000)]
    expected = tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, ids, wanted in zip(texts, encode(texts), expected):
        assert ids.tolist() == wanted.ids, repr(text[:80])


def exact(sizes, capacity):
    """The least number of sequences, by trying everything."""
    sizes = tuple(sorted(sizes, reverse=True))

    @lru_cache(None)
    def least(rest):
        if not rest:
            return 0
        best, first, others = len(rest), rest[0], rest[1:]
        sets = {((), others)}
        for _ in range(len(others)):
            more = set()
            for chosen, left in sets:
                for i, size in enumerate(left):
                    if first + sum(chosen) + size <= capacity:
                        more.add((tuple(sorted(chosen + (size,))), left[:i] + left[i + 1:]))
            if more <= sets:
                break
            sets |= more
        for left in {left for _, left in sets}:
            best = min(best, 1 + least(left))
        return best
    return least(sizes)


def histogram(sizes, capacity):
    return np.bincount(sizes, minlength=capacity + 1).astype(np.int64)


def test_reduction_keeps_an_optimum():
    rng = random.Random(5)
    reduced = 0
    for _ in range(250):
        capacity = rng.randint(6, 24)
        sizes = [rng.randint(rng.choice([1, capacity // 4 + 1]), capacity) for _ in range(rng.randint(1, 9))]
        fixed, rest = packing.reduce_by_dominance(histogram(sizes, capacity))
        left = np.repeat(np.arange(capacity + 1), rest).tolist()
        taken = [s for kinds, copies in fixed for s in kinds * copies]
        assert sorted(taken + left) == sorted(sizes)
        assert all(sum(kinds) <= capacity for kinds, _ in fixed)
        assert sum(copies for _, copies in fixed) + exact(left, capacity) == exact(sizes, capacity)
        reduced += len(taken)
    assert reduced > 500


def test_reduction_by_one_partner():
    # Beside 7 there is room for 5; nothing but one 4 comes near, so {7, 4} dominates although it is not full.
    fixed, rest = packing.reduce_by_dominance(histogram([7, 4, 4, 6], 12))
    assert sorted((sorted(kinds), copies) for kinds, copies in fixed) == [([4, 6], 1), ([4, 7], 1)] and not rest.any()


def test_best_fit_holds_all_and_is_near_the_bound():
    rng = np.random.default_rng(3)
    sizes = np.minimum(rng.geometric(1 / 300, 20_000), 2048)
    counts = histogram(sizes, 2048)
    packed = packing.best_fit(counts)
    assert (sum(histogram(list(kinds), 2048) * copies for kinds, copies in packed) == counts).all()
    assert all(sum(kinds) <= 2048 and copies > 0 for kinds, copies in packed)
    assert sum(copies for _, copies in packed) <= math.ceil(sizes.sum() / 2048) + 1


def check(rows, capacity):
    """Every sequence is filled without gaps up to the capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_sequences(spark, tokenizer):
    texts = ["", None, "word", " ".join(f"t{i}" for i in range(400)), "same text", "same text", "x " * 31, "é" * 63]
    rows = list(enumerate(texts)) + [(4, "same text")] * 60 + [(None, "no id"), (99, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit("clash") for name in ("size", "run", "place", "no", "length", "a.b")}).repartition(3)
    pieces = packing.tokenized(docs, PATH, capacity=64, with_ids=True)
    made = packing.packed(pieces, capacity=64)
    found = made.collect()
    check(found, 64)
    expected = sorted(
        (repr(doc_id), piece, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()))
        for doc_id, text in rows
        for ids in [tokenizer.encode(text or "", add_special_tokens=False).ids + [0]]
        for piece, (start, length) in enumerate(packing.cut(len(ids), 64)))
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    joined = packing.sequences(made).collect()
    assert sum(len(r.ids) for r in joined) == sum(r.length for r in found) and max(len(r.ids) for r in joined) <= 64
    assert all(r.ids[-1] == 0 or len(r.ids) == 64 for r in joined if len(r.doc_ids) == 1 and r.doc_ids[0] != 3)


def test_cut():
    assert packing.cut(5, 5) == [(0, 5)] and packing.cut(6, 5) == [(0, 1), (1, 5)] and packing.cut(1, 5) == [(0, 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(packing.tokenized(docs, PATH)).collect() == []


def test_query_on_the_whole_table(spark, folder, tokenizer):
    found = queries.op13_best_fit_packing(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs}
    expected = sorted((doc, piece, start, length, zlib.crc32(np.array(all_ids[start:start + length], "<u4").tobytes()))
                      for doc, all_ids in ids.items() for piece, (start, length) in enumerate(packing.cut(len(all_ids), 2048)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    assert check(found, 2048) == math.ceil(sum(map(len, ids.values())) / 2048)
