"""Importance resampling: features, weights and ranks against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quire.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(found[i:i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)], len(found)


def bucket(feature):
    return zlib.crc32(feature.encode()) % resampling.BUCKETS


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 -\x7f\x00é世\n", max_size=60)), min_size=1, max_size=5))
def test_features(texts):
    made, counts = resampling.Features().of(pa.array(texts, pa.string()))
    for row, text in enumerate(texts):
        features, n_words = plain_features(text)
        found = [b for buckets, first in made for b in buckets[first[row]:first[row + 1]].tolist()]
        assert found == [bucket(f) for f in features] and counts[row] == n_words


def test_features_with_long_words():
    texts = ["a " + "x" * n + " b " + "y" * m for n, m in ((62, 63), (64, 65), (130, 4095), (4096, 4097), (300_000, 1))]
    made, _ = resampling.Features().of(pa.array(texts, pa.string()))
    for row, text in enumerate(texts):
        found = [b for buckets, first in made for b in buckets[first[row]:first[row + 1]].tolist()]
        assert found == [bucket(f) for f in plain_features(text)[0]]


def plain(rows, target, percent=5, least=20):
    buckets = resampling.BUCKETS
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, text in rows:
        for f in plain_features(text)[0]:
            s[bucket(f)] += 1
    for text in target:
        for f in plain_features(text)[0]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets))))
            for a, b in zip(s, t)]
    made = []
    for doc_id, text in rows:
        features, n = plain_features(text)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append((doc_id, len(features), weight, score, n))
    long_enough = sorted((m for m in made if m[4] >= least), key=lambda m: (-m[3], m[0] is None, m[0] or 0))
    n_drawn = percent * len(long_enough) // 100
    ranked = [(*m[:4], i + 1 if i < n_drawn else None) for i, m in enumerate(long_enough)]
    return sorted(ranked + [(*m[:4], None) for m in made if m[4] < least], key=repr)


def frames(spark, rows, target):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumns({name: F.lit("clash") for name in ("score", "rank", "weight", "run", "place", "segment", "a.b")})
    return docs, spark.createDataFrame([(t,) for t in target], "text string")


def test_draw_against_plain_python(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(700)]
    rows += [(5, rows[5][1])] * 150                                   # one id, one text
    rows += [(None, "null id " * 12), (1000, None), (1001, ""), (1002, "É" * 30_000), (1003, "ab " * 40_000)]
    target = [" ".join(vocabulary[:40]), None, ""]
    for percent in (5, 60, 0, 100):
        docs, wanted = frames(spark, rows, target)
        found = resampling.resampled(docs, wanted, percent).collect()
        assert sorted(map(tuple, found), key=repr) == plain(rows, target, percent)


def test_empty_tables(spark):
    docs, wanted = frames(spark, [], [])
    assert resampling.resampled(docs, wanted).collect() == []
    docs, wanted = frames(spark, [(1, "some words " * 20)] * 40, [])
    assert sorted(r.rank or 0 for r in resampling.resampled(docs, wanted).collect())[-2:] == [1, 2]


def test_segments_are_even_when_scores_are_equal(spark):
    rows = spark.range(4000).select((F.col("id") % 3).alias("doc_id"), F.lit(7).cast("long").alias("score")).repartition(4)
    runs = resampling._sorted_runs(rows, 4)
    sizes = [r["count"] for r in resampling._exchanged(runs, resampling._splitters(runs, 4)).groupBy("segment").count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2000 and sum(sizes) == 4000
    ranks = [r["rank"] for r in resampling.drawn(rows, 4000).collect()]
    assert sorted(ranks) == list(range(1, 4001))


def test_ranks_over_several_runs(spark):
    """Small runs are read by few tasks, so that a batch holds rows of several of them."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(700)).alias("score"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")     # more runs than cores
    try:
        found = resampling.drawn(rows.repartition(8), 150).filter("rank IS NOT NULL").orderBy("rank").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    wanted = sorted(((r["score"], r["doc_id"]) for r in rows.collect()), key=lambda x: (-x[0], x[1]))[:150]
    assert [(r["score"], r["doc_id"]) for r in found] == wanted
