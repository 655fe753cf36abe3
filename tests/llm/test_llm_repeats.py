"""Repeated byte strings against a count of all of them."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from quire.llm import queries
from quire.llm.repeats import remove_repeats


def brute_force(rows, size):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k:k + size] for _, b in texts for k in range(len(b) - size + 1))
    result = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if counts[b[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        result.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=repr)


def made(df):
    return sorted((tuple(r) for r in df.drop("kept").collect()), key=repr)


def rows_with_repeats():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdé ", k=n))
    passage, line = text(260), text(150)
    rows = [(i, text(rng.randrange(400)) + passage[rng.randrange(60):200 + rng.randrange(60)] + text(rng.randrange(100)) + line)
            for i in range(40)]
    rows += [(100, "ab" * 300), (101, "z" * 500), (102, "z" * 199), (103, None), (104, ""), (None, text(300)), (105, text(199)),
             (106, rows[0][1]), (106, rows[0][1]), (107, text(3000) + "ab" * 150)]
    return rows


def test_spans_of_planted_passages(spark):
    rows = rows_with_repeats()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    assert made(remove_repeats(docs)) == brute_force(rows, 200)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_groups_over_several_batches_and_another_threshold(spark):
    rows = rows_with_repeats()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert made(remove_repeats(docs)) == brute_force(rows, 200)
        assert made(remove_repeats(docs, 120)) == brute_force(rows, 120)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_copies_of_one_row_list_their_spans_once(spark):
    row = (7, "".join(random.Random(6).choices("abcdef ", k=1000)))
    docs = spark.createDataFrame([row] * 300 + [(8, "apart")], "doc_id long, text string")
    result = made(remove_repeats(docs))
    assert len(result) == 301 and len(set(map(tuple, result))) == 2
    assert {tuple(r)[:4] for r in result} == {(7, 1000, 1000, 1), (8, 5, 0, 0)}


def test_kept_bytes(spark):
    docs = spark.createDataFrame([(1, "x" * 30 + "y" * 400), (2, "tail")], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept) for r in remove_repeats(docs).collect()}
    assert kept == {1: b"x" * 30, 2: b"tail"}


def test_query_on_whole_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 60").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 60")
    assert made(remove_repeats(docs)) == brute_force(rows, 200)
    assert queries.op9_suffix_array_dedup(spark, folder).count() == 1000
