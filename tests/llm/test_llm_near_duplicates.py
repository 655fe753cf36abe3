"""Components against all pairs by brute force, and the edge cases the docstrings promise."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quire.llm import queries
from quire.llm.graph import components
from quire.llm.near_duplicates import near_duplicates
from test_llm_words import plain_set


def brute_force(rows, n, percent):
    sets = {i: plain_set(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 20), (5, 4), (7, 9), (30, 31)] + [(i, i + 1) for i in range(100, 140)]
    made = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert made == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 30: 30, 31: 30} | {i: 100 for i in range(100, 141)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_groups_around_the_threshold(spark, n, percent):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows = []
    for group in range(12):
        base = [word() for _ in range(60)]
        for _ in range(15):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(60)] = word()
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000 + i, text) for i, text in enumerate(["", "   ", None, "one", "One", "two words", rows[3][1].upper()])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, n, percent).collect()}
    assert made == brute_force(rows, n, percent)


def test_odd_rows_and_columns(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(5, "a b c d e f g", "x"), (5, "a b c d e f g", "x"), (3, "A B c d e f g", None), (None, "a b c d e f g", "y"),
            (7, long, "z"), (8, long + " tail", "z"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").withColumn("kept", F.lit("clash"))
    made = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr)
    assert made == sorted([(5, 3, 3, False), (5, 3, 3, False), (3, 3, 3, True), (None, 3, None, True),
                           (7, 59_996, 7, True), (8, 59_997, 7, False), (None, 0, None, True)], key=repr)
    assert near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_ids_with_several_texts(spark, parts):
    one, other, third = (" ".join(f"{c}{i}" for i in range(80)) for c in "abc")
    rows = [(5, one), (5, other), (5, one), (9, other + " tail"), (12, one + " tail"), (2, third), (4, third + " tail"),
            (20, third), (20, "apart from all the others here"), (30, other.upper()), (40, ""), (40, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    made = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    assert made == {(i, 5) for i in (5, 9, 12, 30, 40)} | {(i, 2) for i in (2, 4, 20)} | {(40, 40)}


def test_query_on_whole_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    whole = queries.op8_minhash_near_dedup(spark, folder)
    assert whole.columns == ["doc_id", "n_shingles", "component_id", "kept"] and whole.count() == len(rows) == 1000
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in whole.collect()} == brute_force(rows, 3, 85)
