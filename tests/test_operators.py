import pytest
from pyspark.sql import functions as F

from quire.operators import blocks as B
from quire.operators import edges as E
from quire.operators import lists as L
from quire.operators import rows as R
from quire.operators.entities import enrich_entities
from quire.operators.phrases import phrase_places
from quire.operators.ranks import bucketed, with_position, zip_by_rank


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "start_id long, end_id long")


def _blocks(items, block):
    items = sorted(items)
    return [items[i:i + block] for i in range(0, len(items), block)]


@pytest.mark.parametrize("block", [1, 7, 50, 1000])
def test_lists_are_cut_exactly(spark, block):
    pairs = [(1, i) for i in range(50)] + [(2, 7)] * 19 + [(2, 3)] * 5 + [(3, 5), (3, 6), (None, 4), (4, None)]
    lists = L.adjacency_lists(_edges(spark, pairs), "start_id", "end_id", "ids", block)
    expected = [(key, part, ids) for key in (1, 2, 3)
                for part, ids in enumerate(_blocks([b for a, b in pairs if a == key], block))]
    assert _rows(lists, "start_id", "part", "ids") == sorted(expected, key=repr)
    back = L.explode_list(lists, "start_id", "ids", "end_id")
    assert _rows(back, "start_id", "end_id") == sorted((p for p in pairs if None not in p), key=repr)


def test_hub_with_one_repeated_item_is_spread(spark):
    """A third of all edges from one id, a third of them to one other: no row and no task holds them all."""
    edges = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.lit(-2)).otherwise(F.col("id")).alias("start_id"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("end_id"))
    lists = L.adjacency_lists(edges, "start_id", "end_id", "ids", 100).select("start_id", "part", "ids").collect()
    of = lambda key: [r.ids for r in sorted((r for r in lists if r.start_id == key), key=lambda r: r.part)]
    assert of(-1) == [[5] * 100] * 100
    assert of(-2) == _blocks(range(1, 30_000, 3), 100)
    assert len(lists) == 100 + 100 + 10_000


def test_ranges_of_a_hub_are_even(spark):
    rows = spark.range(20_000).select((F.col("id") % 2).alias("key"), (F.col("id") * F.col("id")).alias("item"),
                                      F.lit(3).cast("long").alias("weight"))
    started = B.with_start(rows, ["key"], "item", "weight", 10)
    assert _rows(started.filter("key = 1"), "item", "start") == sorted(
        ((i * i, 3 * n) for n, i in enumerate(range(1, 20_000, 2))), key=repr)
    ranges = rows.withColumn("cuts", B.range_cuts(rows, F.col("item"))).groupBy(
        B.cuts_up_to(F.col("cuts"), F.col("item")).alias("range")).count()
    sizes = [r["count"] for r in ranges.collect()]
    assert len(sizes) == 4 and max(sizes) < 1.2 * 20_000 / 4


def test_byte_blocks_keep_their_bound(spark):
    sizes = [30, 10, 10, 100, 70, 5, 5, 5, 60, 200, 1, 49, 50, 51] * 30
    rows = spark.createDataFrame([(1, i, s) for i, s in enumerate(sizes)], "key int, at long, size long")
    made = (B.with_start(rows, ["key"], "at", "size", 100).withColumn("block", B.byte_block(F.col("size"), 100))
            .orderBy("at").collect())
    assert [r.block for r in made] == sorted(r.block for r in made)
    blocks = {}
    for r in made:
        blocks.setdefault(r.block, []).append(r.size)
    assert all(sum(b) <= 100 or len(b) == 1 for b in blocks.values())
    assert len(blocks) <= 2 + 4 * sum(sizes) / 100


def test_attached_lists(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    edges = _edges(spark, [(1, i) for i in range(20)] + [(9, i) for i in range(20)])
    backward = _edges(spark, [(2, 5), (1, 6)])
    table = L.attach_lists(base, "id", {"ids": edges, "back": backward}, 8)
    assert _rows(table, "id", "name", "part", "ids", "back") == sorted([
        (1, "a", 0, list(range(8)), [6]), (1, "a", 1, list(range(8, 16)), None), (1, "a", 2, list(range(16, 20)), None),
        (2, "b", 0, None, [5])], key=repr)


def test_lists_move_their_edges_twice(spark):
    """Three lists: by edge, and by entity and part. The other exchanges carry totals or are for large keys only."""
    base = spark.range(100)
    edges = spark.range(1000).select((F.col("id") % 100).alias("start_id"), F.col("id").alias("end_id"))
    table = L.attach_lists(base, "id", {name: edges for name in "abc"})
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_drop_edges(spark):
    edges = _edges(spark, [(1, 2), (2, 3), (3, 1), (4, 5)])
    ids = spark.createDataFrame([(1,), (1,), (5,)], "id long")
    assert _rows(E.drop_edges(edges, ids), "start_id", "end_id") == [(2, 3)]
    assert _rows(E.drop_edges(edges, ids, ("start",)), "start_id", "end_id") == [(2, 3), (3, 1), (4, 5)]


def test_degrees_sum_to_edges(spark):
    edges = _edges(spark, [(1, 2), (3, 2), (2, 1)])
    nodes = spark.createDataFrame([(1, 9), (2, 9), (3, 9)], "id long, n int")
    counted = E.recount_in_degree(nodes, edges, "id", "n")
    assert _rows(counted, "id", "n") == [(1, 1), (2, 2), (3, 0)]


def test_placeholder_keeps_null_keys(spark):
    df = spark.createDataFrame([("...",), ("a",), (None,)], "key string")
    assert _rows(R.drop_placeholder(df, "key"), "key") == [("a",), (None,)]


def test_dedupe_and_union(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 5)], "id long, v long")
    assert _rows(R.dedupe_first(df, ["id"], ["v"]), "id", "v") == [(1, 2), (2, 5)]
    more = spark.createDataFrame([(1, "x"), (3, "y")], "id long, w string")
    merged = R.union_first_wins([df.filter("v = 2"), more], ["id"])
    assert _rows(merged, "id", "v", "w") == [(1, 2, None), (3, None, "y")]


def test_enrichment(spark):
    base = spark.createDataFrame([(1, "A. One"), (2, "B Two"), (3, "Nobody")], "id long, name string")
    extra = spark.createDataFrame(
        [(12, ["A. One", "B Two"], "Later", 1), (11, ["A. One"], "Ann One", 2), (13, None, "Z", 3)],
        "authorid long, dblp array<string>, name string, hindex int")
    made = enrich_entities(base, extra.filter("dblp IS NOT NULL"), "dblp", "authorid")
    assert _rows(made, "id", "name", "hindex") == [(1, "Ann One", 2), (2, "Later", 1), (3, "Nobody", None)]


def test_positions(spark):
    values = [i * i * (-1 if i % 3 else 1) for i in range(1, 500)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    assert _rows(with_position(df, "v"), "v", "position") == sorted(
        ((v, i + 1) for i, v in enumerate(sorted(values))), key=repr)
    left = spark.createDataFrame([(3, "c"), (1, "a")], "a long, x string")
    right = spark.createDataFrame([(10, "p"), (30, "r"), (20, "q")], "b long, y string")
    assert _rows(zip_by_rank(left, right, "a", "b"), "x", "y") == [("a", "p"), ("c", "q")]


def test_positions_keep_every_row(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, nan), (4, 2.0), (5, -1.0), (6, None)], "id long, v double")
    ranked = with_position(df, "v", ties=("id",))
    assert [r.id for r in ranked.orderBy("position").collect()] == [5, 1, 4, 3, 2, 6]
    assert with_position(df.limit(0), "v").count() == 0
    assert with_position(df.filter("v IS NULL"), "v", ties=("id",)).count() == 2


def test_frequent_values_and_nulls_are_numbered_by_many_tasks(spark):
    """Half of the values null, a quarter equal, one in eight NaN: no bucket has more than a few hundredths."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    value = (F.when(F.col("id") % 8 < 4, F.lit(None)).when(F.col("id") % 8 < 6, F.lit(7.0)).when(
        F.col("id") % 8 == 6, F.lit(float("nan"))).otherwise(F.col("id") % 97).cast("double"))
    tie = F.when(F.col("id") % 1000 > 0, (F.col("id") * 7919) % 40_009)
    try:
        for text in (False, True):
            df = spark.range(40_000).select("id", value.alias("v"), (
                F.format_string("%07d", tie.cast("int")) if text else tie).alias("tie"))
            sizes = [r["count"] for r in bucketed(df, "v", ("tie",)).groupBy("_bucket", "_sub").count().collect()]
            assert max(sizes) < 0.05 * 40_000 and len(sizes) <= 6 * 60
            rows = with_position(df, "v", ties=("tie", "id")).collect()
            rank = lambda r: (r.v is None, r.v is not None and r.v != r.v, r.v if r.v is not None and r.v == r.v else 0,
                              r.tie is not None, r.tie if r.tie is not None else 0, r.id)
            assert [r.position for r in sorted(rows, key=rank)] == list(range(1, 40_001))
        # Without ties, equal rows are dealt by a hash.
        sizes = bucketed(df.withColumn("h", F.xxhash64("id")), "v", ("h",)).groupBy("_bucket", "_sub").count()
        assert sizes.agg(F.max("count")).first()[0] < 0.05 * 40_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _run_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_lists_of_ordinary_keys_need_one_gathering(spark):
    """Keys of more than a block, as most are with small blocks, are neither numbered by windows nor joined."""
    edges = spark.range(600).selectExpr("id % 60 AS start_id", "id * 7 % 101 AS end_id")
    made = L.adjacency_lists(edges, "start_id", "end_id", "ids", block=3)
    plan = _run_plan(made)
    assert "Window" not in plan and "SortMergeJoin" not in plan
    expected = {}
    for r in edges.collect():
        expected.setdefault(r["start_id"], []).append(r["end_id"])
    cut = {(k, i // 3): sorted(v)[i:i + 3] for k, v in expected.items() for i in range(0, len(v), 3)}
    assert {(r["start_id"], r["part"]): r["ids"] for r in made.collect()} == cut
    base = spark.range(70)
    attached = L.attach_lists(base, "id", {"a": edges, "b": edges.filter("end_id < 50")}, block=3)
    assert "Window" not in _run_plan(attached)


def test_lists_of_huge_keys_are_the_same(spark, monkeypatch):
    """Keys beyond what a task may hold take the way over ranges, with the same parts."""
    edges = spark.range(400).selectExpr("CASE WHEN id < 150 THEN 0 WHEN id < 155 THEN NULL ELSE id % 40 END AS start_id",
                                        "id * 7 % 31 AS end_id")
    base = spark.createDataFrame([(i, f"n{i}") for i in range(45)] + [(None, "none")], "id long, name string")
    def made():
        one = L.adjacency_lists(edges, "start_id", "end_id", "ids", block=4)
        both = L.attach_lists(base, "id", {"a": edges, "b": edges.filter("end_id < 9")}, block=4)
        return [sorted(map(repr, df.collect())) for df in (one, both)]
    whole = made()
    monkeypatch.setattr(L, "GATHERED", 20)
    assert made() == whole


def test_starts_of_huge_keys_are_the_same(spark, monkeypatch):
    rows = spark.range(300).selectExpr("CASE WHEN id < 100 THEN 0 ELSE id % 30 END AS k", "id AS at", "id % 7 AS size")
    made = lambda: sorted(map(repr, B.with_start(rows, ["k"], "at", "size", 25).collect()))
    whole = made()
    totals = {}
    for r in rows.orderBy("at").collect():
        totals.setdefault(r["k"], []).append((r["at"], r["size"]))
    starts = {at: sum(s for _, s in v[:i]) if sum(s for _, s in v) > 25 else None
              for v in totals.values() for i, (at, _) in enumerate(v)}
    assert {r["at"]: r["start"] for r in B.with_start(rows, ["k"], "at", "size", 25).collect()} == starts
    monkeypatch.setattr(B, "GATHERED", 20)
    assert made() == whole


def test_phrases_are_checked_by_a_second_token_before_they_move(spark):
    """Their rarest tokens are in all texts, the phrases in a few: only these reach the join."""
    texts = spark.range(200).selectExpr("id", "CASE WHEN id % 50 = 0 THEN 'so Big  Data, c++ x' ELSE 'data big so c + x' END AS text")
    words = spark.createDataFrame([("big  data",), ("C++",), ("so",), ("data, c",), (", c++ x",)], "word string")
    made = phrase_places(texts, "id", "text", words)
    assert _rows(made.filter("word <> 'so'"), "id", "word") == sorted(
        ((i, w) for i in range(0, 200, 50) for w in ("big  data", "C++", "data, c")), key=repr)    # ", c++ x" has a letter before it
    assert made.filter("word = 'so'").count() == 200
    few = phrase_places(texts, "id", "text", words.filter("word <> 'so'"))
    assert "seconds" in few._jdf.queryExecution().analyzed().toString() and few.count() == 12
