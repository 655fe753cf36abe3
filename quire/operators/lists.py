"""Grouping ids into lists, and back.

A list lives in one row, so a key with very many items needs several. Lists come in blocks of a stated size: ``part`` b
of a key holds its items at positions b * block to (b + 1) * block - 1 in sorted order, repeats counted. The parts of a
key in order are its sorted list, all but the last are full, and exploding them gives back the edge table. Most keys
have one part, 0.

All but the largest keys are gathered whole, sorted and cut in their row, so their edges move once. Keys with more than
`GATHERED` items (and more than a block) need positions. Their repeated edges are counted before they are shuffled, so a
key and item that make up much of a table are one row, and a key's items are numbered by many tasks
(`quire.operators.blocks`).
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.blocks import GATHERED, add_start, mark_large, split_huge

#: Items in a row of a list, at most.
BLOCK = 100_000


def _known(edges: DataFrame, keys: list[str], item: str) -> DataFrame:
    return reduce(lambda df, name: df.filter(F.col(name).isNotNull()), [*keys, item], edges.select(*keys, item))


def _huge(known: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Keys with more items than a block and than a task may hold."""
    return known.groupBy(*keys).agg(F.count("*").alias("_total")).filter(F.col("_total") > max(block, GATHERED))


def _cut(items: Column, part: Column, block: int) -> Column:
    """The part of a sorted list, null where it has no such part."""
    return F.when(F.size(items) > part * block, F.slice(items, part * block + 1, block))


def _in_parts(edges: DataFrame, keys: list[str], item: str, block: int) -> tuple[DataFrame, DataFrame]:
    """(keys, part, item) of all edges, and (keys, _total) of keys with several parts. Rows with a null key or item are
    left out."""
    known = _known(edges, keys, item)
    marked, large = mark_large(known, keys, F.lit(1), block)
    whole = marked.filter(F.col("_large").isNull()).select(*keys, F.lit(0).alias("part"), item)
    counted = marked.filter("_large").groupBy(*keys, item).agg(F.count("*").alias("_n"))
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + _n - 1) div {block}")
    copies = (F.least(F.expr("start + _n"), F.expr(f"(part + 1) * {block}"))
              - F.greatest(F.col("start"), F.expr(f"part * {block}"))).cast("int")
    spread = (add_start(counted, keys, item, "_n", known)
              .select(*keys, item, "start", "_n", F.explode(F.sequence(first, last)).alias("part"))
              .select(*keys, F.col("part").cast("int").alias("part"), F.explode(F.array_repeat(item, copies)).alias(item)))
    return whole.unionByName(spread), large


def adjacency_lists(edges: DataFrame, key: str, item: str, name: str, block: int = BLOCK) -> DataFrame:
    """(key, part, sorted list of ``item``) in parts of ``block`` items. Items are numbers."""
    known = _known(edges, [key], item)
    few, many = split_huge(known, [key], _huge(known, [key], block))
    whole = few.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.size("_items") - 1) / block).cast("int"))).alias("part")
    cut = whole.select(key, "_items", parts).select(key, "part", _cut(F.col("_items"), F.col("part"), block).alias(name))
    rows, _ = _in_parts(many, [key], item, block)
    return cut.unionByName(rows.groupBy(key, "part").agg(F.sort_array(F.collect_list(item)).alias(name)))


def explode_list(df: DataFrame, key: str, name: str, item: str) -> DataFrame:
    """The edge table behind a list column; parts need no special care."""
    return df.select(key, F.explode(name).alias(item))


def attach_lists(base: DataFrame, key: str, lists: dict[str, DataFrame], block: int = BLOCK) -> DataFrame:
    """Entities with lists of ids: column name -> edges (id, item). An entity has a row for each part of its longest
    list, one at least, which repeats its columns; a list that has no such part is null there.

    All lists are grouped together, so their edges move once however many lists there are. ``key`` is unique in ``base``
    and its values are those of the ids.
    """
    edges = reduce(DataFrame.unionByName, [
        rows.select(F.col(rows.columns[0]).alias("_key"), F.lit(name).alias("_list"), F.col(rows.columns[1]).alias("_item"))
        for name, rows in lists.items()])
    known = _known(edges, ["_key", "_list"], "_item")
    huge = _huge(known, ["_key", "_list"], block).select("_key")
    few, many = split_huge(known, ["_key"], huge)
    base = base.select(key, *[c for c in base.columns if c != key])
    small, large = split_huge(base, [key], huge.withColumnRenamed("_key", key))
    return _attach_whole(small, key, few, list(lists), block).unionByName(
        _attach_spread(large, key, many, list(lists), block))


def _of(name: str) -> Column:
    return F.sort_array(F.collect_list(F.when(F.col("_list") == name, F.col("_item"))))


def _attach_whole(base: DataFrame, key: str, edges: DataFrame, names: list[str], block: int) -> DataFrame:
    """Lists that fit into a row meet their entity by its id and are cut there."""
    made = edges.groupBy("_key").agg(*[_of(name).alias(f"_of_{name}") for name in names])
    last = F.floor((F.greatest(*[F.coalesce(F.size(f"_of_{name}"), F.lit(0)) for name in names], F.lit(1)) - 1) / block)
    rows = base.join(made, F.col(key) == F.col("_key"), "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    return rows.select(*base.columns, "part",
                       *[_cut(F.col(f"_of_{name}"), F.col("part"), block).alias(name) for name in names])


def _attach_spread(base: DataFrame, key: str, edges: DataFrame, names: list[str], block: int) -> DataFrame:
    """Lists of any length meet their entity by its id and part."""
    placed, large = _in_parts(edges, ["_key", "_list"], "_item", block)
    made = placed.groupBy("_key", "part").agg(*[_of(name).alias(name) for name in names])
    made = made.select("_key", F.col("part").alias("_part"),
                       *[F.when(F.size(name) > 0, F.col(name)).alias(name) for name in names])
    parts = large.groupBy(F.col("_key").alias(key)).agg(F.expr(f"(max(_total) + {block - 1}) div {block}").alias("_parts"))
    rows = (base.join(parts, key, "left")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)).cast("int") - 1))).drop("_parts"))
    return rows.join(made, (rows[key] == made["_key"]) & (rows["part"] == made["_part"]), "left").drop("_key", "_part")


def degree(edges: DataFrame, key: str, name: str) -> DataFrame:
    """Number of edges per id."""
    return edges.groupBy(key).agg(F.count("*").alias(name))
