"""Cutting the rows of a key into numbered blocks of a bounded size, exactly and for keys of any size.

A row has a weight (how often an item occurs, how many bytes a text has). Its start is the total weight of the rows
before it, and the start says in which block it lies. Only keys that do not fit into one block need starts. Their rows
are cut into ranges of the order column; every range is summed up on its own, and the totals of the ranges before give
the rest. So no task sees more than a range of a key, even where one key holds most of a table.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows, and bytes of rows, of one key that a task may hold.
GATHERED = 100_000
GATHERED_BYTES = 64 << 20


def range_cuts(rows: DataFrame, value: Column) -> Column:
    """About as many even cuts of a numeric column as there are shuffle partitions, as an array that Spark finds when
    the query runs; null without rows."""
    ranges = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return rows.agg(F.percentile_approx(value, shares, 20 * ranges).alias("cuts")).scalar()


def cuts_up_to(cuts: Column, value: Column) -> Column:
    """How many of the cuts are not above the value, never null."""
    return F.coalesce(F.size(F.filter(cuts, lambda cut: cut <= value)), F.lit(0))


def mark_large(rows: DataFrame, keys: list[str], weight: Column, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_large``, true for keys that weigh more than ``limit`` and null for others, and (keys, _total) of
    these keys. They are few: at most the total weight through the limit. Spark broadcasts them when their measured size
    allows, and splits a skewed join otherwise, as only rows stand under its other side."""
    large = rows.groupBy(*keys).agg(F.sum(weight).alias("_total")).filter(F.col("_total") > limit)
    return rows.join(large.select(*keys, F.lit(True).alias("_large")), keys, "left"), large


def add_start(rows: DataFrame, keys: list[str], order: str, weight: str, among: DataFrame) -> DataFrame:
    """Add ``start``, the total weight of the rows of the same key that come before by ``order``, which is numeric, not
    null and unique within a key. The cuts are those of ``among``, a larger table with the same order column: a key has
    no more rows in a range than all keys together have there."""
    ranged = (rows.withColumn("_cuts", range_cuts(among, F.col(order)))
              .withColumn("_range", cuts_up_to(F.col("_cuts"), F.col(order))).drop("_cuts"))
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy(*keys, "_range").agg(F.sum(weight).alias("_sum"))
              .select(*keys, "_range", F.coalesce(F.sum("_sum").over(earlier(*keys).orderBy("_range")), F.lit(0))
                      .alias("_before")))
    inside = F.coalesce(F.sum(weight).over(earlier(*keys, "_range").orderBy(order)), F.lit(0))
    return (ranged.withColumn("_inside", inside).join(before, [*keys, "_range"])
            .withColumn("start", (F.col("_before") + F.col("_inside")).cast("long")).drop("_range", "_inside", "_before"))


def split_huge(rows: DataFrame, keys: list[str], huge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all other keys, and rows of the keys of ``huge``. These are at most the total weight through a limit that
    is large, so they are broadcast and no row moves for them."""
    names = F.broadcast(huge.select(*keys).distinct())
    return rows.join(names, keys, "left_anti"), rows.join(names, keys, "left_semi")


def _spread_start(rows: DataFrame, keys: list[str], order: str, weight: str, limit: int) -> DataFrame:
    """`with_start` where a key's rows may be more than a task should see."""
    marked, _ = mark_large(rows, keys, F.col(weight), limit)
    small = marked.filter(F.col("_large").isNull()).withColumn("start", F.lit(None).cast("long")).drop("_large")
    large = add_start(marked.filter("_large").drop("_large"), keys, order, weight, rows)
    return small.unionByName(large.select(*small.columns))


def with_start(rows: DataFrame, keys: list[str], order: str, weight: str, limit: int) -> DataFrame:
    """`add_start` for keys whose rows weigh more than ``limit`` bytes together; ``start`` is null for all others. Keys
    are not null. With a limit below `GATHERED_BYTES` the rows of most keys are numbered in one task, so they move once;
    only keys that weigh more, or have more than `GATHERED` rows, are cut into ranges."""
    if limit >= GATHERED_BYTES:
        return _spread_start(rows, keys, order, weight, limit)
    huge = rows.groupBy(*keys).agg(F.sum(weight).alias("_total"), F.count("*").alias("_rows")).filter(
        (F.col("_total") > GATHERED_BYTES) | (F.col("_rows") > GATHERED))
    few, many = split_huge(rows, keys, huge)
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    start = F.when((F.sum(weight).over(of_key) > limit) & known, F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
    numbered = finely(few, *keys).withColumn("start", start.cast("long"))
    return numbered.unionByName(_spread_start(many, keys, order, weight, limit).select(*numbered.columns))


def finely(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by key into more partitions than usual, where later steps of a task hold them several times, wide."""
    return rows.repartition(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def byte_block(size: Column, limit: int) -> Column:
    """The block of a row from its ``start`` in bytes and its size: numbers rise with the order, rows of a block are
    neighbours, and a block holds more than ``limit`` bytes only where one row alone does.

    Rows of up to half the limit that start in the same half-limit stretch make a block; a larger row is a block of its
    own, and the rows behind it start in a later stretch. Numbers have gaps.
    """
    half = max(limit // 2, 1)
    stretch = F.expr(f"start div {half}")
    return F.coalesce(2 * stretch + F.when(size > half, 1).otherwise(0), F.lit(0)).cast("long")
