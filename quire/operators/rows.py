"""Row selection: predicates, first-per-key, union, semi-join."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_placeholder(df: DataFrame, column: str, placeholder: str = "...") -> DataFrame:
    """Drop rows whose key is the placeholder; null keys stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(placeholder)))


def first_n_matching(df: DataFrame, predicate: Column, n: int | None, order: list[str]) -> DataFrame:
    """The first ``n`` rows, by ``order``, that meet the predicate; all of them when ``n`` is None."""
    matching = df.filter(predicate)
    return matching if n is None else matching.orderBy(*order).limit(n)


def keep_related(df: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    """Rows with a match in ``others``. No id list goes through the driver; repeated ids collapse before the join."""
    return df.join(others.select(*on).distinct(), on, "left_semi").select(*df.columns)


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all shared column names."""
    return left.join(right, sorted(set(left.columns) & set(right.columns)))


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in a stated order.

    Spark cuts each map task to one row per key before the shuffle (WindowGroupLimit), so a key that holds
    much of the table sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_first_wins(frames: list[DataFrame], keys: list[str], order: list[Column | str] = ()) -> DataFrame:
    """Union of frames that may differ in columns; per key the row of the earliest frame stays."""
    ranked = [frame.withColumn("_priority", F.lit(i)) for i, frame in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    return dedupe_first(merged, keys, ["_priority", *order]).drop("_priority")
