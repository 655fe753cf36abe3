"""Global positions without a global sort in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.blocks import cuts_up_to, range_cuts


def _sortable_number(df: DataFrame, name: str) -> Column:
    """A number that never falls where the column rises: the value itself, or the first seven bytes of a text."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("timestamp").cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    raise ValueError(f"rows of equal value cannot be ranged by {name}, a {kind.simpleString()}")


def bucketed(df: DataFrame, order_col: str, ties: tuple[str, ...]) -> DataFrame:
    """Add ``_bucket`` and ``_sub``: rows of a lower bucket, or of a lower sub-bucket of the same one, come first.

    Approximate quantiles cut the values into buckets, one for each cut itself and one for what lies between two. NaN
    and null come behind. A value that is several quantiles at once is frequent: its rows, and those with NaN or null,
    are cut again into ranges of the first tie column, so that no bucket grows with the frequency of one value.
    """
    buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / buckets for i in range(1, buckets)]
    value = F.col(order_col).cast("double")
    numbers = df.select(value.alias("_value")).filter(~F.isnan("_value"))
    quantiles = numbers.approxQuantile("_value", shares, 0.5 / buckets)
    cuts = sorted(set(quantiles))
    below = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut <= value))
    split = (df.withColumn("_below", F.when(value.isNull(), len(cuts) + 2).when(F.isnan(value), len(cuts) + 1).otherwise(below))
             .withColumn("_cut", F.get(F.array(*map(F.lit, cuts)).cast("array<double>"), F.col("_below") - 1)))
    is_cut = F.coalesce(F.col("_cut") == value, F.lit(False))
    # How many ranges of ties a bucket needs: those of a cut as many as it has quantiles, the others of numbers one.
    weights = F.array(*[F.lit(quantiles.count(cut) + 1) for cut in cuts]).cast("array<int>")
    ranges = (F.when(F.col("_below") > len(cuts), buckets).when(is_cut, F.get(weights, F.col("_below") - 1)).otherwise(1))
    tie = _sortable_number(df, ties[0])
    return (split.withColumn("_cuts", range_cuts(df, tie))
            .withColumn("_sub", F.floor(cuts_up_to(F.col("_cuts"), tie) * ranges / buckets).cast("int"))
            .withColumn("_bucket", 2 * F.col("_below") + F.when(is_cut, 0).otherwise(1))
            .drop("_below", "_cut", "_cuts"))


def with_position(df: DataFrame, order_col: str, name: str = "position", ties: tuple[str, ...] = ()) -> DataFrame:
    """Add the 1-based position of each row in the order of a numeric column, then of the columns ``ties``.

    Every row keeps its place: NaN comes behind all numbers, null behind NaN. Rows are numbered inside even buckets
    (`bucketed`), and each bucket starts after the exact row counts of the ones before, so positions are exact whatever
    the cuts are. Only the cuts pass through the driver, and are found when the plan is built. Without ``ties`` rows of
    equal value come in the order of a hash of the row. The first of the ties is a number, date, time or text; rows
    that agree in it as well as in the value (in its first seven bytes, if it is a text) lie in one bucket.
    """
    plain = df.columns
    if not ties:
        df, ties = df.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in plain])), ("_hash",)
    rows = bucketed(df, order_col, ties)
    before = Window.orderBy("_bucket", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("_bucket", "_sub").agg(F.count("*").alias("_n"))
               .select("_bucket", "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy("_bucket", "_sub").orderBy(F.asc_nulls_last(order_col), *ties)
    # The broadcast side has a row for each sub-bucket, about six for each shuffle partition at most.
    return (rows.withColumn(name, F.row_number().over(inside))
            .join(F.broadcast(offsets), ["_bucket", "_sub"])
            .withColumn(name, F.col(name) + F.col("_offset")).select(*[f"`{c}`" for c in plain if c != name], name))


def zip_by_rank(left: DataFrame, right: DataFrame, order_left: str, order_right: str) -> DataFrame:
    """Pair the i-th row of one table with the i-th row of another; rows without a partner drop out.

    A fallback for tables that share no key; column names of the two must differ.
    """
    return with_position(left, order_left).join(with_position(right, order_right), "position")
