"""Projections, casts and null handling."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def pick(df: DataFrame, columns: dict[str, str | int]) -> DataFrame:
    """Keep and rename columns: new name -> old name or position."""
    names = {new: df.columns[old] if isinstance(old, int) else old for new, old in columns.items()}
    return df.select(*[_quoted(old).alias(new) for new, old in names.items()])


def prune_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order; the header follows from the schema."""
    return df.select(*[_quoted(name) for name in keep if name in df.columns])


def safe_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that gives null for what does not parse. A whole number written as ``1998.0`` counts as 1998."""
    if source == target:
        return column
    if isinstance(source, T.StringType) and isinstance(target, _INTEGRAL):
        column = F.regexp_replace(F.trim(column), r"\.0+$", "")
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(column, lambda x: safe_cast(x, source.elementType, target.elementType))
    return column.try_cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, by name, with its types. Columns the input lacks become null."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (safe_cast(_quoted(f.name), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in schema
    ])


def rejected_values(df: DataFrame, schema: T.StructType) -> list[Column]:
    """Per column of both, a count of the values that `conform` turns into null, named after the column."""
    types = {f.name: f.dataType for f in df.schema}
    return [
        F.count_if(_quoted(f.name).isNotNull() & safe_cast(_quoted(f.name), types[f.name], f.dataType).isNull())
        .alias(f.name) for f in schema if f.name in types
    ]


def count_rejected_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per column, how many values `conform` turns into null."""
    return df.agg(*rejected_values(df, schema))


_NOT_NULL_DEFAULTS = {T.StringType: "", T.BooleanType: False, T.DoubleType: 0.0}


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a null in ``columns`` and mark these columns as not null in the schema (numbers, strings,
    booleans; `count_null_keys` counts the rows)."""
    types = {f.name: f.dataType for f in df.schema}
    for name in columns:
        if not isinstance(types[name], (T.NumericType, T.StringType, T.BooleanType)):
            raise TypeError(f"{name} is of type {types[name].simpleString()}; keys are numbers, strings or booleans")
    df = df.dropna(subset=columns)
    return df.withColumns({
        name: F.coalesce(_quoted(name), F.lit(_NOT_NULL_DEFAULTS.get(type(types[name]), 0)).cast(types[name]))
        for name in columns
    })


def count_null_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many rows `require_not_null` drops."""
    return df.agg(F.count_if(reduce(or_, [_quoted(c).isNull() for c in columns])).alias("rejected"))


def fill_sentinels(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls by a marker value per column, e.g. ``{"year": -1, "url": ""}``."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({
        name: F.coalesce(_quoted(name), F.lit(value).cast(types[name])) for name, value in values.items()
    })
