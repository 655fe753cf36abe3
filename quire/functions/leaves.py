"""Nested rows as flat ones: a row for every value, with the path that leads to it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENTRY = "array<struct<path: string, value: string>>"


def _entries(value: Column, kind: T.DataType, path: list[Column]) -> tuple[list[Column], list[Column]]:
    """The values inside a column: entries of single ones, and arrays of entries of repeated ones."""
    if isinstance(kind, T.StructType):
        inside = [_entries(value[f.name], f.dataType, [*path, F.lit(f".{f.name}")]) for f in kind]
        return [e for single, _ in inside for e in single], [a for _, repeated in inside for a in repeated]
    if isinstance(kind, T.ArrayType):
        return [], [_of_items(value, kind.elementType, path, lambda x, i: (x, i))]
    if isinstance(kind, T.MapType):
        return [], [_of_items(F.map_entries(value), kind.valueType, path, lambda e, i: (e["value"], e["key"]))]
    return [F.struct(F.concat(*path).alias("path"), value.cast("string").alias("value"))], []


def _of_items(items: Column, kind: T.DataType, path: list[Column], pick) -> Column:
    """Array of the entries of all items; ``pick`` gives the value of an item and its place."""
    several = isinstance(kind, T.StructType | T.ArrayType | T.MapType)
    def of_one(item, i):
        value, place = pick(item, i)
        single, repeated = _entries(value, kind, [*path, F.lit("["), place.cast("string"), F.lit("]")])
        return _joined(single, repeated) if several else single[0]
    made = F.transform(items, of_one)
    return F.coalesce((F.flatten(made) if several else made).cast(_ENTRY), F.array().cast(_ENTRY))


def _joined(single: list[Column], repeated: list[Column]) -> Column:
    return F.concat(F.array(*single).cast(_ENTRY), *repeated)


def entries(df: DataFrame, names: list[str]) -> Column:
    """Array of the (path, value) of all values inside columns: fields as ``.name``, elements as ``[position]``, map
    values as ``[key]``. Values are texts; empty arrays and empty structs have none, nulls of a plain type are among
    them. All values of a struct make one array, so that few small ones are built."""
    found = [_entries(F.col(f"`{name}`"), df.schema[name].dataType, [F.lit(name)]) for name in names]
    return _joined([e for single, _ in found for e in single], [a for _, repeated in found for a in repeated])


def leaf_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, value): a row for every value of the other columns, whatever their nesting.

    Two tables are equal, nulls and empty arrays apart, if these rows are; and rows compare where nested values do not.
    """
    made = entries(df, [name for name in df.columns if name not in keys])
    rows = df.select(*keys, F.explode(made).alias("_entry")).filter(F.col("_entry.value").isNotNull())
    return rows.select(*keys, "_entry.path", "_entry.value")
