"""Column expressions over arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row. Without this the optimizer may copy the expression behind
    the value into the lambdas that use it, where it runs again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def first_element(values: Column) -> Column:
    """First element; null for an empty or null array."""
    return F.get(values, 0)


def list_size(values: Column) -> Column:
    """Number of elements; 0 for null."""
    return F.coalesce(F.size(values), F.lit(0))


def or_empty(values: Column, kind: str) -> Column:
    """The array, or an empty one of the given type for null."""
    return F.coalesce(values, F.array().cast(kind))


def distinct_field(structs: Column, field: str) -> Column:
    """Values of one field without repeats, in order of first appearance; ``[]`` for null."""
    return or_empty(F.array_distinct(F.transform(structs, lambda x: x[field])), "array<string>")


def without_null_values(entries: Column) -> Column:
    """A map without its null values (the JSON writer leaves out null struct fields, but not these)."""
    return F.map_filter(entries, lambda _, value: value.isNotNull())


def extended_json_date(date: Column) -> Column:
    """``{"$date": ...}``, the form in which document stores take dates."""
    return F.struct(date.alias("$date"))
