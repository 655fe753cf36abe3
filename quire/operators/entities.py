"""Enriching entities from an external source that knows them under several aliases."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.rows import dedupe_first


def alias_records(extra: DataFrame, alias_col: str, order_col: str) -> DataFrame:
    """One record per alias: the alias list is exploded, and the lowest ``order_col`` wins an alias that several
    records share. Deciding this before any join keeps common names from multiplying."""
    by_alias = extra.select(F.explode(alias_col).alias("alias"), *[c for c in extra.columns if c != alias_col])
    return dedupe_first(by_alias.filter("alias IS NOT NULL"), ["alias"], [order_col])


def alias_join(base: DataFrame, extra: DataFrame, name_col: str, alias_col: str, order_col: str) -> DataFrame:
    """Left join of each base row with the external record that lists its name among the aliases."""
    records = alias_records(extra, alias_col, order_col).withColumnRenamed("alias", "_alias")
    return base.join(records, base[name_col] == records["_alias"], "left").drop("_alias")


def enrich_entities(base: DataFrame, extra: DataFrame, alias_col: str, order_col: str, id_col: str = "id",
                    name_col: str = "name", drop: tuple[str, ...] = ()) -> DataFrame:
    """Base rows (id, name) with the attributes of the matching external record; rows without one keep nulls.

    The external name replaces the base name where there is one. Ids of ``base`` are unique.
    """
    extra = extra.withColumnRenamed(name_col, "_name")
    joined = alias_join(base.withColumnRenamed(name_col, "_base_name"), extra, "_base_name", alias_col, order_col)
    attributes = [c for c in extra.columns if c not in ("_name", alias_col, order_col, *drop)]
    return joined.select(id_col, F.coalesce("_name", "_base_name").alias(name_col), *attributes)
