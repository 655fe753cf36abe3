"""The denormalised author, article and journal tables: one row per entity with lists of neighbour ids.

Lists follow `quire.operators.lists`: ``block`` is the largest number of ids in a row. An entity with a longer list has
several rows, numbered by ``part``, that repeat its other columns; nearly all have one, part 0.
"""

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire import schemas
from quire.functions.arrays import first_element, or_empty
from quire.functions.text import parse_date, parse_list_literal, split_multivalue
from quire.operators.columns import (conform, count_null_keys, count_rejected_values, fill_sentinels, rejected_values,
                                     require_not_null, safe_cast)
from quire.operators.lists import BLOCK, attach_lists, degree
from quire.operators.rows import dedupe_first
from quire.plans.bibliography import Bibliography
from quire.sinks.tables import write_parquet

COUNTERS = ("hindex", "papercount", "citationcount")


def author_table(authors: DataFrame, articles: DataFrame, authored_by: DataFrame, sentinels: bool = False,
                 block: int = BLOCK) -> DataFrame:
    """Authors (id, affiliations and orcid as list literals, ...) with the ids of their articles, ``[]`` if none.

    Only ids of ``articles`` are listed. With ``sentinels`` missing counters become -1.
    """
    parsed = authors.withColumns({
        "affiliations": parse_list_literal(F.col("affiliations")),
        "orcid": first_element(parse_list_literal(F.col("orcid"))),
    })
    if sentinels:
        parsed = fill_sentinels(parsed, {name: -1 for name in COUNTERS})
    written = authored_by.join(articles.select(F.col("id").alias("start_id")), "start_id", "left_semi")
    table = attach_lists(parsed, "id", {"written_articles_ids": written.select("end_id", "start_id")}, block)
    return (table.withColumn("written_articles_ids", or_empty(F.col("written_articles_ids"), "array<bigint>"))
            .withColumnRenamed("id", "ID"))


def article_table(articles: DataFrame, authored_by: DataFrame, published_in: DataFrame, cites: DataFrame,
                  sentinels: bool = False, block: int = BLOCK) -> DataFrame:
    """Articles with parsed fields, author ids, journal id with number/pages/volume, and citations both ways.

    ``published_in`` is (start_id, end_id, number, pages, volume); of several journals of an article the smallest id
    counts (then number, pages and volume). A null url becomes ``[""]``; with ``sentinels`` a missing year becomes -1.
    """
    parsed = articles.withColumns({
        "ee": split_multivalue(F.col("ee")),
        "ee_type": split_multivalue(F.col("ee_type")),
        "note": split_multivalue(F.col("note")),
        "url": split_multivalue(F.col("url"), null_as_empty=True),
        "mdate": parse_date(F.col("mdate")),
    })
    if sentinels:
        parsed = fill_sentinels(parsed, {"year": -1})
    published_in = dedupe_first(published_in, ["start_id"], ["end_id", "number", "pages", "volume"])
    placed = published_in.select(F.col("start_id").alias("id"), F.col("end_id").alias("journal_id"),
                                 "number", "pages", "volume")
    parsed = parsed.drop("number", "pages", "volume").join(placed, "id", "left")
    return attach_lists(parsed, "id", {
        "authors_ids": authored_by.select("start_id", "end_id"), "citations": cites.select("start_id", "end_id"),
        "incoming_citations": cites.select("end_id", "start_id")}, block).withColumnRenamed("id", "ID")


def journal_table(journals: DataFrame, published_in: DataFrame, block: int = BLOCK) -> DataFrame:
    """Journals (id, name) with the ids of their articles and how many there are in all parts together."""
    members = published_in.select(F.col("end_id").alias("id"), "start_id").dropna()
    counted = journals.join(degree(members, "id", "NumArticles"), "id", "left")
    return attach_lists(counted, "id", {"Articles": members}, block).withColumnRenamed("id", "journal_id")


_STORED = {"article": (schemas.ARTICLE, "ID"), "author": (schemas.AUTHOR, "ID"), "journal": (schemas.JOURNAL, "journal_id")}


def _final_schema(schema, raw: DataFrame):
    """The schema of a stored table; ``part`` only where the table has it."""
    return T.StructType([f for f in schema if f.name != "part" or "part" in raw.columns])


def load_bibliography(spark: SparkSession, folder: str) -> Bibliography:
    """Read article, author and journal Parquet tables with their final types and non-null keys.

    Rows without a key are left out and values that do not parse become null; `rejected_on_load` counts both in a
    scan of its own, `import_bibliography` while it reads.
    """
    def table(name):
        schema, key = _STORED[name]
        raw = spark.read.parquet(f"{folder}/{name}")
        return require_not_null(conform(raw, _final_schema(schema, raw)), [key])
    return Bibliography.from_tables(table("article"), table("author"), table("journal"))


def rejected_on_load(spark: SparkSession, folder: str) -> DataFrame:
    """(table, column, rejected): what `load_bibliography` drops (rows, at the key) and turns into null (values)."""
    counts = []
    for name, (schema, key) in _STORED.items():
        raw = spark.read.parquet(f"{folder}/{name}")
        final = _final_schema(schema, raw)
        values = count_rejected_values(raw, final)
        keys = count_null_keys(conform(raw, final), [key]).select(F.lit("row without key").alias("column"), "rejected")
        columns = values.unpivot([], values.columns, "column", "rejected")
        counts.append(columns.unionByName(keys).withColumn("table", F.lit(name)))
    return reduce(DataFrame.unionByName, counts).filter("rejected > 0").select("table", "column", "rejected")


def import_bibliography(spark: SparkSession, source: str, target: str) -> tuple[Bibliography, DataFrame]:
    """Write the tables of ``source`` to ``target`` as `load_bibliography` reads them; the rejects come from the same scan.

    Returns the bibliography over ``target``, whose scans are pruned and filtered, and what `rejected_on_load` returns
    for ``source``. ``target`` must not exist.
    """
    rejects = []
    for name, (schema, key) in _STORED.items():
        raw = spark.read.parquet(f"{source}/{name}")
        final, counts = _final_schema(schema, raw), Observation()
        keyless = (safe_cast(F.col(key), raw.schema[key].dataType, final[key].dataType).isNull() if key in raw.columns
                   else F.lit(True))
        observed = raw.observe(counts, F.count_if(keyless).alias("row without key"), *rejected_values(raw, final))
        write_parquet(require_not_null(conform(observed, final), [key]), f"{target}/{name}")
        rejects += [(name, column, rejected) for column, rejected in counts.get.items() if rejected]
    return (load_bibliography(spark, target),
            spark.createDataFrame(rejects, "table string, column string, rejected long"))
