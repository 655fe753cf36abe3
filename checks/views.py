"""The driver tables as a bibliography.

    article      orders that are not pending: id, title = priority, year of the date, journal = customer
    author       suppliers with nation and region as affiliations and the floored balance as citation count
    journal      customers: name and market segment
    authored_by  distinct (order, supplier) of the line items; pending orders are publications other than articles
    cites        distinct (order, part * line number) of the line items, read as citing and cited article

`cites` grows with the line items and has cited articles of very different degree, as a product has several
ways to come about.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.bibliography import Bibliography


_SCHEMAS = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. Its schema is read once per process, so that later queries need not open the file for it."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("article_id"), F.col("o_orderpriority").alias("title"),
        F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("journal_id"),
        F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("url"))


def authors(spark: SparkSession, folder: str) -> DataFrame:
    places = (table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return (table(spark, folder, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("name"),
                    F.floor("s_acctbal").cast("int").alias("citationcount"),
                    F.array("n_name", "r_name").alias("affiliations")))


def journals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("journal_id"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("name"))


def authored_by(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("article_id"), F.col("l_suppkey").alias("author_id")).distinct()


def raw_cites(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("start_id"), (F.col("l_partkey") * F.col("l_linenumber")).alias("end_id"))


def cites(spark: SparkSession, folder: str) -> DataFrame:
    return raw_cites(spark, folder).distinct()


def bibliography(spark: SparkSession, folder: str) -> Bibliography:
    return Bibliography(
        authors(spark, folder), articles(spark, folder), journals(spark, folder),
        authored_by(spark, folder), cites(spark, folder))


# The same views for the SQL side.
SQL_VIEWS = {
    "article": """SELECT o_orderkey AS article_id, o_orderpriority AS title,
        CAST(year(o_orderdate) AS INTEGER) AS yr, o_custkey AS journal_id,
        'o/' || CAST(o_orderkey AS VARCHAR) AS url FROM orders WHERE o_orderstatus <> 'P'""",
    "author": """SELECT s_suppkey AS author_id, s_name AS name, CAST(floor(s_acctbal) AS INTEGER) AS citationcount,
        n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "journal": "SELECT c_custkey AS journal_id, c_name || ' ' || c_mktsegment AS name FROM customer",
    "authored_by": "SELECT DISTINCT l_orderkey AS article_id, l_suppkey AS author_id FROM lineitem",
    "raw_cites": "SELECT l_orderkey AS start_id, l_partkey * l_linenumber AS end_id FROM lineitem",
    "cites": "SELECT DISTINCT l_orderkey AS start_id, l_partkey * l_linenumber AS end_id FROM lineitem",
    "incoming": """SELECT end_id AS article_id, count(*) AS n FROM (
        SELECT DISTINCT l_orderkey AS start_id, l_partkey * l_linenumber AS end_id FROM lineitem) GROUP BY end_id""",
}


def with_views(names: str, body: str) -> str:
    """SQL text with the named views in front."""
    return "WITH " + ", ".join(f"{name} AS ({SQL_VIEWS[name]})" for name in names.split()) + body
