"""Sources and sinks: whole driver tables are written to scratch space, read back and compared."""

from pyspark.sql import functions as F

from quire.operators.lists import adjacency_lists
from quire.plans.tables import import_bibliography
from quire.sinks import documents as JS
from quire.sinks import tables as TS
from quire.sources.documents import read_json_docs, read_jsonl
from quire.sources.tables import read_parquet, read_table, read_with_header_file

from checks.registry import query, scratch
from checks.views import cites, table, with_views


@query("SELECT doc_id, text, lang FROM documents")
def csv_roundtrip(spark, folder):
    """Texts with separators, quotes and line breaks."""
    documents, path = table(spark, folder, "documents").select("doc_id", "text", "lang"), scratch(spark, "csv")
    TS.write_table(documents, path)
    return read_table(spark, path, documents.schema, multi_line=True)


@query("SELECT doc_id, text, lang FROM documents")
def tsv_roundtrip(spark, folder):
    documents, path = table(spark, folder, "documents").select("doc_id", "text", "lang"), scratch(spark, "tsv")
    TS.write_table(documents, path, sep="\t")
    return read_table(spark, path, documents.schema, sep="\t", multi_line=True)


@query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_inferred(spark, folder):
    path = scratch(spark, "csv")
    TS.write_table(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return read_table(spark, path)


@query("SELECT p_partkey AS id, p_name AS title, p_brand || ',' || p_type AS ee, p_size AS year FROM part")
def sidecar_header(spark, folder):
    """Graph export and the reader for headerless data with a header file."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.array("p_brand", "p_type").alias("ee"),
        F.col("p_size").alias("year"))
    path = scratch(spark, "graph")
    listing = TS.export_graph(spark, {"Publication:Article": parts}, {}, path).first()
    return read_with_header_file(spark, listing.data, listing.header).withColumn("ee", F.array_join("ee", ","))


@query(with_views("cites", "SELECT start_id, end_id FROM cites"))
def graph_export(spark, folder):
    path = scratch(spark, "graph")
    listing = TS.export_graph(spark, {}, {"CITES": cites(spark, folder)}, path).first()
    return read_with_header_file(spark, listing.data, listing.header)


@query("SELECT doc_id, text, lang FROM documents")
def jsonl_roundtrip(spark, folder):
    documents, path = table(spark, folder, "documents").select("doc_id", "text", "lang"), scratch(spark, "jsonl")
    JS.write_documents(documents, path)
    return read_jsonl(spark, path, documents.schema)


@query("""SELECT p_partkey AS id, i, CASE i % 4 WHEN 0 THEN p_name || '|' || p_brand WHEN 1 THEN NULL
        WHEN 2 THEN '' ELSE chr(92) || p_type || chr(92) || 'n' END AS element, p_partkey % 3 AS kind,
        CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS price
    FROM part, (SELECT unnest(range(0, 4)) AS i) WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, CAST(p_partkey % 3 - 3 AS BIGINT), NULL, p_partkey % 3, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE)
    FROM part WHERE p_partkey % 3 > 0""")
def graph_export_without_loss(spark, folder):
    """Array elements that are null, empty or hold separators and backslashes; null and empty arrays; float columns."""
    backslash = F.lit("\\")
    kind = F.col("p_partkey") % 3
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(kind == 0, F.array(F.concat_ws("|", "p_name", "p_brand"), F.lit(None).cast("string"), F.lit(""),
                                  F.concat(backslash, "p_type", backslash, F.lit("n"))))
        .when(kind == 1, F.array().cast("array<string>")).alias("list"), F.col("p_retailprice").cast("float").alias("price"))
    listing = TS.export_graph(spark, {"Part": parts}, {}, scratch(spark, "graph")).first()
    back = read_with_header_file(spark, listing.data, listing.header)
    return back.select("id", F.col("price").cast("double").alias("price"), (F.col("id") % 3).alias("kind"), F.expr(
        "inline(CASE WHEN list IS NULL THEN array(struct(-1L AS i, CAST(NULL AS STRING) AS element)) "
        "WHEN size(list) = 0 THEN array(struct(-2L AS i, CAST(NULL AS STRING) AS element)) "
        "ELSE transform(list, (x, i) -> struct(CAST(i AS BIGINT) AS i, x AS element)) END)"))


@query(with_views("cites", "SELECT start_id, end_id FROM cites"))
def edge_export_end_first(spark, folder):
    """An edge table whose first column is the end."""
    listing = TS.export_graph(spark, {}, {"CITES": cites(spark, folder).select("end_id", "start_id")},
                              scratch(spark, "graph")).first()
    return read_with_header_file(spark, listing.data, listing.header)


def _json(*columns):
    return F.to_json(F.struct(*columns))


@query("SELECT item_id, text, 'item-' || item_id AS doc_key FROM benchmark")
def json_doc_files(spark, folder):
    """A folder with one JSON document per file, named after it."""
    items, path = table(spark, folder, "benchmark"), scratch(spark, "docs")
    items.select(F.concat(F.lit("item-"), F.col("item_id").cast("string")).alias("doc"), _json("item_id", "text")
                 ).write.partitionBy("doc").text(path)
    docs = read_json_docs(spark, path, items.select("item_id", "text").schema, pattern="*.txt")
    return docs.select("item_id", "text", F.col("doc").alias("doc_key"))


@query("SELECT doc_id, text, lang FROM documents")
def json_array_files(spark, folder):
    """Files with one array of about a hundred documents each."""
    documents, path = table(spark, folder, "documents").select("doc_id", "text", "lang"), scratch(spark, "arrays")
    block = F.floor(F.col("doc_id") / 100).alias("block")
    arrays = documents.groupBy(block).agg(F.collect_list(_json("doc_id", "text", "lang")).alias("each"))
    arrays.select("block", F.concat(F.lit("["), F.array_join("each", ",\n"), F.lit("]"))).write.partitionBy(
        "block").text(path)
    return read_json_docs(spark, path, documents.schema, pattern="*.txt").select("doc_id", "text", "lang")


@query(with_views("cites", "SELECT start_id, end_id FROM cites"))
def parquet_roundtrip(spark, folder):
    path = scratch(spark, "lists")
    TS.write_parquet(adjacency_lists(cites(spark, folder), "start_id", "end_id", "citations", block=4), path)
    return read_parquet(spark, path).select("start_id", F.explode("citations").alias("end_id"))


@query("SELECT c_custkey, c_name FROM customer")
def materialize_once(spark, folder):
    """The second call finds the table and does not build it again."""
    path = scratch(spark, "table")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    TS.materialize(spark, lambda: customers, path)
    return TS.materialize(spark, lambda: customers.limit(0), path)


@query("""
SELECT 'article' AS kind, 'row without key' AS field, count(*) AS n FROM orders WHERE o_orderstatus = 'P' HAVING n > 0
UNION ALL SELECT 'article', 'year', count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' HAVING n > 0
UNION ALL SELECT 'author', 'ID', count(*) AS n FROM customer WHERE c_acctbal < 0 HAVING n > 0
UNION ALL SELECT 'author', 'row without key', count(*) AS n FROM customer WHERE c_acctbal < 0 HAVING n > 0
UNION ALL SELECT 'article', 'rows loaded', count(*) FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'article', 'years loaded', count(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'
UNION ALL SELECT 'author', 'rows loaded', count(*) FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'journal', 'rows loaded', count(*) FROM supplier""")
def import_with_rejects(spark, folder):
    """Tables of raw texts, some without a key or with a year that is none: what is loaded and what is rejected."""
    raw, target = scratch(spark, "raw"), scratch(spark, "imported")
    TS.write_parquet(table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("ID"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "unknown").otherwise(
            F.year("o_orderdate").cast("string")).alias("year")), f"{raw}/article")
    TS.write_parquet(table(spark, folder, "customer").select(
        F.concat(F.when(F.col("c_acctbal") < 0, "x").otherwise(""), F.col("c_custkey").cast("string")).alias("ID"),
        F.col("c_name").alias("name")), f"{raw}/author")
    TS.write_parquet(table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("journal_id"), F.col("s_name").alias("name")), f"{raw}/journal")
    bib, rejects = import_bibliography(spark, raw, target)
    loaded = [bib.articles.agg(F.lit("article"), F.lit("rows loaded"), F.count("*")),
              bib.articles.agg(F.lit("article"), F.lit("years loaded"), F.count("year")),
              bib.authors.agg(F.lit("author"), F.lit("rows loaded"), F.count("*")),
              bib.journals.agg(F.lit("journal"), F.lit("rows loaded"), F.count("*"))]
    for counts in loaded:
        rejects = rejects.union(counts)
    return rejects.toDF("kind", "field", "n")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def materialize_after_a_lost_writer(spark, folder):
    """A writer that died before its record is ignored, the newest version is read."""
    path, orders = scratch(spark, "table"), table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    TS.write_parquet(orders.filter("o_orderkey % 2 = 0"), f"{path}/data-lost")
    TS.materialize(spark, lambda: orders.filter("o_orderkey % 2 = 1"), path)
    return TS.materialize(spark, lambda: orders, path, overwrite=True)
