"""Edge operators, entity enrichment, denormalised tables and the whole graph on the driver tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.leaves import leaf_rows
from quire.operators import edges as E
from quire.operators.entities import enrich_entities
from quire.operators.lists import adjacency_lists as make_lists
from quire.plans import analytics as A
from quire.plans import tables as T
from quire.plans.bibliography import Bibliography
from quire.plans.graph import build_graph
from quire.sinks.tables import write_parquet

from checks.registry import query, scratch
from checks.views import authored_by, authors, cites, journals, raw_cites, table, with_views


def _orders(spark, folder):
    return table(spark, folder, "orders")


def _excluded(spark, folder):
    return _orders(spark, folder).filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))


def _authored_edges(spark, folder):
    return authored_by(spark, folder).select(
        F.col("article_id").alias("start_id"), F.col("author_id").alias("end_id"))


def _texts(column):
    """A list column as text, for comparison."""
    return F.array_join(F.col(column).cast("array<string>"), ",")


@query("SELECT o_orderkey AS id, o_orderpriority AS key FROM orders")
def union_publications(spark, folder):
    orders = _orders(spark, folder)
    return E.publication_keys([orders.filter(F.col("o_orderstatus") == s) for s in ("F", "O", "P")],
                              "o_orderkey", "o_orderpriority")


@query(with_views("raw_cites", """
SELECT start_id, CASE WHEN o_orderstatus = 'F' THEN 'o/' || end_id ELSE o_orderstatus END AS key
FROM raw_cites JOIN orders ON end_id = o_orderkey WHERE o_orderstatus <> 'P'"""))
def citation_keys(spark, folder):
    status = F.col("o_orderstatus")
    key = (F.when(status == "F", F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")))
           .when(status == "O", "O").otherwise("..."))
    cite = _orders(spark, folder).select(F.col("o_orderkey").alias("end_id"), key.alias("key"))
    return E.citation_keys(raw_cites(spark, folder), cite)


@query(with_views("raw_cites", """
SELECT start_id, end_id FROM raw_cites JOIN orders ON end_id = o_orderkey WHERE o_orderstatus = 'F'"""))
def resolve_edges(spark, folder):
    keyed = raw_cites(spark, folder).select(
        "start_id", F.concat(F.lit("o/"), F.col("end_id").cast("string")).alias("key"))
    keys = _orders(spark, folder).filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("key"))
    return E.resolve_edges(keyed, keys)


@query("""SELECT o_orderkey AS start_id, c_custkey AS end_id, o_orderpriority AS pages
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY'""")
def child_parent_edges(spark, folder):
    child = _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("crossref"), F.col("o_orderpriority").alias("pages"))
    parent = (table(spark, folder, "customer").filter("c_mktsegment = 'MACHINERY'")
              .select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("key")))
    return E.child_parent_edges(child, parent, "crossref", "key", ["pages"])


@query(with_views("authored_by", """
SELECT article_id AS start_id, author_id AS end_id, o_orderpriority AS pages, o_totalprice AS volume
FROM authored_by JOIN orders ON article_id = o_orderkey"""))
def edge_properties(spark, folder):
    nodes = _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("pages"), F.col("o_totalprice").alias("volume"))
    return E.push_props_to_edge(_authored_edges(spark, folder), nodes, ["pages", "volume"])


@query(with_views("authored_by", """
SELECT article_id AS start_id, author_id AS end_id,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'O' END AS volume
FROM authored_by JOIN orders ON article_id = o_orderkey WHERE o_orderstatus IN ('F', 'O')"""))
def edge_properties_union(spark, folder):
    orders = _orders(spark, folder).withColumnRenamed("o_orderkey", "id")
    books = orders.filter("o_orderstatus = 'F'").select("id", F.col("o_orderpriority").alias("volume"))
    others = orders.filter("o_orderstatus = 'O'").select("id", F.col("o_orderstatus").alias("volume"))
    return E.push_props_to_edge(_authored_edges(spark, folder), books.unionByName(others), ["volume"])


@query(with_views("authored_by", """
SELECT article_id AS start_id, author_id AS end_id FROM authored_by
WHERE article_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"""))
def drop_edges_start(spark, folder):
    return E.drop_edges(_authored_edges(spark, folder), _excluded(spark, folder), ("start",))


@query(with_views("cites", """,
excluded AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
SELECT start_id, end_id FROM cites
WHERE start_id NOT IN (SELECT * FROM excluded) AND end_id NOT IN (SELECT * FROM excluded)"""))
def drop_edges_both(spark, folder):
    return E.drop_edges(cites(spark, folder), _excluded(spark, folder))


@query("""SELECT DISTINCT l_orderkey AS start_id, l_partkey * l_linenumber AS end_id FROM lineitem
    WHERE l_orderkey <> l_partkey * l_linenumber""")
def proper_edges(spark, folder):
    return E.proper_edges(raw_cites(spark, folder))


@query(with_views("incoming", """
SELECT o_orderkey AS id, o_orderpriority AS title, coalesce(n, 0) AS referencecount
FROM orders LEFT JOIN incoming ON o_orderkey = article_id"""))
def recount_in_degree(spark, folder):
    nodes = _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), F.lit(7).alias("referencecount"))
    return E.recount_in_degree(nodes, cites(spark, folder), "id", "referencecount")


def _in_parts(edges, key, item, block):
    """SQL: (key, part, ids) of lists cut after every `block` items."""
    return f"""SELECT {key}, CAST(part AS INTEGER) AS part, string_agg({item}, ',' ORDER BY {item}) AS ids
    FROM (SELECT {key}, {item}, (row_number() OVER (PARTITION BY {key} ORDER BY {item}) - 1) // {block} AS part
          FROM {edges}) GROUP BY {key}, part"""


@query(with_views("cites", f"""
SELECT start_id, part, ids AS citations FROM ({_in_parts("cites", "start_id", "end_id", 6)})"""))
def adjacency_lists(spark, folder):
    lists = make_lists(cites(spark, folder), "start_id", "end_id", "citations", block=6)
    return lists.withColumn("citations", _texts("citations"))


@query(with_views("raw_cites", f"""
SELECT end_id, part, ids AS incoming FROM ({_in_parts("raw_cites", "end_id", "start_id", 3)})"""))
def adjacency_lists_in_parts(spark, folder):
    """Lists with repeated edges in parts of three."""
    lists = make_lists(raw_cites(spark, folder), "end_id", "start_id", "incoming", block=3)
    return lists.withColumn("incoming", _texts("incoming"))


@query("""WITH alias AS (SELECT s_suppkey, s_name AS alias FROM supplier
    UNION SELECT s_suppkey, upper(s_name) AS alias FROM supplier
    UNION SELECT s_suppkey, 'NATION ' || s_nationkey AS alias FROM supplier),
first AS (SELECT alias, min(s_suppkey) AS s_suppkey FROM alias GROUP BY alias),
base AS (SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'NATION ' || c_nationkey
         ELSE replace(upper(c_name), 'CUSTOMER', 'SUPPLIER') END AS name FROM customer)
SELECT id, coalesce(s_name, name) AS name, s_acctbal AS hindex
FROM base LEFT JOIN first ON name = alias LEFT JOIN supplier USING (s_suppkey)""")
def enrich_authors(spark, folder):
    customer, supplier = table(spark, folder, "customer"), table(spark, folder, "supplier")
    by_nation = lambda key: F.concat(F.lit("NATION "), F.col(key).cast("string"))
    base = customer.select(F.col("c_custkey").alias("id"), F.when(
        F.col("c_mktsegment") == "MACHINERY", by_nation("c_nationkey")).otherwise(
        F.replace(F.upper("c_name"), F.lit("CUSTOMER"), F.lit("SUPPLIER"))).alias("name"))
    extra = supplier.select(
        F.col("s_suppkey").alias("authorid"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("hindex"),
        F.lit("x").alias("updated"),
        F.array("s_name", F.upper("s_name"), by_nation("s_nationkey")).alias("dblp"))
    return enrich_entities(base, extra, "dblp", "authorid", drop=("updated",))


def _raw_authors(spark, folder):
    """Authors as they come from the external file: lists as literals, counters with gaps."""
    return authors(spark, folder).select(
        F.col("author_id").alias("id"), "name",
        F.concat(F.lit("['"), F.array_join("affiliations", "', \""), F.lit("\"]")).alias("affiliations"),
        F.when(F.col("citationcount") > 1000, F.concat(F.lit("['"), "name", F.lit("', 'second']"))).alias("orcid"),
        F.when(F.col("citationcount") > 0, F.col("citationcount")).alias("hindex"),
        F.col("citationcount").alias("papercount"), F.lit(None).cast("int").alias("citationcount"))


def _raw_articles(spark, folder):
    status = F.col("o_orderstatus")
    return _orders(spark, folder).filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("key"),
        F.col("o_orderpriority").alias("title"), F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("ee"),
        F.concat_ws("|", "o_orderstatus", "o_orderpriority").alias("ee_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("mdate"),
        F.when(status == "F", F.col("o_orderpriority")).alias("note"), F.when(status == "F", F.lit("a|b")).alias("url"),
        F.when(status == "F", F.year("o_orderdate")).alias("year"),
        F.lit("x").alias("number"), F.lit("x").alias("pages"), F.lit("x").alias("volume"))


def _published_in(spark, folder):
    """Articles of other status than O in the journal of their customer."""
    return _orders(spark, folder).filter("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("start_id"), F.col("o_custkey").alias("end_id"),
        F.col("o_orderstatus").alias("number"), F.col("o_orderpriority").alias("pages"),
        F.concat("o_orderstatus", F.lit("1")).alias("volume"))


@query(with_views("author authored_by", f""",
known AS (SELECT author_id, article_id FROM authored_by JOIN orders ON article_id = o_orderkey WHERE o_orderstatus <> 'P'),
written AS ({_in_parts("known", "author_id", "article_id", 640)})
SELECT author_id AS "ID", coalesce(part, CAST(0 AS INTEGER)) AS part, name, n_name || ',' || r_name AS affiliations,
    CASE WHEN citationcount > 1000 THEN name END AS orcid,
    CASE WHEN citationcount > 0 THEN citationcount ELSE -1 END AS hindex, citationcount AS papercount,
    CAST(-1 AS INTEGER) AS citationcount, coalesce(ids, '') AS written_articles_ids
FROM author LEFT JOIN written USING (author_id)"""))
def author_table(spark, folder):
    made = T.author_table(_raw_authors(spark, folder), _raw_articles(spark, folder),
                          _authored_edges(spark, folder), sentinels=True, block=640)
    return made.withColumns({c: _texts(c) for c in ("affiliations", "written_articles_ids")})


@query(with_views("authored_by cites", f""",
writers AS ({_in_parts("authored_by", "article_id", "author_id", 12)}),
outgoing AS ({_in_parts("cites", "start_id", "end_id", 12)}),
arriving AS ({_in_parts("cites", "end_id", "start_id", 12)}),
parts AS (SELECT id, max(part) AS last FROM (SELECT article_id AS id, part FROM writers UNION ALL
    SELECT start_id, part FROM outgoing UNION ALL SELECT end_id, part FROM arriving) GROUP BY id),
article_parts AS (SELECT orders.*, CAST(unnest(range(0, coalesce(last, 0) + 1)) AS INTEGER) AS part
    FROM orders LEFT JOIN parts ON o_orderkey = id)
SELECT o_orderkey AS "ID", p.part, 'o/' || o_orderkey AS key, o_orderpriority AS title,
    o_orderpriority || ',' || o_orderstatus AS ee, o_orderstatus || ',' || o_orderpriority AS ee_type,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS note,
    CASE WHEN o_orderstatus = 'F' THEN 'F1' END AS volume, strftime(o_orderdate, '%Y-%m-%d') AS mdate,
    CASE WHEN o_orderstatus = 'F' THEN 'a,b' ELSE '' END AS url,
    CAST(CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) END AS INTEGER) AS year,
    CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS journal_id,
    CASE WHEN o_orderstatus = 'F' THEN 'F' END AS number,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS pages,
    writers.ids AS authors_ids, outgoing.ids AS citations, arriving.ids AS incoming_citations
FROM article_parts p LEFT JOIN writers ON o_orderkey = article_id AND p.part = writers.part
LEFT JOIN outgoing ON o_orderkey = start_id AND p.part = outgoing.part
LEFT JOIN arriving ON o_orderkey = end_id AND p.part = arriving.part WHERE o_orderstatus <> 'P'"""))
def article_table(spark, folder):
    made = T.article_table(_raw_articles(spark, folder), _authored_edges(spark, folder),
                           _published_in(spark, folder), cites(spark, folder), block=12)
    lists = ("ee", "ee_type", "note", "url", "authors_ids", "citations", "incoming_citations")
    return made.withColumns({c: _texts(c) for c in lists}).withColumn("mdate", F.col("mdate").cast("string"))


@query(with_views("journal", f""",
published AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus <> 'O'),
counts AS (SELECT o_custkey, count(*) AS n FROM published GROUP BY o_custkey),
members AS ({_in_parts("published", "o_custkey", "o_orderkey", 12)})
SELECT journal_id, coalesce(part, CAST(0 AS INTEGER)) AS part, name, n AS "NumArticles", ids AS "Articles"
FROM journal LEFT JOIN counts c ON journal_id = c.o_custkey LEFT JOIN members m ON journal_id = m.o_custkey"""))
def venue_article_lists(spark, folder):
    made = T.journal_table(journals(spark, folder).withColumnRenamed("journal_id", "id"), _published_in(spark, folder),
                           block=12)
    return made.withColumn("Articles", _texts("Articles"))


def bibliography_from_tables(spark, folder):
    """The detour over tables with list columns, in several parts."""
    published = _published_in(spark, folder)
    articles = T.article_table(_raw_articles(spark, folder), _authored_edges(spark, folder), published,
                               cites(spark, folder), block=4)
    people = T.author_table(_raw_authors(spark, folder), _raw_articles(spark, folder),
                            _authored_edges(spark, folder), block=100)
    venues = T.journal_table(journals(spark, folder).withColumnRenamed("journal_id", "id"), published, block=5)
    return Bibliography.from_tables(articles, people, venues)


@query(with_views("author authored_by incoming", """,
ranked AS (SELECT author_id, n, row_number() OVER (PARTITION BY author_id ORDER BY n DESC) AS rn
           FROM authored_by JOIN incoming USING (article_id) JOIN orders ON article_id = o_orderkey
           WHERE o_orderstatus <> 'P'),
best AS (SELECT author_id, max(rn) AS h FROM ranked WHERE n >= rn GROUP BY author_id)
SELECT author_id, name, coalesce(h, 0) AS h_index FROM author LEFT JOIN best USING (author_id)"""))
def h_index_from_stored_tables(spark, folder):
    """Tables with list columns are written, loaded with their final types, and queried."""
    path = scratch(spark, "tables")
    published = _published_in(spark, folder)
    write_parquet(T.article_table(_raw_articles(spark, folder), _authored_edges(spark, folder), published,
                                  cites(spark, folder), block=10), f"{path}/article")
    write_parquet(T.author_table(_raw_authors(spark, folder), _raw_articles(spark, folder),
                                 _authored_edges(spark, folder), block=300), f"{path}/author")
    write_parquet(T.journal_table(journals(spark, folder).withColumnRenamed("journal_id", "id"), published, block=10),
                  f"{path}/journal")
    return A.h_index(T.load_bibliography(spark, path))


@query(with_views("incoming", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS articles
FROM orders JOIN incoming ON o_orderkey = article_id WHERE n >= 11 AND o_orderstatus = 'F'
GROUP BY year(o_orderdate) HAVING count(*) >= 21"""))
def years_with_cited_articles_from_tables(spark, folder):
    return A.years_with_cited_articles(bibliography_from_tables(spark, folder), 21, 11)


# Which publication type stands for which order priority.
_TYPES = {"article": "1-URGENT", "book": "2-HIGH", "incollection": "3-MEDIUM", "inproceedings": "4-NOT SPECIFIED",
          "proceedings": "5-LOW"}


_NAMED = ("editor", "publisher", "journal", "school", "series", "mastersthesis")


def _raw_graph_tables(spark, folder):
    orders = _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("key"),
        F.col("o_orderstatus").alias("title"), F.col("o_orderpriority").alias("number"),
        F.col("o_custkey").cast("string").alias("pages"), F.col("o_orderstatus").alias("volume"),
        F.concat(F.lit("o/"), F.col("o_custkey").cast("string")).alias("crossref"))
    tables = {name: orders.filter(F.col("number") == priority) for name, priority in _TYPES.items()}
    supplier = table(spark, folder, "supplier")
    authored = _authored_edges(spark, folder)
    venue = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("start_id"), F.col("o_custkey").alias("end_id"))
    targets = orders.select(F.col("id").alias("end_id"), F.when(
        F.col("title") == "O", F.lit("...")).otherwise(F.col("key")).alias("key"))
    names = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    # Every small label has its own share of the suppliers.
    nodes = {name: names.filter(F.col("id") % 6 == no) for no, name in enumerate(_NAMED)}
    # Publications have every property that some label keeps.
    more = {name: F.concat(F.lit(f"{name} "), "key") for name in ("ee", "ee_type", "cdate", "note", "note_type", "url",
                                                                 "booktitle", "isbn")}
    tables = {name: df.withColumns(more | {"mdate": F.lit("2020-01-01"), "year": (F.col("id") % 50 + 1970).cast("int")})
              for name, df in tables.items()}
    return tables | nodes | {
        "phdthesis": tables["book"], "author": names,
        "homepage": orders.filter("title = 'P'"),
        "external_author": supplier.select(
            F.col("s_suppkey").alias("authorid"), F.lit("").alias("externalids"),
            F.concat(F.lit("['"), "s_name", F.lit("']")).alias("dblp"), F.upper("s_name").alias("name"),
            F.lit("").alias("aliases"), F.col("s_acctbal").alias("hindex"), F.lit("").alias("updated")),
        "has_citation": raw_cites(spark, folder), "cite": targets, "authored_by": authored,
        "published_by": authored, "edited_by": authored, "published_in": venue, "is_part_of": venue,
        "submitted_at": venue,
    }


@query(with_views("raw_cites authored_by", """,
pub AS (SELECT o_orderkey AS id, o_orderpriority AS kind, o_orderstatus AS status, o_custkey AS parent FROM orders),
home AS (SELECT id FROM pub WHERE status = 'P'), incoll AS (SELECT id FROM pub WHERE kind = '3-MEDIUM'),
outside AS (SELECT id FROM home UNION SELECT id FROM incoll)
SELECT 'CITES' AS kind, start_id, end_id, CAST(NULL AS VARCHAR) AS number, CAST(NULL AS VARCHAR) AS pages,
    CAST(NULL AS VARCHAR) AS volume FROM raw_cites JOIN pub ON end_id = id
    WHERE status <> 'O' AND start_id NOT IN (SELECT id FROM outside) AND end_id NOT IN (SELECT id FROM outside)
UNION ALL SELECT 'BELONG_TO', c.id, p.id, c.kind, c.parent::VARCHAR, c.status FROM pub c JOIN pub p ON c.parent = p.id
    WHERE c.kind = '4-NOT SPECIFIED' AND p.kind = '5-LOW'
UNION ALL SELECT 'PUBLISHED_IN', id, parent, kind, parent::VARCHAR, status FROM pub WHERE kind = '1-URGENT'
UNION ALL SELECT 'PART_OF', id, parent, NULL, NULL, status FROM pub WHERE kind IN ('2-HIGH', '5-LOW')
UNION ALL SELECT 'AUTHORED_BY', article_id, author_id, NULL, NULL, NULL FROM authored_by
    WHERE article_id NOT IN (SELECT id FROM outside)
UNION ALL SELECT 'PUBLISHED_BY', article_id, author_id, NULL, NULL, NULL FROM authored_by
    WHERE article_id NOT IN (SELECT id FROM incoll)
UNION ALL SELECT 'EDITED_BY', article_id, author_id, NULL, NULL, NULL FROM authored_by
    WHERE article_id NOT IN (SELECT id FROM home)
UNION ALL SELECT 'SUBMITTED_AT', id, parent, NULL, NULL, NULL FROM pub"""))
def graph_edges(spark, folder):
    """All edge types of the prepared graph, stacked."""
    edges = build_graph(_raw_graph_tables(spark, folder)).edges
    stacked = None
    for kind, df in edges.items():
        own = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("number", "pages", "volume")]
        rows = df.select(F.lit(kind).alias("kind"), "start_id", "end_id", *own)
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked


def _nodes_sql():
    """Every value of every node, as (label, id, path, value)."""
    kept = {
        "Publication:Article": ("1-URGENT", "ee ee_type key mdate cdate note note_type title url year"),
        "Publication:Inproceeding": ("4-NOT SPECIFIED", "ee key mdate title url year booktitle"),
        "Publication:Proceeding": ("5-LOW", "ee key mdate title url year booktitle isbn"),
        "Publication:Book": ("2-HIGH", "ee key mdate title url year isbn pages"),
        "PhdThesis": ("2-HIGH", "key ee mdate title year"),
    }
    known = {"key": "'o/' || o_orderkey", "mdate": "'2020-01-01'", "title": "o_orderstatus", "pages": "o_custkey::VARCHAR",
             "year": "(o_orderkey % 50 + 1970)::VARCHAR"}
    rows = [f"SELECT '{label}' AS label, o_orderkey AS id, '{name}' AS path, "
            f"{known.get(name, f"'{name} o/' || o_orderkey")} AS value FROM orders WHERE o_orderpriority = '{kind}'"
            for label, (kind, names) in kept.items() for name in names.split()]
    labels = ("Editor", "Publisher", "Journal", "School", "Series", "MasterThesis")
    rows += [f"SELECT '{label}', s_suppkey, 'name', s_name FROM supplier WHERE s_suppkey % 6 = {no}"
             for no, label in enumerate(labels)]
    rows += [f"SELECT 'Author', s_suppkey, '{path}', {value} FROM supplier" for path, value in (
        ("name", "upper(s_name)"), ("hindex", "s_acctbal::VARCHAR"))]
    return " UNION ALL ".join(rows)


@query(_nodes_sql())
def graph_nodes(spark, folder):
    """All twelve labels of the prepared graph with all that they keep, one row for each value."""
    stacked = [leaf_rows(df, ["id"]).withColumn("label", F.lit(label))
               for label, df in build_graph(_raw_graph_tables(spark, folder)).nodes.items()]
    return reduce(DataFrame.unionByName, stacked)
