"""Nested document assembly on the driver tables."""

from pyspark.sql import functions as F

from quire import schemas
from quire.functions import nested
from quire.functions.leaves import leaf_rows
from quire.operators.lists import adjacency_lists
from quire.plans import documents as D

from checks.registry import query, scratch
from checks.views import authored_by, raw_cites, table, with_views

_TURNS = ("conv_id", "turn", "role")


@query("""SELECT conv_id, role, min(turn) AS first_pos, count(*) AS paragraphs FROM conversations
    GROUP BY conv_id, role""")
def sections(spark, folder):
    return D.section_sizes(table(spark, folder, "conversations"), *_TURNS)


@query("""WITH seen AS (SELECT *, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id, role) THEN 1 ELSE 0 END AS s
    FROM conversations)
SELECT conv_id, turn, role, CAST(sum(s) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS section_no FROM seen""")
def sections_as_coded(spark, folder):
    turns = table(spark, folder, "conversations").select(*_TURNS)
    # Blocks of two positions: conversations run over several blocks.
    return D.number_sections(turns, *_TURNS, block=2)


def _section_rows(documents, doc):
    """(doc, section_no, section_title, paragraph_no, text) of nested sections."""
    return (documents.select(doc, F.posexplode("sections").alias("section_no", "s"))
            .select(doc, "section_no", F.col("s.section_title").alias("section_title"),
                    F.posexplode("s.paragraphs").alias("paragraph_no", "text")))


@query("""WITH first AS (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY conv_id, role),
numbered AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY t) - 1 AS n FROM first)
SELECT conv_id, CAST(n AS INTEGER) AS section_no, role AS section_title, CAST(row_number() OVER (
    PARTITION BY conv_id, role ORDER BY turn) - 1 AS INTEGER) AS paragraph_no, text
FROM conversations JOIN numbered USING (conv_id, role)""")
def aggregate_sections(spark, folder):
    nested_rows = D.aggregate_sections(table(spark, folder, "conversations"), *_TURNS, "text")
    return _section_rows(nested_rows, "conv_id")


@query("""WITH seen AS (SELECT *, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id, role) THEN 1 ELSE 0 END AS s
    FROM conversations),
numbered AS (SELECT *, sum(s) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM seen),
titled AS (SELECT conv_id, n, turn, text, first_value(role) OVER (PARTITION BY conv_id, n ORDER BY turn) AS title
    FROM numbered)
SELECT conv_id, CAST(n AS INTEGER) AS section_no, title AS section_title, CAST(row_number() OVER (
    PARTITION BY conv_id, n ORDER BY turn) - 1 AS INTEGER) AS paragraph_no, text FROM titled""")
def aggregate_sections_as_coded(spark, folder):
    nested_rows = D.aggregate_sections(table(spark, folder, "conversations"), *_TURNS, "text", as_coded=True)
    return _section_rows(nested_rows, "conv_id")


def _lines(spark, folder):
    """Documents as paragraphs, one row for each line; its first character names the section."""
    return table(spark, folder, "documents").select(F.col("doc_id").alias("corpusid"), F.posexplode(
        F.split("text", "\n")).alias("pos", "line")).withColumn("section", F.substring("line", 1, 1))


@query("""WITH lines AS (SELECT doc_id AS corpusid, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
sized AS (SELECT *, strlen(line) AS size, sum(strlen(line)) OVER (PARTITION BY corpusid) AS total,
    coalesce(sum(strlen(line)) OVER (PARTITION BY corpusid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS start FROM lines),
parts AS (SELECT corpusid, pos, line, substring(line, 1, 1) AS section, CASE WHEN total <= 3000 THEN 0
    ELSE 2 * (start // 1500) + CASE WHEN size > 1500 THEN 1 ELSE 0 END END AS part FROM sized),
first AS (SELECT corpusid, part, section, min(pos) AS t FROM parts GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY corpusid, part ORDER BY t) - 1 AS n FROM first)
SELECT corpusid, CAST(part AS BIGINT) AS part, CAST(n AS INTEGER) AS section_no, section AS section_title,
    CAST(row_number() OVER (PARTITION BY corpusid, part, section ORDER BY pos) - 1 AS INTEGER) AS paragraph_no, line AS text
FROM parts JOIN numbered USING (corpusid, part, section)""")
def aggregate_sections_in_parts(spark, folder):
    """Documents rebuilt from their lines, in rows of at most 3,000 bytes of text, or one longer line."""
    made = D.aggregate_sections(_lines(spark, folder), "corpusid", "pos", "section", "line", limit=3000)
    return (made.select("corpusid", "part", F.posexplode("sections").alias("section_no", "s"))
            .select("corpusid", "part", "section_no", F.col("s.section_title").alias("section_title"),
                    F.posexplode("s.paragraphs").alias("paragraph_no", "text")))


def _texts(spark, folder):
    """Documents as paper texts: a line is a paragraph, its first character names the section, and its length
    decides on the figure it refers to."""
    size = lambda line: F.length(line)
    def paragraph(line):
        ref = (F.when(size(line) > 200, "FIGREF0").when(size(line) > 100, "TABREF0")
               .when(size(line) > 50, "FIGREF9"))
        span = F.struct(F.lit(0).alias("start"), F.lit(3).alias("end"), F.lit("see").alias("text"), ref.alias("ref_id"))
        return F.struct(F.substring(line, 1, 1).alias("section"), line.alias("text"),
                        F.array(span).alias("cite_spans"), F.array(span).alias("ref_spans"))
    entry = lambda text, kind: F.struct(F.col(text).alias("text"), F.lit(kind).alias("type"))
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("corpusid"),
        F.transform(F.split("text", "\n"), paragraph).alias("body_text"),
        F.create_map(F.lit("FIGREF0"), entry("lang", "figure"),
                     F.lit("TABREF0"), entry("source", "table")).alias("ref_entries"))


def _images(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("idx"), F.col("p_brand").alias("author"), F.col("p_size").alias("width"),
        F.col("p_size").alias("height"), F.col("p_name").alias("url"), F.col("p_type").alias("download_url"))


def _papers(spark, folder):
    """Documents as papers without authors."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("corpusid"), F.col("lang").alias("title"),
        F.lit(None).cast(schemas.PAPER["s2fieldsofstudy"].dataType).alias("s2fieldsofstudy"))


def _with_content(spark, folder, as_coded=False):
    return D.attach_content(_papers(spark, folder), D.clean_texts(_texts(spark, folder)), "corpusid",
                            _images(spark, folder), ["THE", "AND", "UND"], as_coded)


_LINES = """lines AS (SELECT doc_id AS corpusid, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
titled AS (SELECT corpusid, line, i, substring(line, 1, 1) AS section FROM lines)"""


@query(f"""WITH {_LINES},
first AS (SELECT corpusid, section, min(i) AS t FROM titled GROUP BY corpusid, section),
numbered AS (SELECT corpusid, section, row_number() OVER (PARTITION BY corpusid ORDER BY t) - 1 AS n FROM first)
SELECT corpusid, CAST(n AS INTEGER) AS section_no, section AS section_title, CAST(row_number() OVER (
    PARTITION BY corpusid, section ORDER BY i) - 1 AS INTEGER) AS paragraph_no, line AS text
FROM titled JOIN numbered USING (corpusid, section)""")
def document_sections(spark, folder):
    documents = _with_content(spark, folder).select("corpusid", F.transform(
        "content.sections", lambda s: s.withField("paragraphs", s["paragraphs"]["text"])).alias("sections"))
    return _section_rows(documents, "corpusid")


@query(f"""WITH {_LINES},
seen AS (SELECT *, CASE WHEN i = min(i) OVER (PARTITION BY corpusid, section) THEN 1 ELSE 0 END AS s FROM titled),
numbered AS (SELECT *, sum(s) OVER (PARTITION BY corpusid ORDER BY i) - 1 AS n FROM seen)
SELECT corpusid, CAST(n AS INTEGER) AS section_no, first_value(section) OVER (
    PARTITION BY corpusid, n ORDER BY i) AS section_title, CAST(row_number() OVER (
    PARTITION BY corpusid, n ORDER BY i) - 1 AS INTEGER) AS paragraph_no, line AS text FROM numbered""")
def document_sections_as_coded(spark, folder):
    documents = _with_content(spark, folder, as_coded=True).select("corpusid", F.transform(
        "content.sections", lambda s: s.withField("paragraphs", s["paragraphs"]["text"])).alias("sections"))
    return _section_rows(documents, "corpusid")


#: The image of a document's only figure.
_IMAGED = """imaged AS (SELECT doc_id AS corpusid, lang, source, p_brand AS author, p_size AS size, p_name AS url,
    p_type AS download_url FROM documents JOIN part ON p_partkey =
    CAST('0x' || substring(md5(doc_id || ':FIGREF0'), 1, 15) AS BIGINT) % (SELECT count(*) FROM part))"""


@query(f"""WITH {_IMAGED}
SELECT doc_id AS corpusid, 'FIGREF0' AS fig_id, CAST(NULL AS VARCHAR) AS text, 'figure' AS type, author, url
    FROM documents LEFT JOIN imaged ON doc_id = corpusid
UNION ALL SELECT doc_id, 'TABREF0', source, 'table', NULL, NULL FROM documents""")
def document_figures(spark, folder):
    return (_with_content(spark, folder).select("corpusid", F.explode("content.list_of_figures").alias("f"))
            .select("corpusid", "f.fig_id", "f.text", "f.type", "f.author", "f.url"))


@query(f"""WITH {_LINES}, {_IMAGED}
SELECT l.corpusid, line, CASE WHEN length(line) > 200 THEN 'FIGREF0' WHEN length(line) > 100 THEN 'TABREF0'
        ELSE 'FIGREF9' END AS ref_id,
    CASE WHEN length(line) > 100 THEN 'see' END AS caption,
    CASE WHEN length(line) > 200 THEN d.lang WHEN length(line) > 100 THEN d.source ELSE 'see' END AS text,
    CASE WHEN length(line) > 200 THEN 'figure' WHEN length(line) > 100 THEN 'table' END AS type,
    CASE WHEN length(line) > 200 THEN author END AS author, CASE WHEN length(line) > 200 THEN size END AS width,
    CASE WHEN length(line) > 200 THEN url END AS url, CASE WHEN length(line) > 200 THEN download_url END AS download_url
FROM lines l JOIN documents d ON l.corpusid = doc_id LEFT JOIN imaged i ON l.corpusid = i.corpusid
WHERE length(line) > 50""")
def paragraph_figures(spark, folder):
    paragraphs = (_with_content(spark, folder).select("corpusid", F.explode("content.sections").alias("s"))
                  .select("corpusid", F.explode("s.paragraphs").alias("p")))
    return (paragraphs.select("corpusid", F.col("p.text").alias("line"), F.explode("p.figures_in_paragraph").alias("r"))
            .select("corpusid", "line", "r.ref_id", "r.caption", "r.text", "r.type", "r.author", "r.width", "r.url",
                    "r.download_url"))


def _order_papers(spark, folder):
    """Orders as papers; the suppliers of the line items are their authors, by id."""
    stubs = adjacency_lists(authored_by(spark, folder), "article_id", "author_id", "ids")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("corpusid"), F.col("o_orderpriority").alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("publicationdate"),
        F.lit(None).cast("string").alias("updated"), F.lit(0).cast("bigint").alias("influentialcitationcount"),
        F.lit(99).cast("bigint").alias("referencecount"),
        F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("DBLP")).alias("externalids"),
        F.array(F.struct(F.col("o_orderpriority").alias("category"), F.lit("s").alias("source")))
        .alias("s2fieldsofstudy"))
    authors = F.transform("ids", lambda a: F.struct(
        a.cast("string").alias("authorId"), F.concat(F.lit("Ann "), a.cast("string")).alias("name")))
    return (orders.join(stubs, F.col("corpusid") == F.col("article_id"), "left")
            .withColumn("authors", authors).drop("article_id", "ids", "part"))


def _external_authors(spark, folder):
    """Suppliers with money, each twice; of the two records the first name counts."""
    known = table(spark, folder, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("authorid"), F.col("s_name").alias("name"), F.lit("x").alias("updated"),
        F.lit("x").alias("aliases"))
    return known.unionByName(known.withColumn("name", F.concat("name", F.lit(" again"))))


@query(with_views("authored_by", """
SELECT article_id AS corpusid, CAST(row_number() OVER (PARTITION BY article_id ORDER BY author_id) - 1 AS INTEGER)
    AS pos, s_name AS name, 'Ann' || author_id || '@gmail.com' AS email
FROM authored_by JOIN supplier ON author_id = s_suppkey WHERE s_acctbal > 0"""))
def author_embed(spark, folder):
    papers = D.embed_authors(_order_papers(spark, folder), _external_authors(spark, folder), "corpusid", "anon_")
    return (papers.select("corpusid", F.posexplode("authors").alias("pos", "a"))
            .select("corpusid", "pos", "a.name", "a.email"))


@query("""WITH edges AS (SELECT DISTINCT l_orderkey AS corpusid, l_partkey * l_linenumber AS reference_id FROM lineitem
    WHERE l_orderkey <> l_partkey * l_linenumber),
sized AS (SELECT corpusid, reference_id, o_orderpriority AS title, strlen(o_orderpriority) + 48 AS size
    FROM edges JOIN orders ON reference_id = o_orderkey),
started AS (SELECT *, sum(size) OVER (PARTITION BY corpusid) AS total, coalesce(sum(size) OVER (
    PARTITION BY corpusid ORDER BY reference_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized)
SELECT corpusid, CAST(CASE WHEN total <= 200 THEN 0 ELSE 2 * (start // 100) + CASE WHEN size > 100 THEN 1 ELSE 0 END END
    AS BIGINT) AS part, reference_id, title FROM started""")
def embed_citations(spark, folder):
    """Citations in rows of at most 200 bytes."""
    papers = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("corpusid"), F.col("o_orderpriority").alias("title"))
    cited = D.citation_records(papers, "corpusid", "title", F.array().cast("array<string>"))
    documents = D.embed_citations(papers, cited, raw_cites(spark, folder), papers, "corpusid", limit=200)
    return (documents.select("corpusid", "part", F.explode("citations").alias("c"))
            .select("corpusid", "part", "c.reference_id", "c.title"))


def _documents_sql():
    """Every value of every prepared document, as (corpusid, path, value)."""
    reference = {
        "ref_id": "CASE WHEN length(line) > 200 THEN 'FIGREF0' WHEN length(line) > 100 THEN 'TABREF0' ELSE 'FIGREF9' END",
        "start": "'0'", "end": "'3'", "caption": "CASE WHEN length(line) > 100 THEN 'see' END",
        "text": "CASE WHEN length(line) > 200 THEN lang WHEN length(line) > 100 THEN source ELSE 'see' END",
        "type": "CASE WHEN length(line) > 200 THEN 'figure' WHEN length(line) > 100 THEN 'table' END"} | {
        name: f"CASE WHEN length(line) > 200 THEN {column}::VARCHAR END" for name, column in (
            ("author", "author"), ("width", "size"), ("height", "size"), ("url", "url"), ("download_url", "download_url"))}
    figures = [(0, "fig_id", "'FIGREF0'"), (0, "type", "'figure'"), (0, "author", "author"), (0, "url", "url"),
               (1, "fig_id", "'TABREF0'"), (1, "type", "'table'"), (1, "text", "source")]
    words = ["MACHINE LEARNING", "THE", "AND", "UND"]
    text = "upper(array_to_string(string_split(text, chr(10)), chr(10)))"
    found = "list_filter([" + ", ".join(
        f"CASE WHEN regexp_matches({text}, '(^|[^\\p{{L}}\\p{{N}}]){w}($|[^\\p{{L}}\\p{{N}}])') THEN '{w}' END"
        for w in words) + "], lambda w: w IS NOT NULL)"
    paragraph = "'content.sections[' || section_no || '].paragraphs[' || paragraph_no || ']"
    rows = [
        "SELECT id, 'title' AS path, o_orderpriority AS value FROM kept",
        "SELECT id, 'part', '0' FROM kept", "SELECT id, 'externalids.DBLP', o_orderstatus FROM kept",
        "SELECT id, 'publicationdate.$date', strftime(o_orderdate, '%Y-%m-%d') FROM kept",
        "SELECT id, 's2fieldsofstudy[0]', o_orderpriority FROM kept",
        "SELECT id, 'referencecount', coalesce(n, 0)::VARCHAR FROM kept LEFT JOIN arriving ON id = e",
        *[f"SELECT id, 'authors[' || pos || '].{name}', {value} FROM writers" for name, value in (
            ("authorid", "author_id::VARCHAR"), ("name", "s_name"), ("email", "'Ann' || author_id || '@gmail.com'"))],
        *[f"SELECT s, 'citations[' || pos || '].{name}', {value} FROM outgoing" for name, value in (
            ("reference_id", "e::VARCHAR"), ("title", "o_orderpriority"))],
        """SELECT s, 'citations[' || o.pos || '].authors[' || w.pos || ']', s_name FROM outgoing o JOIN writers w ON e = w.id""",
        "SELECT DISTINCT corpusid, 'content.sections[' || section_no || '].section_title', section FROM placed",
        f"SELECT corpusid, {paragraph}.text', line FROM placed",
        *[f"SELECT corpusid, {paragraph}.figures_in_paragraph[0].{name}', {value} FROM placed p JOIN imaged USING (corpusid) "
          f"WHERE length(line) > 50" for name, value in reference.items()],
        *[f"SELECT corpusid, 'content.list_of_figures[{no}].{name}', {value} FROM imaged" for no, name, value in figures],
        f"""SELECT doc_id, 'content.keywords[' || (k - 1) || ']', found[k] FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k
            FROM (SELECT doc_id, {found} AS found FROM documents))""",
    ]
    return f""",
kept AS (SELECT o_orderkey AS id, o_orderpriority, o_orderdate, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'),
edges AS (SELECT DISTINCT l_orderkey AS s, l_partkey * l_linenumber AS e FROM lineitem
    WHERE l_orderkey <> l_partkey * l_linenumber AND l_orderkey IN (SELECT id FROM kept)
      AND l_partkey * l_linenumber IN (SELECT id FROM kept)),
outgoing AS (SELECT s, e, o_orderpriority, row_number() OVER (PARTITION BY s ORDER BY e) - 1 AS pos
    FROM edges JOIN kept ON e = id),
arriving AS (SELECT e, count(*) AS n FROM edges GROUP BY e),
writers AS (SELECT article_id AS id, author_id, s_name, row_number() OVER (PARTITION BY article_id ORDER BY author_id) - 1 AS pos
    FROM authored_by JOIN supplier ON author_id = s_suppkey WHERE s_acctbal > 0),
{_LINES}, {_IMAGED.replace("JOIN part", "LEFT JOIN part")},
first AS (SELECT corpusid, section, min(i) AS t FROM titled GROUP BY corpusid, section),
numbered AS (SELECT corpusid, section, row_number() OVER (PARTITION BY corpusid ORDER BY t) - 1 AS section_no FROM first),
placed AS (SELECT corpusid, section, line, section_no, row_number() OVER (PARTITION BY corpusid, section ORDER BY i) - 1
    AS paragraph_no FROM titled JOIN numbered USING (corpusid, section)),
every AS ({" UNION ALL ".join(rows)})
SELECT id AS corpusid, path, value FROM every WHERE value IS NOT NULL AND id IN (SELECT id FROM kept)"""


@query(with_views("authored_by", _documents_sql()))
def documents_end_to_end(spark, folder):
    """The whole document preparation, every value of it."""
    made = D.build_documents(_order_papers(spark, folder), _external_authors(spark, folder), _texts(spark, folder),
                             _images(spark, folder), raw_cites(spark, folder), fallback_prefix="anon_",
                             vocabulary=["MACHINE LEARNING", "THE", "AND", "UND"],
                             scratch=scratch(spark, "papers"))
    return leaf_rows(made, ["corpusid"])


@query(f"""WITH {_LINES}
SELECT corpusid, CAST(count(*) FILTER (WHERE length(line) > 50) AS INTEGER) AS with_figures,
    CAST(count(*) AS INTEGER) AS paragraphs FROM lines GROUP BY corpusid""")
def paragraph_clean(spark, folder):
    cleaned = nested.clean_paragraphs(F.col("body_text"))
    return _texts(spark, folder).select("corpusid", cleaned.alias("p")).select(
        "corpusid", F.size(F.filter("p", lambda p: p["figures_in_paragraph"].isNotNull())).alias("with_figures"),
        F.size("p").alias("paragraphs"))
