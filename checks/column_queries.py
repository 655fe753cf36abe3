"""Projections, casts, filters and column functions on the driver tables."""

from pyspark.sql import functions as F

from quire import schemas
from quire.functions import arrays, text
from quire.operators import columns as C
from quire.operators import rows as R
from quire.operators.entities import alias_join
from quire.operators.lists import explode_list
from quire.operators.phrases import phrase_places, tag_keywords_of as tag_words
from quire.operators.ranks import with_position, zip_by_rank

from checks.registry import query
from checks.views import articles, authored_by, authors, journals, table, with_views


@query("SELECT o_orderkey AS id, o_orderpriority AS key FROM orders")
def pick_columns(spark, folder):
    return C.pick(table(spark, folder, "orders").drop("o_totalprice", "no_such_column"),
                  {"id": 0, "key": "o_orderpriority"})


@query("SELECT p_partkey AS id, p_size AS size, p_brand AS brand FROM part")
def prune_columns(spark, folder):
    part = table(spark, folder, "part").withColumnsRenamed({"p_partkey": "id", "p_size": "size", "p_brand": "brand"})
    return C.prune_columns(part, ["id", "size", "brand", "volume"])


def _untyped_parts(spark, folder):
    """Part keys and sizes as text: sizes written as 7.0, and one type with a size that is no number."""
    size = F.when(F.col("p_type") == "ECONOMY", "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".0")))
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"), size.alias("year"), F.col("p_name").alias("title"))


_PART_SCHEMA = schemas.T.StructType([f for f in schemas.ARTICLE_RAW if f.name in ("id", "title", "year", "volume")])


@query("""SELECT p_partkey AS id, p_name AS title, CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_size END AS year,
    CAST(NULL AS VARCHAR) AS volume FROM part""")
def conform_types(spark, folder):
    return C.conform(_untyped_parts(spark, folder), _PART_SCHEMA)


@query("""SELECT CAST(0 AS BIGINT) AS id, CAST(0 AS BIGINT) AS title,
    count(*) FILTER (WHERE p_type = 'ECONOMY') AS year FROM part""")
def rejected_values(spark, folder):
    return C.count_rejected_values(_untyped_parts(spark, folder), _PART_SCHEMA)


def _orders_with_nulls(spark, folder):
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.when(status != "P", F.col("o_orderkey")).alias("id"),
        F.when(status != "F", F.year("o_orderdate")).alias("year"),
        F.when(status != "O", F.col("o_orderpriority")).alias("url"))


@query("""SELECT o_orderkey AS id, CAST(CASE WHEN o_orderstatus <> 'F' THEN year(o_orderdate) END AS INTEGER) AS year,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS url FROM orders WHERE o_orderstatus <> 'P'""")
def require_not_null(spark, folder):
    return C.require_not_null(_orders_with_nulls(spark, folder), ["id"])


@query("SELECT count(*) AS rejected FROM orders WHERE o_orderstatus = 'P'")
def null_keys(spark, folder):
    return C.count_null_keys(_orders_with_nulls(spark, folder), ["id"])


@query("""SELECT CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_orderkey END AS id,
    CAST(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE year(o_orderdate) END AS INTEGER) AS year,
    CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderpriority END AS url FROM orders""")
def fill_sentinels(spark, folder):
    return C.fill_sentinels(_orders_with_nulls(spark, folder), {"id": -1, "year": -1, "url": ""})


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'")
def not_null_filter(spark, folder):
    return _orders_with_nulls(spark, folder).filter(F.col("id").isNotNull()).select("id")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'")
def placeholder_filter(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return R.drop_placeholder(orders, "o_orderpriority", "4-NOT SPECIFIED")


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 50")
def first_n_matching(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return R.first_n_matching(documents, F.col("lang") == "en", 50, ["doc_id"])


@query("SELECT doc_id, source FROM documents WHERE lang = 'en'")
def all_matching(spark, folder):
    documents = table(spark, folder, "documents")
    return R.first_n_matching(documents, F.col("lang") == "en", None, ["doc_id"]).select("doc_id", "source")


@query("""SELECT DISTINCT l_orderkey AS article_id, l_suppkey AS author_id FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 8000)""")
def semi_join(spark, folder):
    rich = table(spark, folder, "supplier").filter("s_acctbal > 8000").select(F.col("s_suppkey").alias("author_id"))
    return R.keep_related(authored_by(spark, folder), rich, ["author_id"])


@query("SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN customer "
       "ON o_custkey = c_custkey AND c_mktsegment = 'MACHINERY'")
def left_join_enrich(spark, folder):
    customers = (table(spark, folder, "customer").filter("c_mktsegment = 'MACHINERY'")
                 .select(F.col("c_custkey").alias("o_custkey"), "c_name"))
    return (table(spark, folder, "orders").select("o_orderkey", "o_custkey")
            .join(customers, "o_custkey", "left").select("o_orderkey", "o_custkey", "c_name"))


@query(with_views("article journal", """
SELECT article_id, title, yr AS year, journal_id, url, journal.name FROM article JOIN journal USING (journal_id)"""))
def natural_join(spark, folder):
    return R.natural_join(articles(spark, folder), journals(spark, folder))


@query("""SELECT s_suppkey AS id, upper(s_name) AS name, s_suppkey AS found, n_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def alias_join_names(spark, folder):
    supplier = table(spark, folder, "supplier")
    extra = (supplier.join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
             .select(F.col("s_suppkey").alias("found"), "n_name",
                     F.array("s_name", F.upper("s_name")).alias("aliases")))
    base = supplier.select(F.col("s_suppkey").alias("id"), F.upper("s_name").alias("name"))
    return alias_join(base, extra, "name", "aliases", "found")


@query("""SELECT item_id, doc_id FROM (SELECT item_id, row_number() OVER (ORDER BY item_id) AS i FROM benchmark)
    JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM documents) USING (i)""")
def zip_rows(spark, folder):
    items = table(spark, folder, "benchmark").select("item_id")
    documents = table(spark, folder, "documents").select("doc_id")
    return zip_by_rank(items, documents, "item_id", "doc_id").select("item_id", "doc_id")


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position FROM orders""")
def position_by_price(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    ranked = with_position(orders, "o_totalprice", ties=("o_orderkey",))
    return ranked.select("o_orderkey", F.col("position").cast("long").alias("position"))


@query("""SELECT o_orderkey, row_number() OVER (
    ORDER BY CASE WHEN o_orderstatus = 'F' THEN o_totalprice END NULLS LAST, o_orderkey) AS position FROM orders""")
def position_with_nulls(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("price"))
    ranked = with_position(orders, "price", ties=("o_orderkey",))
    return ranked.select("o_orderkey", F.col("position").cast("long").alias("position"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (
    ORDER BY CASE WHEN l_quantity >= 10 THEN 1 ELSE l_quantity END, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS position
    FROM lineitem""")
def position_with_ties(spark, folder):
    """One value in most of the rows."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_quantity") >= 10, 1).otherwise(F.col("l_quantity")).alias("quantity"))
    ranked = with_position(items, "quantity", ties=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return ranked.drop("quantity").withColumn("position", F.col("position").cast("long"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn
    FROM lineitem) WHERE rn = 1""")
def dedupe_first(spark, folder):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    return (R.dedupe_first(table(spark, folder, "lineitem"), ["l_orderkey"], order)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


@query("""SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN s_name ELSE upper(s_name) END AS s_name,
    CASE WHEN s_acctbal > 5000 THEN s_acctbal END AS s_acctbal FROM supplier""")
def union_first_wins(spark, folder):
    supplier = table(spark, folder, "supplier")
    rich = supplier.filter("s_acctbal > 5000").select("s_suppkey", "s_name", "s_acctbal")
    everyone = supplier.select("s_suppkey", F.upper("s_name").alias("s_name"))
    return R.union_first_wins([rich, everyone], ["s_suppkey"])


@query("""SELECT p_partkey, p_brand AS first_value, p_type AS second_value, CAST(2 AS INTEGER) AS n,
    CASE WHEN p_size > 25 THEN '' ELSE p_brand END AS or_empty FROM part""")
def split_multivalue(spark, folder):
    both = F.concat_ws("|", "p_brand", "p_type")
    values = text.split_multivalue(both)
    padded = text.split_multivalue(F.when(F.col("p_size") <= 25, both), null_as_empty=True)
    return table(spark, folder, "part").select(
        "p_partkey", values[0].alias("first_value"), values[1].alias("second_value"),
        arrays.list_size(values).alias("n"), padded[0].alias("or_empty"))


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN NULL ELSE string_split(p_name, ' ')[1] END AS first_word
    FROM part""")
def first_element(spark, folder):
    words = F.when(F.col("p_size") > 25, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    return table(spark, folder, "part").select("p_partkey", arrays.first_element(words).alias("first_word"))


# Dates in five forms, and what is no date.
_WRITTEN = """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN ' ' || strftime(o_orderdate, '%Y/%m/%d')
    WHEN 3 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 4 THEN strftime(o_orderdate, '%Y') WHEN 5 THEN '2021-02-30'
    WHEN 6 THEN 'no date' END AS written, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders"""


def _written_dates(spark, folder):
    form = lambda pattern: F.date_format("o_orderdate", pattern)
    kind = F.col("o_orderkey") % 8
    return table(spark, folder, "orders").select("o_orderkey", (
        F.when(kind == 0, form("yyyy-MM-dd")).when(kind == 1, form("yyyyMMdd"))
        .when(kind == 2, F.concat(F.lit(" "), form("yyyy/MM/dd"))).when(kind == 3, form("dd.MM.yyyy"))
        .when(kind == 4, form("yyyy")).when(kind == 5, "2021-02-30").when(kind == 6, "no date")).alias("written"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 4 THEN day END AS mdate,
    CASE WHEN o_orderkey % 8 >= 4 THEN written END AS rejected FROM ({_WRITTEN})""")
def parse_dates(spark, folder):
    """Whole days; the texts that are none stay beside them."""
    parsed = text.parse_date(F.col("written"))
    return _written_dates(spark, folder).select("o_orderkey", parsed.cast("string").alias("mdate"),
                                                text.rejected_text(F.col("written"), parsed).alias("rejected"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN day WHEN o_orderkey % 8 = 4 THEN written || '-01-01' END
    AS mdate FROM ({_WRITTEN})""")
def parse_dates_or_years(spark, folder):
    """ISO dates, and years on request."""
    return _written_dates(spark, folder).select(
        "o_orderkey", text.parse_date(F.col("written"), ("yyyy-MM-dd", "yyyy")).cast("string").alias("mdate"))


@query(with_views("author", """SELECT author_id, n_name AS affiliation FROM author
UNION ALL SELECT author_id, r_name AS affiliation FROM author"""))
def explode_affiliations(spark, folder):
    return explode_list(authors(spark, folder), "author_id", "affiliations", "affiliation")


@query("""SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN 'anon_' || string_split(p_name, ' ')[1]
    ELSE replace(p_name, ' ', '') END || '@gmail.com' AS email FROM part""")
def derive_email(spark, folder):
    name = F.when(F.col("p_size") > 25, F.split("p_name", " ")[0]).otherwise(F.concat(F.lit(" "), "p_name"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), text.derive_email(name, "anon_").alias("email"))


@query("""SELECT p_partkey, p_brand AS a, p_name || '''s' AS b, CAST(NULL AS VARCHAR) AS c, chr(233) AS d,
    CAST(4 AS INTEGER) AS n FROM part""")
def list_literal(spark, folder):
    literal = F.concat(F.lit("['"), "p_brand", F.lit("', \""), "p_name", F.lit("'s\", None, '\\xe9']"))
    values = text.parse_list_literal(literal)
    return (table(spark, folder, "part").select("p_partkey", values.alias("v"))
            .select("p_partkey", *[F.get("v", i).alias(name) for i, name in enumerate("abcd")],
                    F.size("v").alias("n")))


def _holds(word):
    return f"regexp_matches(upper(text), '(^|[^\\p{{L}}\\p{{N}}]){word}($|[^\\p{{L}}\\p{{N}}])')"


@query(f"""SELECT doc_id, concat_ws(',', {", ".join(f"CASE WHEN {_holds(w)} THEN '{w}' END" for w in ("THE", "AND", "UND"))})
    AS keywords FROM documents""")
def tag_keywords(spark, folder):
    tags = text.tag_keywords(F.col("text"), ["THE", "AND", "UND"])
    return table(spark, folder, "documents").select("doc_id", F.array_join(tags, ",").alias("keywords"))


@query("""WITH words AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word
    FROM documents), vocabulary AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word
    FROM benchmark)
SELECT doc_id, string_agg(word, ',' ORDER BY word) AS keywords FROM words JOIN vocabulary USING (word) GROUP BY doc_id""")
def tag_keywords_of(spark, folder):
    """The words of all benchmark items as a vocabulary table."""
    words = F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("word")
    vocabulary = table(spark, folder, "benchmark").select(words).filter("word <> ''")
    tags = tag_words(table(spark, folder, "documents"), "doc_id", "text", vocabulary)
    return tags.select("doc_id", F.array_join("keywords", ",").alias("keywords"))


# Phrases: three words in a row, from every third place of the benchmark items, and well-known ones.
_PHRASES = """pieces AS (SELECT string_split(text, ' ') AS w FROM benchmark),
phrases AS (SELECT DISTINCT array_to_string(w[i:i + 2], ' ') AS word FROM (SELECT w, unnest(range(1, len(w) - 1, 3)) AS i
    FROM pieces) UNION SELECT unnest(['MACHINE LEARNING', 'BIG DATA', 'C++', 'and', 'THE', '.', 'de la', 'Nothing of this'])),
texts AS (SELECT doc_id, lower(text) AS text FROM documents)"""


def _phrases(spark, folder):
    words = F.split("text", " ")
    starts = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3, F.lit(3)))
    pieces = table(spark, folder, "benchmark").select(F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice(words, i + 1, 3), " "))).alias("word"))
    known = spark.range(1).select(F.explode(F.array(*map(F.lit, (
        "MACHINE LEARNING", "BIG DATA", "C++", "and", "THE", ".", "de la", "Nothing of this")))).alias("word"))
    return pieces.union(known)


@query(f"""WITH {_PHRASES},
pairs AS MATERIALIZED (SELECT doc_id, text, word FROM texts JOIN phrases ON contains(text, lower(word)) WHERE word <> '')
SELECT doc_id, word FROM pairs WHERE regexp_matches(
    text, '(^|[^\\p{{L}}\\p{{N}}])' || regexp_escape(lower(word)) || '($|[^\\p{{L}}\\p{{N}}])')""")
def phrases_in_documents(spark, folder):
    """A vocabulary of a thousand phrases as a table."""
    found = phrase_places(table(spark, folder, "documents"), "doc_id", "text", _phrases(spark, folder))
    return found.select("doc_id", "word").distinct()


@query("SELECT p_partkey, p_brand || ',' || p_type AS fields FROM part")
def fields_of_study(spark, folder):
    field = lambda name: F.struct(F.col(name).alias("category"), F.lit("s").alias("source"))
    studied = F.array(field("p_brand"), field("p_type"), field("p_brand"))
    return table(spark, folder, "part").select(
        "p_partkey", F.array_join(arrays.distinct_field(studied, "category"), ",").alias("fields"))


@query("""SELECT doc_id, '{"doc_id":' || doc_id || CASE WHEN quality IS NULL THEN '' ELSE
    ',"quality":' || quality END || '}' AS json FROM documents LEFT JOIN labels USING (doc_id)""")
def null_prune(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return (table(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left")
            .select("doc_id", F.to_json(F.struct("doc_id", "quality")).alias("json")))


@query("""SELECT o_orderkey, '{"updated":{"$date":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}}' AS json
    FROM orders""")
def extended_json_dates(spark, folder):
    updated = arrays.extended_json_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("updated")
    return table(spark, folder, "orders").select("o_orderkey", F.to_json(F.struct(updated)).alias("json"))
