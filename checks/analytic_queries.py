"""The ten analytic queries on the driver tables."""

from pyspark.sql import functions as F

from quire.plans import analytics as A

from checks.registry import query
from checks.relation_queries import bibliography_from_tables
from checks.views import bibliography, with_views


@query(with_views("article author authored_by", """
SELECT name, article_id, url FROM author JOIN authored_by USING (author_id) JOIN article USING (article_id)
WHERE regexp_matches(name, '0007$')"""))
def articles_by_author(spark, folder):
    return A.articles_by_author(bibliography(spark, folder), r"0007$")


@query(with_views("article", """
SELECT article_id, title, yr AS year, journal_id, url FROM article
WHERE title LIKE '%URGENT%' ORDER BY article_id LIMIT 5"""))
def title_contains(spark, folder):
    return A.title_contains(bibliography(spark, folder), "URGENT", 5)


@query(with_views("article author authored_by", """,
top AS (SELECT * FROM author ORDER BY citationcount DESC NULLS LAST, author_id LIMIT 5)
SELECT title, citationcount, name FROM top JOIN authored_by USING (author_id) JOIN article USING (article_id)"""))
def works_of_top_authors(spark, folder):
    return A.works_of_top_authors(bibliography(spark, folder), 5)


@query(with_views("article journal", """,
counts AS (SELECT yr, journal_id, name, count(*) AS articles FROM article JOIN journal USING (journal_id)
           WHERE yr = 1998 GROUP BY yr, journal_id, name)
SELECT yr AS year, name, articles FROM counts ORDER BY articles DESC, journal_id LIMIT 1"""))
def top_venue_in_year(spark, folder):
    return A.top_venue_in_year(bibliography(spark, folder), 1998)


@query(with_views("author authored_by incoming article", """,
ranked AS (SELECT author_id, n, row_number() OVER (PARTITION BY author_id ORDER BY n DESC) AS rn
           FROM authored_by JOIN incoming USING (article_id) JOIN article USING (article_id)),
best AS (SELECT author_id, max(rn) AS h FROM ranked WHERE n >= rn GROUP BY author_id)
SELECT author_id, name, coalesce(h, 0) AS h_index FROM author LEFT JOIN best USING (author_id)"""))
def h_index(spark, folder):
    return A.h_index(bibliography(spark, folder))


@query(with_views("author authored_by incoming article", """,
equal AS (SELECT author_id, n, count(*) AS c FROM authored_by JOIN incoming USING (article_id) JOIN article USING (article_id)
          GROUP BY author_id, n),
best AS (SELECT author_id, max(n) AS h FROM equal WHERE c >= n GROUP BY author_id)
SELECT author_id, name, coalesce(h, 0) AS h_index FROM author LEFT JOIN best USING (author_id)"""))
def h_index_as_coded(spark, folder):
    return A.h_index(bibliography(spark, folder), as_coded=True)


@query(with_views("author authored_by incoming article", """,
ranked AS (SELECT author_id, n, row_number() OVER (PARTITION BY author_id ORDER BY n DESC) AS rn
           FROM authored_by JOIN incoming USING (article_id) JOIN article USING (article_id)),
best AS (SELECT author_id, max(rn) AS h FROM ranked WHERE n >= rn GROUP BY author_id)
SELECT author_id, name, coalesce(h, 0) AS h_index FROM author LEFT JOIN best USING (author_id)
WHERE name = 'Supplier#000000003'"""))
def h_index_of_author(spark, folder):
    return A.h_index(bibliography(spark, folder), "Supplier#000000003")


@query(with_views("author authored_by incoming article", """,
ranked AS (SELECT author_id, n, row_number() OVER (PARTITION BY author_id ORDER BY n DESC) AS rn
           FROM authored_by JOIN incoming USING (article_id) JOIN article USING (article_id)),
best AS (SELECT author_id, max(rn) AS h FROM ranked WHERE n >= rn GROUP BY author_id)
SELECT author_id, coalesce(h, 0) AS from_edges, coalesce(h, 0) AS from_tables
FROM author LEFT JOIN best USING (author_id)"""))
def h_index_both_ways(spark, folder):
    """From edge tables, which hold other publications too, and from tables with list columns: the same numbers."""
    from_edges = A.h_index(bibliography(spark, folder)).select("author_id", F.col("h_index").alias("from_edges"))
    from_tables = A.h_index(bibliography_from_tables(spark, folder)).select(
        "author_id", F.col("h_index").alias("from_tables"))
    return from_edges.join(from_tables, "author_id", "full")


@query(with_views("article", """
SELECT yr AS year, count(*) AS articles FROM article GROUP BY yr HAVING count(*) >= 1500"""))
def years_with_min_articles(spark, folder):
    return A.years_with_min_articles(bibliography(spark, folder), 1500)


@query(with_views("article incoming", """
SELECT yr AS year, count(*) AS articles FROM article JOIN incoming USING (article_id)
WHERE n >= 11 GROUP BY yr HAVING count(*) >= 21 ORDER BY yr DESC"""))
def years_with_cited_articles(spark, folder):
    return A.years_with_cited_articles(bibliography(spark, folder), min_articles=21, min_citations=11)


@query(with_views("author authored_by incoming article", """,
counts AS (SELECT author_id, count(*) AS c FROM authored_by JOIN incoming USING (article_id) JOIN article USING (article_id)
           WHERE n >= 10 GROUP BY author_id)
SELECT author_id, name, coalesce(c, 0) AS i_index FROM author LEFT JOIN counts USING (author_id)"""))
def i10_index(spark, folder):
    return A.i_index(bibliography(spark, folder))


@query(with_views("article journal", """
SELECT journal_id, name, count(*) AS articles FROM journal JOIN article USING (journal_id)
WHERE name LIKE '%MACHINERY%' AND regexp_matches(title, 'HIGH|LOW')
GROUP BY journal_id, name HAVING count(*) >= 6"""))
def topical_venues(spark, folder):
    return A.topical_venues(bibliography(spark, folder), "MACHINERY", "HIGH|LOW", 6)


@query(with_views("article author journal authored_by", """
SELECT 'NATION_3' AS affiliation, journal_id, journal.name, count(DISTINCT article_id) AS articles
FROM author JOIN authored_by USING (author_id) JOIN article USING (article_id) JOIN journal USING (journal_id)
WHERE 'NATION_3' IN (n_name, r_name)
GROUP BY journal_id, journal.name HAVING count(DISTINCT article_id) >= 5"""))
def venues_of_affiliation(spark, folder):
    return A.venues_of_affiliation(bibliography(spark, folder), "NATION_3", 5)


@query(with_views("article author journal authored_by", """
SELECT 'NATION_3' AS affiliation, journal_id, journal.name, count(*) AS articles
FROM author JOIN authored_by USING (author_id) JOIN article USING (article_id) JOIN journal USING (journal_id)
WHERE 'NATION_3' IN (n_name, r_name)
GROUP BY journal_id, journal.name HAVING count(*) >= 5"""))
def venues_of_affiliation_as_coded(spark, folder):
    return A.venues_of_affiliation(bibliography(spark, folder), "NATION_3", 5, as_coded=True)
