"""The ten analytic queries. Thresholds are inclusive (``>=``); every top-k breaks ties by id.

Where a query counts per group, it counts before it joins names. Groups are only ever counted, never gathered,
so one author, venue or article may hold a large share of the rows.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.plans.bibliography import Bibliography

# The parameters of the ten queries.
AUTHOR_PATTERN = r"S.\sCeri$"
AUTHOR = "S. Ceri"
TITLE_PHRASE = "Machine Learning"
TOP_AUTHORS = 5
VENUE_YEAR = 2010
MIN_ARTICLES = 20
MIN_CITATIONS = 20
I_INDEX_CITATIONS = 10
TOPIC_IN_NAME = "Medicine"
TOPIC_IN_TITLE = "Medicine|medicine"
MIN_TOPIC_ARTICLES = 10
AFFILIATION = "Politecnico di Milano"
MIN_AFFILIATION_ARTICLES = 5


def _named(bib: Bibliography, name: str | None) -> DataFrame:
    authors = bib.authors.select("author_id", "name")
    return authors if name is None else authors.filter(F.col("name") == name)


def _authorships(bib: Bibliography, name: str | None) -> DataFrame:
    return bib.authored_by if name is None else bib.authorships(F.col("name") == name)


def articles_by_author(bib: Bibliography, pattern: str = AUTHOR_PATTERN) -> DataFrame:
    """Articles of the authors whose name matches a regular expression: name, article id, url."""
    return (bib.authorships(F.col("name").rlike(pattern))
            .join(bib.articles.select("article_id", "url"), "article_id")
            .select("name", "article_id", "url"))


def title_contains(bib: Bibliography, phrase: str = TITLE_PHRASE, n: int | None = 5) -> DataFrame:
    """Articles with a phrase in the title; the first ``n`` by id, or all when ``n`` is None."""
    found = bib.articles.filter(F.col("title").contains(phrase))
    return found if n is None else found.orderBy("article_id").limit(n)


def works_of_top_authors(bib: Bibliography, k: int = TOP_AUTHORS) -> DataFrame:
    """Articles of the ``k`` authors with the highest citation count: title, citationcount, name."""
    top = (bib.authors.select("author_id", "citationcount", "name")
           .orderBy(F.desc("citationcount"), "author_id").limit(k))
    return (bib.authorships_of(top)
            .join(bib.articles.select("article_id", "title"), "article_id")
            .select("title", "citationcount", "name"))


def top_venue_in_year(bib: Bibliography, year: int = VENUE_YEAR, n: int = 1) -> DataFrame:
    """The ``n`` venues with most articles in a year: year, name, articles."""
    counts = (bib.articles.filter((F.col("year") == year) & F.col("journal_id").isNotNull())
              .groupBy("year", "journal_id").agg(F.count("*").alias("articles")))
    return (counts.join(bib.journals.select("journal_id", "name"), "journal_id")
            .orderBy(F.desc("articles"), "journal_id").limit(n)
            .select("year", "name", "articles"))


def _cited_authorships(bib: Bibliography, name: str | None) -> DataFrame:
    """(author_id, article_id, incoming_count) of an author's or all authors' cited articles.

    Only ids of the article table count: edges of authorship and citation also hold books, theses and the like. For
    one name only the citations of that author's articles are counted.
    """
    written = _authorships(bib, name).select("author_id", "article_id")
    if bib.cites is not None:
        written = written.join(bib.articles.select("article_id"), "article_id", "left_semi")
    return written.join(bib.incoming_counts(None if name is None else written), "article_id")


def _citation_histogram(bib: Bibliography, name: str | None) -> DataFrame:
    """(author_id, citations, articles): per author, how many articles have a given number of citations.

    An author with C citations in all has at most about sqrt(2 C) different numbers, so this table is small for
    any author, and it is counted before the shuffle.
    """
    return (_cited_authorships(bib, name)
            .groupBy("author_id", F.col("incoming_count").alias("citations"))
            .agg(F.count("*").alias("articles")))


def h_index(bib: Bibliography, name: str | None = None, as_coded: bool = False) -> DataFrame:
    """h-index per author (author_id, name, h_index), for one name or for all authors; 0 without citations.

    The largest h such that h articles have at least h citations. With ``as_coded``, the largest h such that h
    articles have exactly h citations.
    """
    histogram = _citation_histogram(bib, name)
    if as_coded:
        best = (histogram.filter(F.col("articles") >= F.col("citations"))
                .groupBy("author_id").agg(F.max("citations").alias("h_index")))
    else:
        downwards = (Window.partitionBy("author_id").orderBy(F.desc("citations"))
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        best = (histogram.withColumn("at_least", F.sum("articles").over(downwards))
                .groupBy("author_id").agg(F.max(F.least("citations", "at_least")).alias("h_index")))
    return (_named(bib, name).join(best, "author_id", "left")
            .select("author_id", "name", F.coalesce("h_index", F.lit(0)).alias("h_index")))


def years_with_min_articles(bib: Bibliography, min_count: int = MIN_ARTICLES) -> DataFrame:
    """Years with at least ``min_count`` articles: year, articles. Articles without a year are left out."""
    return (bib.articles.filter(F.col("year").isNotNull())
            .groupBy("year").agg(F.count("*").alias("articles"))
            .filter(F.col("articles") >= min_count))


def years_with_cited_articles(bib: Bibliography, min_articles: int = MIN_ARTICLES,
                              min_citations: int = MIN_CITATIONS) -> DataFrame:
    """Years with at least ``min_articles`` articles cited at least ``min_citations`` times, latest first."""
    if bib.cites is None:
        cited = bib.articles.filter(F.col("incoming_count") >= min_citations)
    else:
        ids = bib.incoming_counts().filter(F.col("incoming_count") >= min_citations)
        cited = bib.articles.join(ids, "article_id", "left_semi")
    return (cited.filter(F.col("year").isNotNull())
            .groupBy("year").agg(F.count("*").alias("articles"))
            .filter(F.col("articles") >= min_articles).orderBy(F.desc("year")))


def i_index(bib: Bibliography, name: str | None = None, threshold: int = I_INDEX_CITATIONS) -> DataFrame:
    """Number of an author's articles with at least ``threshold`` citations (author_id, name, i_index)."""
    counts = (_cited_authorships(bib, name).filter(F.col("incoming_count") >= threshold)
              .groupBy("author_id").agg(F.count("*").alias("i_index")))
    return (_named(bib, name).join(counts, "author_id", "left")
            .select("author_id", "name", F.coalesce("i_index", F.lit(0)).alias("i_index")))


def topical_venues(bib: Bibliography, name_term: str = TOPIC_IN_NAME, title_pattern: str = TOPIC_IN_TITLE,
                   min_count: int = MIN_TOPIC_ARTICLES) -> DataFrame:
    """Venues on a topic by name with enough articles on it by title: journal_id, name, articles."""
    counts = (bib.articles.filter(F.col("title").rlike(title_pattern) & F.col("journal_id").isNotNull())
              .groupBy("journal_id").agg(F.count("*").alias("articles"))
              .filter(F.col("articles") >= min_count))
    venues = bib.journals.filter(F.col("name").contains(name_term)).select("journal_id", "name")
    return counts.join(venues, "journal_id").select("journal_id", "name", "articles")


def venues_of_affiliation(bib: Bibliography, affiliation: str = AFFILIATION,
                          min_count: int = MIN_AFFILIATION_ARTICLES, as_coded: bool = False) -> DataFrame:
    """Venues where authors of an affiliation have enough articles: affiliation, journal_id, name, articles.

    An article with two such authors counts once; with ``as_coded`` it counts once per authorship.
    """
    written = bib.authorships(F.array_contains("affiliations", affiliation))
    placed = bib.articles.filter(F.col("journal_id").isNotNull()).select("article_id", "journal_id")
    if as_coded:
        listed = F.size(F.filter("affiliations", lambda a: a == affiliation)).alias("_listed")
        counts = (written.select("article_id", listed).join(placed, "article_id")
                  .groupBy("journal_id").agg(F.sum("_listed").alias("articles")))
    else:
        counts = (placed.join(written.select("article_id").distinct(), "article_id", "left_semi")
                  .groupBy("journal_id").agg(F.count("*").alias("articles")))
    return (counts.filter(F.col("articles") >= min_count)
            .join(bib.journals.select("journal_id", "name"), "journal_id")
            .select(F.lit(affiliation).alias("affiliation"), "journal_id", "name", "articles"))
