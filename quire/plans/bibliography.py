"""The tables the analytics read, either from edge tables or from denormalised tables with list columns."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import list_size
from quire.operators.lists import degree, explode_list


@dataclass(frozen=True)
class Bibliography:
    """authors (author_id, name, citationcount, affiliations), articles (article_id, title, year, journal_id, ...),
    journals (journal_id, name) and authored_by (article_id, author_id).

    Citations are edges, cites (start_id, end_id), or a column ``incoming_count`` of ``articles``. Where the authors
    come with lists of their articles, ``written`` holds these (author_id, written_articles_ids, ..., and part if there are several).
    """

    authors: DataFrame
    articles: DataFrame
    journals: DataFrame
    authored_by: DataFrame
    cites: DataFrame | None = None
    written: DataFrame | None = None

    @classmethod
    def from_tables(cls, articles: DataFrame, authors: DataFrame, journals: DataFrame) -> "Bibliography":
        """From the tables of `quire.plans.tables`; citation counts come from the list sizes. Only tables in parts
        are shuffled to sum them up."""
        sized = (articles.withColumnRenamed("ID", "article_id")
                 .withColumn("incoming_count", list_size(F.col("incoming_citations")).cast("long"))
                 .drop("authors_ids", "citations", "incoming_citations"))
        authors = authors.withColumnRenamed("ID", "author_id")
        one_row = lambda df: df.filter("part = 0").drop("part") if "part" in df.columns else df
        if "part" in sized.columns:
            counts = sized.groupBy("article_id").agg(F.sum("incoming_count").alias("incoming_count"))
            sized = one_row(sized).drop("incoming_count").join(counts, "article_id")
        return cls(
            authors=one_row(authors).drop("written_articles_ids"),
            articles=sized,
            journals=one_row(journals).drop("Articles"),
            authored_by=explode_list(authors, "author_id", "written_articles_ids", "article_id"),
            written=authors,
        )

    def authorships(self, where: Column) -> DataFrame:
        """(author_id, name, affiliations, article_id) of the authors that meet a condition.

        Of stored lists only those of these authors are exploded, and the condition reaches the scan.
        """
        attributes = ["author_id", "name", "affiliations"]
        if self.written is None:
            return self.authored_by.join(self.authors.filter(where).select(*attributes), "author_id")
        return self.written.filter(where).select(*attributes, F.explode("written_articles_ids").alias("article_id"))

    def authorships_of(self, authors: DataFrame) -> DataFrame:
        """``authors`` (author_id, ...) with an ``article_id`` for each of their articles."""
        if self.written is None:
            return self.authored_by.join(authors, "author_id")
        lists = self.written.select("author_id", "written_articles_ids").join(authors, "author_id")
        return lists.select(*authors.columns, F.explode("written_articles_ids").alias("article_id"))

    def incoming_counts(self, among: DataFrame | None = None) -> DataFrame:
        """(article_id, incoming_count) of ids that are cited at least once; ``among`` (article_id) leaves only those
        ids, before their citations are counted."""
        only = lambda df: df if among is None else df.join(among.select("article_id").distinct(), "article_id", "left_semi")
        if self.cites is None:
            return only(self.articles.select("article_id", "incoming_count").filter("incoming_count > 0"))
        return degree(only(self.cites.select(F.col("end_id").alias("article_id"))), "article_id", "incoming_count")
