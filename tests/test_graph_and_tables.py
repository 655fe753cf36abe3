from pyspark.sql import functions as F

from quire import schemas
from quire.plans import analytics as A
from quire.plans import tables as T
from quire.plans.bibliography import Bibliography
from quire.plans.graph import build_graph
from quire.sinks.tables import write_parquet


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _raw(spark):
    """Article 1, book 2, incollection 3, inproceedings 4 and 5, proceedings 6, homepage 7."""
    make = lambda rows, schema: _frame(spark, rows, schema)
    publication = "id long, key string, title string, number string, pages string, volume string, crossref string"
    pub = lambda *rows: make([(i, k, f"t{i}", f"n{i}", f"p{i}", f"v{i}", c) for i, k, c in rows], publication)
    named = lambda *rows: make(list(rows), "id long, name string")
    edge = lambda *rows: make(list(rows), "start_id long, end_id long")
    return {
        "article": pub((1, "a/1", None)), "book": pub((2, "b/2", None)), "incollection": pub((3, "i/3", None)),
        "inproceedings": pub((4, "c/4", "p/6"), (5, "c/5", "p/none")), "proceedings": pub((6, "p/6", None)),
        "homepage": make([(7,)], "id long"), "phdthesis": pub((8, "x/8", None)),
        "mastersthesis": named((9, "m")), "editor": named((20, "e")), "publisher": named((21, "p")),
        "journal": named((22, "j")), "school": named((23, "s")), "series": named((24, "r")),
        "author": named((30, "A. One"), (31, "B. Two"), (32, "Nobody")),
        "external_author": make(
            [(100, "ids", "['A. One', 'Ann O.']", "Ann One", "x", 7, "u"), (101, "ids", "['B. Two']", "Bea Two", "x", 8, "u"),
             (102, "ids", "['B. Two']", "Late", "x", 9, "u"), (103, "ids", None, "Z", "x", 9, "u")],
            "authorid long, externalids string, dblp string, name string, aliases string, hindex int, updated string"),
        "has_citation": edge((1, 50), (1, 51), (7, 52), (2, 53), (4, 54), (2, 55), (1, 53)),
        "cite": make([(50, "b/2"), (51, "..."), (52, "a/1"), (53, "c/4"), (54, "i/3"), (55, "gone")],
                     "end_id long, key string"),
        "authored_by": edge((1, 30), (3, 30), (7, 31), (4, 31)),
        "published_by": edge((2, 21), (3, 21), (7, 21)), "edited_by": edge((6, 20), (7, 20), (3, 20)),
        "published_in": edge((1, 22), (999, 22)), "is_part_of": edge((2, 24), (6, 24), (1, 24)),
        "submitted_at": edge((8, 23)),
    }


def test_graph_end_to_end(spark):
    graph = build_graph(_raw(spark))
    edges = {name: _rows(df, *df.columns) for name, df in graph.edges.items()}
    assert edges == {
        "CITES": [(1, 2), (1, 4), (2, 4)],
        "BELONG_TO": [(4, 6, "n4", "p4", "v4")],
        "PUBLISHED_IN": [(1, 22, "n1", "p1", "v1")],
        "PART_OF": [(2, 24, "v2"), (6, 24, "v6")],
        "AUTHORED_BY": [(1, 30), (4, 31)],
        "PUBLISHED_BY": [(2, 21), (7, 21)],
        "EDITED_BY": [(3, 20), (6, 20)],
        "SUBMITTED_AT": [(8, 23)],
    }
    assert _rows(graph.nodes["Author"], "id", "name", "hindex") == [
        (30, "Ann One", 7), (31, "Bea Two", 8), (32, "Nobody", None)]
    assert graph.nodes["Author"].columns == ["id", "name", "hindex"]
    assert graph.nodes["Publication:Article"].columns == ["id", "key", "title"]
    assert graph.nodes["Publication:Book"].columns == ["id", "key", "title", "pages"]
    assert len(graph.nodes) == 12


def _bibliography(spark, citations):
    """One author with one article per entry of ``citations``, cited that often."""
    articles = [(i, f"Title {i}", 2000 + i % 2, 1) for i in range(len(citations))]
    cites = [(1000 + k, i) for i, n in enumerate(citations) for k in range(n)]
    return Bibliography(
        _frame(spark, [(1, "S. Ceri", 5, ["X", "Y"]), (2, "Other", None, None)],
               "author_id long, name string, citationcount int, affiliations array<string>"),
        _frame(spark, articles, "article_id long, title string, year int, journal_id long")
        .withColumn("url", F.lit("u")),
        _frame(spark, [(1, "Medicine Today")], "journal_id long, name string"),
        _frame(spark, [(i, 1) for i in range(len(citations))], "article_id long, author_id long"),
        _frame(spark, cites, "start_id long, end_id long"))


def _h(citations):
    return max([0] + [h for h in range(1, len(citations) + 1) if sum(c >= h for c in citations) >= h])


def test_h_index(spark):
    for citations in ([5, 4, 4, 1], [], [0, 0], [1], [10, 10], [3, 3, 3], [9, 7, 6, 2, 1], [1, 1, 1, 1]):
        bib = _bibliography(spark, citations) if citations else _bibliography(spark, [0])
        assert _rows(A.h_index(bib), "name", "h_index") == [("Other", 0), ("S. Ceri", _h(citations))]
    bib = _bibliography(spark, [5, 4, 4, 1])
    assert A.h_index(bib, A.AUTHOR).first().h_index == 3
    assert A.h_index(bib, A.AUTHOR, as_coded=True).first().h_index == 1


def test_thresholds_are_inclusive(spark):
    bib = _bibliography(spark, [10, 9, 11, 0])
    assert A.i_index(bib, A.AUTHOR).first().i_index == 2
    assert _rows(A.years_with_min_articles(bib, 2), "year", "articles") == [(2000, 2), (2001, 2)]
    assert _rows(A.years_with_cited_articles(bib, 1, 9), "year", "articles") == [(2000, 2), (2001, 1)]
    assert A.title_contains(bib, "Title", 2).count() == 2 and A.title_contains(bib, "title", 2).count() == 0
    assert _rows(A.topical_venues(bib, title_pattern="Title [12]", min_count=2), "name", "articles") == [("Medicine Today", 2)]


def test_default_parameters(spark):
    bib = _bibliography(spark, [1, 2])
    assert A.articles_by_author(bib).count() == 2
    assert _rows(A.works_of_top_authors(bib), "title", "citationcount", "name") == [
        ("Title 0", 5, "S. Ceri"), ("Title 1", 5, "S. Ceri")]
    assert A.top_venue_in_year(bib, 2000).first().asDict() == {"year": 2000, "name": "Medicine Today", "articles": 1}


def test_affiliation_counts(spark):
    bib = _bibliography(spark, [1, 1])
    two = Bibliography(bib.authors.withColumn("affiliations", F.array(F.lit("X"))), bib.articles, bib.journals,
                       bib.authored_by.unionByName(bib.authored_by.withColumn("author_id", F.lit(2).cast("long"))), bib.cites)
    assert A.venues_of_affiliation(two, "X", 1).first().articles == 2
    assert A.venues_of_affiliation(two, "X", 1, as_coded=True).first().articles == 4


def test_tables_written_and_loaded(spark, tmp_path):
    edge = "start_id long, end_id long"
    articles = _frame(spark, [(i, f"k{i}", f"t{i}", "a|b", None, "2020-01-01", None, None, 2000, "n", "p", "v")
                              for i in range(1, 6)], schemas.ARTICLE_RAW)
    authors = _frame(spark, [(1, "Ann", "['X', \"Y's\"]", "['0-1', '0-2']", 3, 4, 5), (2, "Bob", None, None, None, None, None)],
                     "id long, name string, affiliations string, orcid string, hindex int, papercount int, citationcount int")
    authored = _frame(spark, [(i, 1) for i in range(1, 6)] + [(99, 1)], edge)
    cites = _frame(spark, [(j, 1) for j in range(2, 6)] + [(2, 3)], edge)
    placed = _frame(spark, [(1, 7), (2, 7), (3, 7), (4, None)], edge).withColumns(
        {c: F.lit(c) for c in ("number", "pages", "volume")})
    for block in (2, 1000):
        base = f"{tmp_path}/{block}"
        write_parquet(T.article_table(articles, authored, placed, cites, block=block), f"{base}/article")
        write_parquet(T.author_table(authors, articles, authored, block=block), f"{base}/author")
        write_parquet(T.journal_table(_frame(spark, [(7, "J"), (8, "K")], "id long, name string"), placed, block),
                      f"{base}/journal")
        bib = T.load_bibliography(spark, base)
        assert _rows(bib.articles, "article_id", "incoming_count", "journal_id") == [
            (1, 4, 7), (2, 0, 7), (3, 1, 7), (4, 0, None), (5, 0, None)]
        assert _rows(bib.authored_by, "article_id", "author_id") == [(i, 1) for i in range(1, 6)]
        assert _rows(bib.authors, "author_id", "orcid", "affiliations") == [(1, "0-1", ["X", "Y's"]), (2, None, None)]
        assert _rows(bib.journals, "journal_id", "NumArticles") == [(7, 3), (8, None)]
        assert _rows(A.h_index(bib), "author_id", "h_index") == [(1, 1), (2, 0)]
        # Ann's list may have several parts; all of them count.
        assert _rows(A.articles_by_author(bib, "Ann"), "article_id", "name") == [(i, "Ann") for i in range(1, 6)]
        assert A.articles_by_author(bib, "Ann").first().url == [""]
        assert A.h_index(bib, "Ann").first().h_index == 1 and A.i_index(bib, "Ann", 1).first().i_index == 2
        assert A.works_of_top_authors(bib, 1).count() == 5
        assert _rows(A.venues_of_affiliation(bib, "Y's", 1), "name", "articles") == [("J", 3)]
        assert not bib.articles.schema["article_id"].nullable
        assert _rows(A.years_with_cited_articles(bib, 1, 4), "year", "articles") == [(2000, 1)]
        assert T.rejected_on_load(spark, base).isEmpty()


def test_load_counts_what_it_rejects(spark, tmp_path):
    for name, (schema, _) in T._STORED.items():
        write_parquet(spark.createDataFrame([], schema), f"{tmp_path}/{name}")
    write_parquet(spark.createDataFrame([("1", "x"), ("2", "1999"), (None, "2000")], "ID string, year string"),
                  f"{tmp_path}/article", mode="overwrite")
    assert _rows(T.rejected_on_load(spark, str(tmp_path)), "table", "column", "rejected") == [
        ("article", "row without key", 1), ("article", "year", 1)]
    assert T.load_bibliography(spark, str(tmp_path)).articles.count() == 2
    bib, rejects = T.import_bibliography(spark, str(tmp_path), f"{tmp_path}/typed")
    assert _rows(rejects, "table", "column", "rejected") == [("article", "row without key", 1), ("article", "year", 1)]
    assert _rows(bib.articles, "article_id", "year") == [(1, None), (2, 1999)] and bib.authors.isEmpty()
    assert T.rejected_on_load(spark, f"{tmp_path}/typed").isEmpty()


def test_only_articles_count(spark):
    """Authorship and citation of a book do not raise an index, from edges as from tables."""
    bib = _bibliography(spark, [1])
    edge = "start_id long, end_id long"
    authored = bib.authored_by.unionByName(_frame(spark, [(77, 1)], "article_id long, author_id long"))
    cites = bib.cites.unionByName(_frame(spark, [(i, 77) for i in range(500, 530)], edge))
    more = Bibliography(bib.authors, bib.articles, bib.journals, authored, cites)
    for name in (None, A.AUTHOR):
        assert A.h_index(more, name).filter(F.col("name") == A.AUTHOR).first().h_index == 1
        assert A.i_index(more, name, 1).filter(F.col("name") == A.AUTHOR).first().i_index == 1
