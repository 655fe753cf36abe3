import json

from pyspark.sql import functions as F

from quire import schemas
from quire.functions import nested
from quire.functions.leaves import leaf_rows
from quire.plans import documents as D


def _json(spark, rows, schema):
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "v string")
    return lines.select(F.from_json("v", schema).alias("r")).select("r.*")


def _as_dicts(df, key):
    return {row[key]: row.asDict(recursive=True) for row in df.collect()}


def _authors(spark):
    return spark.createDataFrame(
        [(1, "Ann Bell", "x", "x", 10), (2, "Plato", "x", "x", None), (1, "Zoe Second", "x", "x", 3)],
        "authorid long, name string, aliases string, updated string, hindex int")


def _papers(spark):
    stub = lambda i, name: {"authorId": i, "name": name}
    return _json(spark, [
        {"corpusid": 1, "title": "One", "externalids": {"DBLP": "a"}, "publicationdate": "2020-01-02",
         "authors": [stub("2", "Plato"), stub(None, "No Id"), stub("1", "A. Bell"), stub("77", "Un Known")],
         "s2fieldsofstudy": [{"category": "Art"}, {"category": "Law"}, {"category": "Art"}],
         "referencecount": 50, "influentialcitationcount": 4},
        {"corpusid": 2, "title": "Two", "externalids": {"DBLP": "b"}, "authors": [stub("77", "Un Known")]},
        {"corpusid": 3, "title": "Three", "externalids": {"DBLP": "c"}, "authors": []},
        {"corpusid": 4, "title": "Four", "externalids": {}, "authors": []},
    ], schemas.PAPER)


def _texts(spark):
    ref = lambda text, ref_id: {"start": 0, "end": 1, "text": text, "ref_id": ref_id}
    texts = _json(spark, [
        {"body_text": [
            {"section": "A", "text": "spark p1", "cite_spans": [ref("[1]", "B1")],
             "ref_spans": [ref("Fig 1", "FIGREF0"), ref("x", None), ref("Tab", "TABREF0"), ref("?", "FIGREF9")]},
            {"section": "B", "text": "p2", "ref_spans": [ref("x", None)]},
            {"section": "A", "text": "p3", "ref_spans": []}],
         "ref_entries": {"FIGREF0": {"text": "a figure", "type": "figure"}, "TABREF0": {"text": "a table", "type": "table"}}},
        {"body_text": [], "ref_entries": {}},
    ], schemas.PAPER_TEXT)
    return texts.withColumn("corpusid", F.when(F.size("body_text") > 0, 1).otherwise(2).cast("long"))


def _images(spark):
    return spark.createDataFrame([(i, f"author{i}", 10, 20, f"u{i}", f"d{i}") for i in range(3)], schemas.IMAGE)


def test_authors_are_embedded(spark):
    made = _as_dicts(D.embed_authors(_papers(spark), _authors(spark), "corpusid", "anon_"), "corpusid")
    assert [(a["name"], a["email"], a["hindex"]) for a in made[1]["authors"]] == [
        ("Plato", "anon_Plato@gmail.com", None), ("Ann Bell", "A.Bell@gmail.com", 10)]
    assert "updated" not in made[1]["authors"][0] and "aliases" not in made[1]["authors"][0]
    assert made[2]["authors"] == [] and made[3]["authors"] == []


def test_paragraphs_are_cleaned(spark):
    made = D.clean_texts(_texts(spark)).filter("corpusid = 1").first()
    assert [p.section for p in made.paragraphs] == ["A", "B", "A"]
    assert [p.figures_in_paragraph and [r.ref_id for r in p.figures_in_paragraph] for p in made.paragraphs] == [
        ["FIGREF0", "TABREF0", "FIGREF9"], None, None]
    assert "cite_spans" not in made.paragraphs[0].asDict()


def _section_texts(spark, sections, as_coded):
    df = spark.createDataFrame([([{"section": s, "text": t} for s, t in sections],)],
                               "p array<struct<section:string,text:string>>")
    made = df.select(nested.sections(F.col("p"), as_coded).alias("s")).first().s
    return [(s.section_title, [p.text for p in s.paragraphs]) for s in made]


def test_sections(spark):
    rows = [("A", "1"), ("B", "2"), ("A", "3"), (None, "4"), ("B", "5"), (None, "6")]
    assert _section_texts(spark, rows, False) == [("A", ["1", "3"]), ("B", ["2", "5"]), (None, ["4", "6"])]
    assert _section_texts(spark, rows, True) == [("A", ["1"]), ("B", ["2", "3"]), (None, ["4", "5", "6"])]
    assert _section_texts(spark, [], False) == []


def test_sections_of_rows_match_sections_in_a_row(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    packed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.col("role").alias("section"), "text"))).alias("p")).select(
        "conv_id", F.transform("p", lambda p: p.dropFields("turn")).alias("p"))
    for as_coded in (False, True):
        in_row = packed.select("conv_id", F.to_json(F.transform(
            nested.sections(F.col("p"), as_coded), lambda s: F.struct(
                s["section_title"].alias("section_title"), s["paragraphs"]["text"].alias("paragraphs")))).alias("j"))
        as_rows = D.aggregate_sections(turns, "conv_id", "turn", "role", "text", as_coded).select(
            "conv_id", F.to_json("sections").alias("j"))
        assert in_row.exceptAll(as_rows).isEmpty() and as_rows.exceptAll(in_row).isEmpty()


def test_long_documents_come_in_parts(spark):
    texts = ["x" * n for n in [10, 10, 40, 10, 10, 10, 10, 150, 5, 0, 30, 30, 30, 30] * 6]
    turns = spark.createDataFrame(
        [(1, i, "A" if i % 3 else "B", t) for i, t in enumerate(texts)] + [(2, 0, "C", "short"), (2, 1, None, None)],
        "doc int, pos long, title string, text string")
    for as_coded in (False, True):
        made = D.aggregate_sections(turns, "doc", "pos", "title", "text", as_coded, limit=100).collect()
        assert [(r.part, len(r.sections)) for r in made if r.doc == 2] == [(0, 2)]
        long = sorted((r for r in made if r.doc == 1), key=lambda r: r.part)
        sizes = [[len(t) for s in r.sections for t in s.paragraphs] for r in long]
        assert all(sum(part) <= 100 or len(part) == 1 for part in sizes) and len(long) > 10
        if not as_coded:
            by_title = {"A": [], "B": []}
            for row in long:
                for section in row.sections:
                    by_title[section.section_title] += section.paragraphs
            assert by_title == {t: [x for i, x in enumerate(texts) if (t == "A") == (i % 3 > 0)] for t in "AB"}


def test_citations_are_bounded_by_bytes(spark):
    papers = spark.createDataFrame([(i, "t" * (i % 50)) for i in range(400)], "corpusid long, title string")
    edges = spark.createDataFrame([(0, i) for i in range(400)] * 2 + [(1, 2), (3, 999)], "start_id long, end_id long")
    cited = D.citation_records(papers, "corpusid", "title", F.array(F.lit("Ann"), F.lit(None).cast("string")))
    made = D.embed_citations(papers, cited, edges, papers, "corpusid", limit=2000).collect()
    size = lambda c: len(c.title) + 24 + 27 + 24 + 24
    hub = sorted((r for r in made if r.corpusid == 0), key=lambda r: r.part)
    assert [c.reference_id for r in hub for c in r.citations] == list(range(1, 400))
    assert len(hub) > 15 and all(sum(map(size, r.citations)) <= 2000 for r in hub)
    others = {r.corpusid: (r.part, [c.reference_id for c in r.citations]) for r in made if r.corpusid}
    assert len(others) == 399 and others[1] == (0, [2]) and others[3] == (0, [])
    assert {r.corpusid: r.referencecount for r in made}[2] == 2


def test_leaf_rows(spark):
    df = spark.createDataFrame([(1, {"a": [1, None]}, [("x", None), (None, [2.5])]), (2, None, [])],
                               "id int, m map<string, array<int>>, l array<struct<s: string, d: array<double>>>")
    assert sorted(map(tuple, leaf_rows(df, ["id"]).collect())) == [
        (1, "l[0].s", "x"), (1, "l[1].d[0]", "2.5"), (1, "m[a][0]", "1")]


def test_leaf_rows_of_every_nesting(spark):
    """Values come out of one small array for each struct; nulls at every level have no row."""
    df = spark.createDataFrame(
        [(1, ((None, "b"), [[1, None], None, []], {"k": (None, ["x", None])}), None),
         (2, ((3, None), None, {"k": None}), "z"), (3, None, None)],
        "id int, s struct<p: struct<a: int, b: string>, l: array<array<int>>, m: map<string, struct<c: int, d: array<string>>>>, "
        "t string")
    made = leaf_rows(df, ["id"])
    assert sorted(map(tuple, made.collect())) == [
        (1, "s.l[0][0]", "1"), (1, "s.m[k].d[0]", "x"), (1, "s.p.b", "b"), (2, "s.p.a", "3"), (2, "t", "z")]
    wide = spark.range(1).select("id", F.struct(*[F.col("id").alias(f"c{i}") for i in range(30)]).alias("s"))
    assert leaf_rows(wide, ["id"])._jdf.queryExecution().analyzed().toString().count("array(") < 10


def test_very_many_sections(spark):
    doc = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(49_999)), lambda i: F.struct(
        (i % 40_000).cast("string").alias("section"), i.cast("string").alias("text"))).alias("p"))
    for as_coded, last in ((False, ("39999", ["39999"])), (True, ("39999", [str(i) for i in range(39_999, 50_000)]))):
        made = doc.select(nested.sections(F.col("p"), as_coded).alias("s")).select(
            F.size("s").alias("n"), F.element_at("s", -1).alias("last"), F.get("s", 0).alias("first")).first()
        assert made.n == 40_000 and (made.last.section_title, [p.text for p in made.last.paragraphs]) == last
        assert [p.text for p in made.first.paragraphs] == (["0"] if as_coded else ["0", "40000"])


def test_section_numbers_over_blocks(spark):
    titles = ["A", "A", "B", "A", "B", "C", "C", "A", "D", "A", "A"]
    turns = spark.createDataFrame([(d, i, t) for d in (1, 2) for i, t in enumerate(titles)], "doc int, pos long, title string")
    expected = [len(set(titles[:i + 1])) for i in range(len(titles))]
    for block in (1, 2, 3, 100):
        made = D.number_sections(turns, "doc", "pos", "title", block).orderBy("doc", "pos").collect()
        assert [r.section_no for r in made] == expected * 2


def test_documents_end_to_end(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (1, 3), (3, 1), (1, 4), (4, 1), (1, 99)],
                                  "start_id long, end_id long")
    built = D.build_documents(_papers(spark), _authors(spark), _texts(spark), _images(spark), edges, "anon_")
    made = _as_dicts(built, "corpusid")
    assert set(made) == {1, 2, 3}
    one = made[1]
    assert [(c["reference_id"], c["title"], c["authors"]) for c in one["citations"]] == [(2, "Two", []), (3, "Three", [])]
    assert made[3]["citations"][0]["authors"] == ["Plato", "Ann Bell"] and made[2]["citations"] == []
    assert [made[i]["referencecount"] for i in (1, 2, 3)] == [1, 1, 1]
    assert "influentialcitationcount" not in one
    assert one["s2fieldsofstudy"] == ["Art", "Law"] and made[3]["s2fieldsofstudy"] == []
    assert one["publicationdate"] == {"$date": "2020-01-02"}
    content = one["content"]
    assert content["keywords"] == ["SPARK"]
    assert [(s["section_title"], [p["text"] for p in s["paragraphs"]]) for s in content["sections"]] == [
        ("A", ["spark p1", "p3"]), ("B", ["p2"])]
    figure, table, unknown = content["sections"][0]["paragraphs"][0]["figures_in_paragraph"]
    assert (figure["caption"], figure["text"], figure["type"]) == ("Fig 1", "a figure", "figure")
    assert figure["author"].startswith("author") and figure["width"] == 10 and figure["download_url"].startswith("d")
    assert (table["caption"], table["text"], table["author"]) == ("Tab", "a table", None)
    assert (unknown["caption"], unknown["text"], unknown["type"]) == (None, "?", None)
    assert [(f["fig_id"], f["text"], f["type"]) for f in content["list_of_figures"]] == [
        ("FIGREF0", None, "figure"), ("TABREF0", "a table", "table")]
    assert content["list_of_figures"][0]["author"] == figure["author"]
    assert made[2]["content"]["list_of_figures"] is None and made[2]["content"]["sections"] == []
    assert made[3]["content"] is None


def test_papers_with_authors_are_built_once(spark, tmp_path):
    """With a scratch folder neither authors nor stubs are in the plan any more, and the documents are the same. Without
    one, citations that fit into a row are looked up once: the plan stays small."""
    edges = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (1, 3), (3, 1), (1, 4), (4, 1), (1, 99)],
                                  "start_id long, end_id long")
    build = lambda **given: D.build_documents(
        _papers(spark), _authors(spark), _texts(spark), _images(spark), edges, "anon_", **given)
    plain, stored = build(), build(scratch=str(tmp_path / "papers"))
    rows = lambda df: sorted(map(tuple, leaf_rows(df, ["corpusid"]).collect()))
    assert rows(plain) == rows(stored)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan(plain) and "posexplode" not in plan(stored)
    assert plan(stored).count("Join") < 70


def test_citations_of_few_and_of_many(spark, monkeypatch):
    """Documents that surely fit into a row are not sized; rows and parts are those of sizing all."""
    papers = spark.createDataFrame([(i, "t" * (i % 50)) for i in range(300)] + [(7, "again")], "corpusid long, title string")
    edges = spark.createDataFrame([(0, i) for i in range(300)] + [(1, i) for i in range(40)] + [(2, 7), (2, 3), (3, 999)],
                                  "start_id long, end_id long")
    cited = D.citation_records(papers, "corpusid", "title", F.array(F.lit("Ann")))
    made = lambda: sorted((r.corpusid, r.part, [(c.reference_id, c.title) for c in r.citations], r.referencecount) for r in
                          D.embed_citations(papers, cited, edges, papers, "corpusid", limit=5000).collect())
    whole = made()
    assert len([r for r in whole if r[0] == 0]) > 5 and [r[1] for r in whole if r[0] == 2] == [0]
    monkeypatch.setattr(D, "GATHERED_BYTES", 5000)
    assert made() == whole


def test_first_papers_only(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3)], "start_id long, end_id long")
    built = D.build_documents(_papers(spark), _authors(spark), _texts(spark), _images(spark), edges, "anon_", n=2)
    assert sorted(r.corpusid for r in built.collect()) == [1, 2]


def test_as_coded_sections_in_documents(spark):
    edges = spark.createDataFrame([], "start_id long, end_id long")
    built = D.build_documents(_papers(spark), _authors(spark), _texts(spark), _images(spark), edges, "anon_",
                              as_coded=True)
    sections = _as_dicts(built, "corpusid")[1]["content"]["sections"]
    assert [(s["section_title"], [p["text"] for p in s["paragraphs"]]) for s in sections] == [
        ("A", ["spark p1"]), ("B", ["p2", "p3"])]


def test_wide_lists_are_dealt_finely(spark):
    """Lists of authors and of citations are built in four times as many tasks as there are shuffle partitions."""
    import re
    finer = lambda df, key: re.search(rf"hashpartitioning\({key}#\d+L[^)]*, {4 * 4}\)", df._jdf.queryExecution().executedPlan().toString())
    assert finer(D.embed_authors(_papers(spark), _authors(spark), "corpusid", "anon_"), "corpusid")
    papers = spark.range(20).selectExpr("id AS corpusid", "'title' AS title")
    cited = D.citation_records(papers, "corpusid", "title", F.array().cast("array<string>"))
    edges = spark.range(90).selectExpr("id % 20 AS start_id", "id % 7 AS end_id")
    assert finer(D.embed_citations(papers, cited, edges, papers, "corpusid", limit=200), "corpusid")
