import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire import schemas
from quire.sinks import documents as JS
from quire.sinks import tables as TS
from quire.sources.documents import read_json_docs, read_jsonl
from quire.sources.tables import parse_header_tokens, read_table, read_with_header_file

TITLES = ["a; b", 'the "best" one', "two\nlines", "", None, " blank ", 'ends with "', "back\\slash"]


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TITLES)), "id long, title string")
    TS.write_table(df, f"{tmp_path}/t")
    assert _rows(read_table(spark, f"{tmp_path}/t", df.schema, multi_line=True), "id", "title") == _rows(df, "id", "title")
    inferred = read_table(spark, f"{tmp_path}/t", multi_line=True)
    assert inferred.columns == ["id", "title"] and inferred.count() == len(TITLES)


def test_csv_written_by_another_tool(spark, tmp_path):
    (tmp_path / "f.csv").write_text(':ID;author:string\n1;"O""Neil; J."\n2;"A ""B"""\n')
    df = read_table(spark, f"{tmp_path}/f.csv", T.StructType.fromDDL("id long, name string"))
    assert _rows(df, "id", "name") == [(1, 'O"Neil; J.'), (2, 'A "B"')]


def test_sidecar_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text("article:ID;ee:string[];year:int;title:string\n")
    (tmp_path / "d.csv").write_text("1;a|b;1999;T1\n2;;2001.0;\"T;2\"\n3;c;n/a;\n")
    df = read_with_header_file(spark, f"{tmp_path}/d.csv", f"{tmp_path}/h.csv")
    assert df.columns == ["id", "ee", "year", "title"]
    # The first line is a record like any other.
    assert _rows(df, "id", "ee", "year", "title") == [
        (1, ["a", "b"], 1999, "T1"), (2, None, 2001, "T;2"), (3, ["c"], None, None)]


def test_header_tokens():
    schema = parse_header_tokens([":START_ID", ":END_ID", "volume:string"])
    assert schema.names == ["start_id", "end_id", "volume"]


def test_tsv(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("authorid\tdblp\n7\t\"['A', \"\"O'Neil\"\"]\"\n")
    df = read_table(spark, f"{tmp_path}/a.tsv", T.StructType.fromDDL("authorid long, dblp string"), sep="\t")
    assert _rows(df, "authorid", "dblp") == [(7, "['A', \"O'Neil\"]")]


def test_jsonl_and_nested_filter(spark, tmp_path):
    lines = [{"corpusid": 1, "externalids": {"DBLP": "x"}}, {"corpusid": 2, "externalids": {"DBLP": None}},
             {"corpusid": 3, "externalids": {}}, {"corpusid": 4}]
    (tmp_path / "p.jsonl").write_text("\n".join(map(json.dumps, lines)))
    papers = read_jsonl(spark, f"{tmp_path}/p.jsonl", schemas.PAPER)
    assert papers.count() == 4
    assert _rows(papers.filter(F.col("externalids.DBLP").isNotNull()), "corpusid") == [(1,)]
    JS.write_jsonl(papers.select("corpusid", "title"), f"{tmp_path}/out")
    assert read_jsonl(spark, f"{tmp_path}/out", schemas.PAPER).count() == 4


def test_json_docs(spark, tmp_path):
    docs, empty = tmp_path / "docs", tmp_path / "empty"
    docs.mkdir(), empty.mkdir()
    body = {"body_text": [{"section": "A", "text": "t", "ref_spans": []}], "ref_entries": {"FIGREF0": {"text": "f"}}}
    (docs / "one.json").write_text(json.dumps(body, indent=2))
    (docs / "two.json").write_text(json.dumps([body, body]))
    (docs / "notes.txt").write_text("not a document")
    df = read_json_docs(spark, str(docs), schemas.PAPER_TEXT)
    assert _rows(df, "doc_key") == [("one",), ("two",), ("two",)]
    assert df.first().body_text[0].text == "t"
    assert read_json_docs(spark, str(empty), schemas.PAPER_TEXT).count() == 0


def test_parquet_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2]), (2, None), (3, [])], "id long, ids array<long>")
    for compression in ("zstd", "none"):
        TS.write_parquet(df, f"{tmp_path}/{compression}", compression)
        assert _rows(spark.read.parquet(f"{tmp_path}/{compression}"), "id", "ids") == _rows(df, "id", "ids")


def test_materialize_writes_once(spark, tmp_path):
    path, calls = f"{tmp_path}/t", []

    def make(n):
        calls.append(n)
        return spark.range(n)
    assert TS.materialize(spark, lambda: make(3), path).count() == 3
    assert TS.materialize(spark, lambda: make(5), path).count() == 3
    assert TS.materialize(spark, lambda: make(5), path, overwrite=True).count() == 5
    assert TS.materialize(spark, lambda: make(7), path).count() == 5
    assert calls == [3, 5]


def test_materialize_with_interrupted_and_concurrent_writers(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert TS.committed(spark, path) == (None, 0)

    def fails():
        return spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        TS.materialize(spark, fails, path)
    assert TS.committed(spark, path) == (None, 0)
    # A data folder without a record, and a record that was not finished.
    spark.range(2).write.parquet(f"{path}/data-dead")
    os.makedirs(f"{path}/commit-dead/_temporary/0")
    assert TS.committed(spark, path) == (None, 0)

    def overtaken():
        """While this one writes, another writer commits."""
        assert TS.materialize(spark, lambda: spark.range(5), path).count() == 5
        return spark.range(6)
    assert TS.materialize(spark, overtaken, path).count() == 5
    assert TS.committed(spark, path)[1] == 1
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda n: TS.materialize(spark, lambda: spark.range(n), f"{tmp_path}/u").count(), range(10, 14)))
    assert TS.materialize(spark, lambda: spark.range(1), f"{tmp_path}/u").count() in tables and 1 not in tables
    # An empty table is a table.
    assert TS.materialize(spark, lambda: spark.range(0), f"{tmp_path}/e").count() == 0
    assert TS.materialize(spark, lambda: spark.range(3), f"{tmp_path}/e").count() == 0


def test_graph_export(spark, tmp_path):
    nodes = spark.createDataFrame([(1, "T", ["a", "b"], 1999), (2, None, [], None)],
                                  "id long, title string, ee array<string>, year int")
    edges = spark.createDataFrame([(1, 2, "7")], "start_id long, end_id long, volume string")
    listing = TS.export_graph(spark, {"Publication:Article": nodes}, {"PART_OF": edges}, f"{tmp_path}/g").collect()
    files = {row.label: row for row in listing}
    assert {(r.kind, r.label) for r in listing} == {("nodes", "Publication:Article"), ("edges", "PART_OF")}
    text = lambda path: sorted(r.value for r in spark.read.text(path).collect())
    article = files["Publication:Article"]
    assert text(article.header) == [":ID;title:string;ee:string[];year:int"]
    assert text(article.data) == ['1;T;a|b;1999', '2;;\\e;']
    assert text(files["PART_OF"].header) == [":START_ID;:END_ID;volume:string"]
    assert text(files["PART_OF"].data) == ["1;2;7"]
    assert spark.read.json(f"{tmp_path}/g/manifest").count() == 2


def test_null_prune(spark, tmp_path):
    df = spark.createDataFrame([(1, (None, "x"), None)], "id int, s struct<a:string,b:string>, t string")
    JS.write_documents(df, f"{tmp_path}/d")
    assert [r.value for r in spark.read.text(f"{tmp_path}/d").collect()] == ['{"id":1,"s":{"b":"x"}}']
