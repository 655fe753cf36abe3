"""What the physical plans must and must not contain."""

import contextlib
import io

import pytest

from checks import QUERIES
from checks.views import bibliography
from quire import schemas
from quire.plans import analytics as A
from quire.plans.tables import load_bibliography
from quire.sinks.tables import write_parquet


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# These run actions of their own while they are built, so building them here would be slow.
_WRITERS = {"csv_roundtrip", "tsv_roundtrip", "csv_inferred", "sidecar_header", "graph_export", "jsonl_roundtrip",
            "parquet_roundtrip", "materialize_once", "materialize_after_a_lost_writer", "import_with_rejects",
            "h_index_from_stored_tables", "graph_export_without_loss",
            "edge_export_end_first", "json_doc_files", "json_array_files"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - _WRITERS))
def test_no_python_and_no_cross_join(spark, folder, name):
    plan = _plan(QUERIES[name](spark, folder))
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert word not in plan, word


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = _plan(QUERIES["title_contains"](spark, folder))
    assert "TakeOrderedAndProject" in plan and "StringContains(o_orderpriority,URGENT)" in plan
    plan = _plan(QUERIES["years_with_min_articles"](spark, folder))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_top_authors_are_cut_before_the_join(spark, folder):
    assert "TakeOrderedAndProject" in _plan(QUERIES["works_of_top_authors"](spark, folder))


def test_first_per_key_is_cut_before_the_shuffle(spark, folder):
    for name in ("dedupe_first", "union_first_wins", "enrich_authors", "author_embed"):
        assert "WindowGroupLimit" in _plan(QUERIES[name](spark, folder)), name


def test_ids_do_not_pass_through_the_driver(spark, folder):
    assert "LeftSemi" in _plan(QUERIES["semi_join"](spark, folder))
    assert _plan(QUERIES["drop_edges_both"](spark, folder)).count("LeftAnti") >= 2


def test_stored_lists_are_not_exploded_to_count_them(spark, tmp_path):
    for name, schema in (("article", schemas.ARTICLE), ("author", schemas.AUTHOR), ("journal", schemas.JOURNAL)):
        write_parquet(spark.createDataFrame([], schema), f"{tmp_path}/{name}")
    bib = load_bibliography(spark, str(tmp_path))
    assert "Generate" not in _plan(A.years_with_cited_articles(bib))
    # The authorships come from a list, the citation counts do not.
    assert "Generate" not in _plan(bib.incoming_counts())


def test_known_authors_reduce_the_authorships(spark, folder):
    plan = _plan(A.h_index(bibliography(spark, folder), "Supplier#000000003"))
    assert "EqualTo(s_name,Supplier#000000003)" in plan
