"""Preparing the property graph: cleaned node and edge tables from raw bibliographic tables."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import parse_list_literal
from quire.operators import edges as E
from quire.operators.columns import prune_columns
from quire.operators.entities import enrich_entities
from quire.operators.rows import union_all

# The properties each node label keeps. Number, pages and volume live on edges where there is one.
KEPT_PROPERTIES = {
    "Publication:Article": ["id", "ee", "ee_type", "key", "mdate", "cdate", "note", "note_type", "title", "url", "year"],
    "Publication:Inproceeding": ["id", "ee", "key", "mdate", "title", "url", "year", "booktitle"],
    "Publication:Proceeding": ["id", "ee", "key", "mdate", "title", "url", "year", "booktitle", "isbn"],
    "Publication:Book": ["id", "ee", "key", "mdate", "title", "url", "year", "isbn", "pages"],
    "PhdThesis": ["id", "key", "ee", "mdate", "title", "year"],
}
PUBLICATION_TYPES = ("article", "book", "incollection", "inproceedings", "proceedings")


@dataclass(frozen=True)
class Graph:
    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)


def build_graph(tables: dict[str, DataFrame], placeholder: str = "...") -> Graph:
    """Node tables per label and edge tables per type.

    ``tables`` holds the publication types, homepage, phdthesis, mastersthesis, author, external_author, editor,
    publisher, journal, school, series (nodes) and cite, has_citation, authored_by, published_by, edited_by,
    published_in, is_part_of, submitted_at (raw relations). Everything stays lazy; write what you need.
    """
    t = tables
    keys = E.publication_keys([t[name] for name in PUBLICATION_TYPES])
    incollection, homepage = t["incollection"].select("id"), t["homepage"].select("id")
    outside = union_all([homepage, incollection])

    cites = E.resolve_edges(E.citation_keys(t["has_citation"], t["cite"], placeholder), keys)
    placed = ["number", "pages", "volume"]
    volumes = union_all([t["book"].select("id", "volume"), t["proceedings"].select("id", "volume")])
    edges = {
        "CITES": E.drop_edges(cites, outside),
        "BELONG_TO": E.child_parent_edges(t["inproceedings"], t["proceedings"], "crossref", "key", placed),
        "PUBLISHED_IN": E.push_props_to_edge(t["published_in"], t["article"], placed),
        "PART_OF": E.push_props_to_edge(t["is_part_of"], volumes, ["volume"]),
        "AUTHORED_BY": E.drop_edges(t["authored_by"], outside, ("start",)),
        "PUBLISHED_BY": E.drop_edges(t["published_by"], incollection, ("start",)),
        "EDITED_BY": E.drop_edges(t["edited_by"], homepage, ("start",)),
        "SUBMITTED_AT": t["submitted_at"],
    }

    external = (t["external_author"].filter(F.col("dblp").isNotNull())
                .withColumn("dblp", parse_list_literal(F.col("dblp"))))
    authors = enrich_entities(t["author"], external, alias_col="dblp", order_col="authorid",
                              drop=("externalids", "aliases", "updated"))
    nodes = {label: prune_columns(t[name], KEPT_PROPERTIES[label]) for label, name in (
        ("Publication:Article", "article"), ("Publication:Inproceeding", "inproceedings"),
        ("Publication:Proceeding", "proceedings"), ("Publication:Book", "book"), ("PhdThesis", "phdthesis"))}
    nodes |= {"Author": authors} | {label: t[name] for label, name in (
        ("MasterThesis", "mastersthesis"), ("Editor", "editor"), ("Publisher", "publisher"),
        ("Journal", "journal"), ("School", "school"), ("Series", "series"))}
    return Graph(nodes, edges)
