"""Building and cleaning edge tables (start_id, end_id, properties)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.lists import degree
from quire.operators.rows import drop_placeholder, natural_join, union_all


def publication_keys(frames: list[DataFrame], id_col: str = "id", key_col: str = "key") -> DataFrame:
    """(id, key) of publications of all types."""
    return union_all([frame.select(F.col(id_col).alias("id"), F.col(key_col).alias("key")) for frame in frames])


def citation_keys(has_citation: DataFrame, cite: DataFrame, placeholder: str = "...") -> DataFrame:
    """(start_id, key): the citing id and the key of what it cites.

    ``has_citation`` is (start_id, end_id), ``cite`` is (end_id, key).
    """
    return natural_join(has_citation, drop_placeholder(cite, "key", placeholder)).select("start_id", "key")


def resolve_edges(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """Replace the target key of (start_id, key) by the id it stands for; unknown keys drop out."""
    targets = keys.select(F.col("id").alias("end_id"), "key")
    return keyed.join(targets, "key").select("start_id", "end_id")


def child_parent_edges(child: DataFrame, parent: DataFrame, foreign_key: str, parent_key: str,
                       props: list[str]) -> DataFrame:
    """Edges from a child to the parent its foreign key names, with properties taken from the child."""
    children = child.select(F.col("id").alias("start_id"), F.col(foreign_key).alias("_key"), *props)
    parents = parent.select(F.col("id").alias("end_id"), F.col(parent_key).alias("_key"))
    return children.join(parents, "_key").select("start_id", "end_id", *props)


def push_props_to_edge(edges: DataFrame, nodes: DataFrame, props: list[str]) -> DataFrame:
    """Move properties of the start node onto the edge; edges without a start node drop out."""
    carried = nodes.select(F.col("id").alias("start_id"), *props)
    return edges.select("start_id", "end_id").join(carried, "start_id").select("start_id", "end_id", *props)


def drop_edges(edges: DataFrame, ids: DataFrame, ends: tuple[str, ...] = ("start", "end")) -> DataFrame:
    """Drop edges that touch an id of ``ids`` (its first column) at one of the named ends."""
    columns = edges.columns
    for end in ends:
        excluded = ids.select(F.col(ids.columns[0]).alias(f"{end}_id")).distinct()
        edges = edges.join(excluded, f"{end}_id", "left_anti")
    return edges.select(*columns)


def proper_edges(edges: DataFrame) -> DataFrame:
    """Edges without repeats and without links of a node to itself."""
    return edges.select("start_id", "end_id").filter("start_id <> end_id").distinct()


def recount_in_degree(nodes: DataFrame, edges: DataFrame, id_col: str, name: str) -> DataFrame:
    """Set ``name`` to the number of incoming edges, 0 where there is none."""
    counts = degree(edges.select(F.col("end_id").alias(id_col)), id_col, "_n")
    return (nodes.drop(name).join(counts, id_col, "left")
            .withColumn(name, F.coalesce("_n", F.lit(0))).drop("_n"))
