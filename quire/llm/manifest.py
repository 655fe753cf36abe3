"""A Merkle manifest of a table: one tree per group, one tree over the groups, and a proof for every row.

The built levels are stored as parent-linked node rows. Proofs come from a recursive SQL query: every leaf starts at
its own hash, and each step joins its node to the row of the parent, notes the other members of the run (the siblings)
and folds the hash that it carries with them. What arrives at the top must be the root, or the row was tampered with.

Digests are 32 bytes in the stored tables; hashes are taken of their lower-case hex text.

- A leaf may have any null field. Equal rows are leaves of their own. Null ids come first in their group, the null group
  comes first among groups. An empty table has no leaves, no proofs and no root.
- Upper nodes have many leaves below. They are kept once for each block of 4,096 leaves, so that no step of the climb
  joins more than 4,096 rows to one key, whatever the size of a group.
- Above their first two steps, 64 neighbours meet the same siblings. All of them fold these, but only the first one
  appends them, for all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.llm.ordering import numbered
from quire.llm.store import stored

RUN = 8
#: Leaves per copy of an upper node: RUN ** BLOCK_LEVELS.
BLOCK_LEVELS = 4
#: Steps at which every leaf appends its siblings; those above are the same for RUN ** OWN_STEPS neighbours.
OWN_STEPS = 2


class Manifest(NamedTuple):
    """leaves: tree, no (from 0), id, leaf, claim, and at, where its climb starts: its own position, or that of its tree
    if it is alone there. nodes: tree, part, step, no, members, up_no, up_slot. roots: tree, subroot, root. Trees are
    named by their position among all."""
    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame


def field(value: Column) -> Column:
    """A value that cannot be mistaken for its neighbours: its byte count, a colon, its text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """SHA-256 of the concatenated texts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*values).cast("binary"), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Levels of all trees from (tree, no, n, blocks, hash), the leaves first: (tree, level, no, n, blocks, hash,
    members), where members are the joined hashes of the level below. Each level is stored."""
    levels = [leaves.withColumn("level", F.lit(0)).withColumn("members", F.lit(None).cast("binary"))]
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        below = levels[-1].filter("n > 1")
        runs = below.groupBy("tree", F.expr(f"no div {RUN}").alias("no"), "n", "blocks").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", F.hex("hash").alias("hash")))),
                                     lambda x: x["hash"]), "").alias("joined"))
        levels.append(stored(runs.select(
            "tree", "no", F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"), "blocks", digest(F.lower("joined")).alias("hash"),
            F.lit(len(levels)).alias("level"), F.unhex("joined").alias("members")), "level"))
        largest = -(-largest // RUN)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The last node of every tree."""
    tops = [level.filter("n = 1").select("tree", "hash", "level", "blocks") for level in levels]
    made = tops[0]
    for more in tops[1:]:
        made = made.unionByName(more)
    return made


def _all(levels: list[DataFrame]) -> DataFrame:
    made = levels[1]
    for more in levels[2:]:
        made = made.unionByName(more)
    return made


def build(leaves: DataFrame) -> Manifest:
    """The manifest of (row: unique long, tree: non-null string, id, leaf and claim: digests). Leaves of a tree go by id,
    then by hash, then by row; trees go by their name, bytewise."""
    block = RUN ** BLOCK_LEVELS
    leaves = stored(numbered(leaves, "tree", ["id", "leaf", "row"]), "leaves")
    lower = _levels(leaves.select("tree", "no", "n", F.expr(f"(n + {block - 1}) div {block}").alias("blocks"),
                                  F.col("leaf").alias("hash")))
    tops = stored(numbered(_tops(lower).select(F.lit("").alias("all"), "*"), "all", ["tree"]).drop("all"), "subroots")
    upper = _levels(tops.select(F.lit("").alias("tree"), "no", "n", F.lit(1).cast("long").alias("blocks"), "hash"))
    root = _tops(upper).first()

    # Lower nodes: above the blocks a node has a copy for each block below it.
    into_top = F.when(F.col("trees") > 1, F.col("top_no"))
    up_no = lambda last: F.when(last, F.expr(f"top_up div {RUN}")).otherwise(F.expr(f"no div {RUN}"))
    up_slot = lambda last: F.when(last, F.expr(f"top_up % {RUN}")).otherwise(F.expr(f"no % {RUN}"))
    trees = tops.select("tree", F.col("no").alias("top_no"), F.col("n").alias("trees"), "level", "blocks")
    nodes = []
    if len(lower) > 1:
        in_block = F.col("level") <= BLOCK_LEVELS
        linked = (_all(lower).join(trees.select("tree", "top_no", into_top.alias("top_up")), "tree")
                  .withColumn("width", F.pow(F.lit(float(RUN)), F.abs(F.col("level") - BLOCK_LEVELS)).cast("long"))
                  .withColumn("first", F.when(in_block, F.expr("no div width")).otherwise(F.expr("no * width"))))
        final = F.when(in_block, F.col("first")).otherwise(F.least(F.expr("first + width"), F.col("blocks")) - 1)
        last = F.col("n") == 1
        nodes.append(linked.select(F.col("top_no").alias("tree"), F.explode(F.sequence("first", final)).alias("part"),
                                   F.col("level").cast("int").alias("step"), "no", "members",
                                   up_no(last).alias("up_no"), up_slot(last).alias("up_slot")))
    # Upper nodes: a copy for each block of every tree below, as steps that go on above the tree's own.
    if len(upper) > 1:
        tree_over = _all(upper).select(F.col("level").alias("over"), F.col("no").alias("at"), "members",
                                       (F.col("n") == 1).alias("is_root"))
        paths = (trees.withColumn("over", F.explode(F.sequence(F.lit(1), F.lit(len(upper) - 1))))
                 .withColumn("width", F.pow(F.lit(float(RUN)), F.col("over")).cast("long"))
                 .withColumn("at", F.expr("top_no div width")))
        linked = paths.join(tree_over, ["over", "at"])
        last = F.col("is_root")
        nodes.append(linked.select(
            F.col("top_no").alias("tree"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part"),
            (F.col("level") + F.col("over")).cast("int").alias("step"), F.col("at").alias("no"), "members",
            F.when(~last, F.expr(f"at div {RUN}")).alias("up_no"), F.when(~last, F.expr(f"at % {RUN}")).alias("up_slot")))
    if nodes:
        rows = nodes[0] if len(nodes) == 1 else nodes[0].unionByName(nodes[1])
    else:
        rows = leaves.sparkSession.createDataFrame(
            [], "tree long, part long, step int, no long, members binary, up_no long, up_slot long")
    # A lone leaf is the subroot of its tree and starts in the tree over the trees.
    placed = leaves.join(trees.select("tree", "top_no", into_top.alias("top_up")), "tree").select(
        F.col("top_no").alias("tree"), "no", "id", "leaf", "claim",
        F.when(F.col("n") > 1, F.col("no")).otherwise(F.col("top_up")).alias("at"))
    return Manifest(stored(placed, "start"), stored(rows, "nodes"), stored(tops.select(
        F.col("no").alias("tree"), F.col("hash").alias("subroot"),
        F.lit(root["hash"] if root else None).cast("binary").alias("root")), "roots"))


_LEFT = "substring(n.members, 1, CAST(32 * c.slot AS INT))"
_RIGHT = f"substring(n.members, CAST(32 * c.slot + 33 AS INT), {32 * RUN})"

#: Every step looks up the parent's row: the other members of the run are the siblings, and the carried hash takes its
#: own place among them. A row's step is the one that it goes on with; no is null at the root.
_CLIMB = """
WITH RECURSIVE climb(tree, leaf, step, no, slot, folded, siblings) MAX RECURSION LEVEL 60 AS (
  SELECT tree, no, 1, at div {run}, at % {run}, claim, CAST('' AS BINARY) FROM {{start}}
  UNION ALL
  SELECT c.tree, c.leaf, c.step + 1, n.up_no, n.up_slot,
         unhex(sha2(lower(hex(concat({left}, c.folded, {right}))), 256)),
         CASE WHEN c.step <= {own} OR c.leaf % {shared} = 0 THEN concat({left}, {right}) ELSE CAST('' AS BINARY) END
  FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.leaf div {block} = n.part AND c.step = n.step AND c.no = n.no)
SELECT * FROM climb LIMIT ALL"""


def _joined(steps: Column) -> Column:
    return F.aggregate(F.array_sort(steps), F.lit("").cast("binary"), lambda all, s: F.concat(all, s["siblings"]))


def proofs(manifest: Manifest) -> DataFrame:
    """(tree, id, leaf, proof, folded) of every leaf: proof holds the siblings from the leaf's level to the root's, left
    to right, as joined digests; folded is the root that the claim leads to.

    The recursive query stores each step by its own exchange. LIMIT ALL lifts its row limit, as every leaf has a row for
    every level. Then one more exchange brings 64 neighbours together: their leaves, their own steps, and the steps that
    the first of them has appended for all.
    """
    shared = RUN ** OWN_STEPS
    query = _CLIMB.format(run=RUN, left=_LEFT, right=_RIGHT, own=OWN_STEPS, shared=shared, block=RUN ** BLOCK_LEVELS)
    climbed = manifest.leaves.sparkSession.sql(query, start=manifest.leaves, nodes=manifest.nodes)
    own_step = F.col("step") <= OWN_STEPS + 1
    kind = "struct<step: int, siblings: binary>"
    entry = lambda where: F.when(where & (F.octet_length("siblings") > 0), F.struct("step", "siblings").cast(kind))
    steps = climbed.select(
        "tree", F.expr(f"leaf div {shared}").alias("shared"), "leaf", entry(own_step).alias("own"),
        entry(~own_step).alias("upper"), F.when(F.col("no").isNull(), F.col("folded")).alias("folded"),
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("hash")
    ).filter("own IS NOT NULL OR upper IS NOT NULL OR folded IS NOT NULL")
    plain = manifest.leaves.select(
        "tree", F.expr(f"no div {shared}").alias("shared"), F.col("no").alias("leaf"), F.lit(None).cast(kind).alias("own"),
        F.lit(None).cast(kind).alias("upper"), F.lit(None).cast("binary").alias("folded"), "id", F.col("leaf").alias("hash"))
    each = (steps.unionByName(plain).repartition("tree", "shared").groupBy("tree", "shared", "leaf")
            .agg(F.collect_list("own").alias("own"), F.collect_list("upper").alias("upper"), F.max("folded").alias("folded"),
                 F.max("id").alias("id"), F.max("hash").alias("hash")))
    # The first of the neighbours has the upper steps; there are at most 64 rows to a window.
    return each.select("tree", "id", F.col("hash").alias("leaf"), F.concat(
        _joined(F.col("own")), F.max(_joined(F.col("upper"))).over(Window.partitionBy("tree", "shared"))).alias("proof"), "folded")


def audited(documents: DataFrame, columns: list[str], tree_column: str, id_column: str, where: Column,
            tampered: dict[str, Column]) -> DataFrame:
    """Every row of `documents` as a leaf of the named columns, with subroot, root, proof, the root folded from the
    row as found and whether it equals the root. Rows `where` an intruder was hold the values of `tampered`.

    Returns doc_id, leaf, subroot, root, folded_root (hex text), proof (joined digests) and verified.
    """
    plain = [F.col(f"`{c}`") for c in columns]
    changed = [tampered.get(c, F.col(f"`{c}`")) for c in columns]
    tree = F.coalesce(F.concat(F.lit("1"), F.col(f"`{tree_column}`").cast("string")), F.lit("0"))
    hashed = stored(documents.select(
        F.monotonically_increasing_id().alias("row"), tree.alias("tree"), F.col(f"`{id_column}`").alias("id"),
        digest(*map(field, plain)).alias("leaf"), F.when(where, digest(*map(field, changed))).alias("claim")),
        "hashed")
    manifest = build(hashed.withColumn("claim", F.coalesce("claim", "leaf")))
    return proofs(manifest).join(manifest.roots, "tree").select(
        F.col("id").alias("doc_id"), hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"), hex_text(F.col("folded")).alias("folded_root"), "proof",
        (F.col("folded") == F.col("root")).alias("verified"))
