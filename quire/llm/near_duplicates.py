"""Near-duplicate documents by MinHash with tensored banding, verified on full shingle sets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quire.llm import words
from quire.llm.graph import stars
from quire.llm.store import stored

#: MinHash values in each half of a table key.
HALF = 3
#: Chance that a pair at the threshold shares no table.
MISS = 2e-5
#: Times as many pivots in each further round.
GROWTH = 8


def halves(similarity: float) -> int:
    """Keys in each collection, so that a pair at `similarity` misses all its table keys with chance MISS at most."""
    return math.ceil(math.log(MISS / 2) / math.log(1 - similarity ** HALF))


def alike(similarity: float, n_keys: int) -> int:
    """Half keys of all 2 * n_keys that a pair at `similarity` has in common, but for a chance of MISS / 10."""
    chance, tail, n = similarity ** HALF, 0.0, 2 * n_keys
    for k in range(n + 1):
        tail += math.comb(n, k) * chance ** k * (1 - chance) ** (n - k)
        if tail > MISS / 10:
            return k
    return n


def _sketches(batches, n_words: int, n_keys: int):
    """Set size, a 128-bit name of the set, and the two collections of half keys for each row.

    A table key is a pair (left half i, right half j), so n_keys ** 2 tables need 2 * n_keys * HALF MinHash values
    and not n_keys ** 2 * 2 * HALF.
    """
    random = np.random.default_rng(8)
    masks = random.integers(0, 1 << 63, 2 * n_keys * HALF, dtype=np.uint64)
    factors = random.integers(0, 1 << 63, 2 * n_keys * HALF, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in words.portions(batches, "text", words.PORTION // 4):
        hashes, first = words.shingle_sets(batch.column("text"), n_words)
        hashes = words.mix(hashes)
        sizes = np.diff(first)
        full = np.flatnonzero(sizes)
        keys = np.zeros((len(sizes), 2 * n_keys), np.uint64)
        names = np.zeros((len(sizes), 2), np.uint64)
        if len(full):
            at = first[full]
            for k in range(2 * n_keys):
                for j in range(HALF * k, HALF * (k + 1)):
                    lowest = np.minimum.reduceat((hashes ^ masks[j]) * factors[j], at)
                    keys[full, k] += lowest * words.PLACES[j % HALF]
                keys[full, k] = words.mix(keys[full, k] + words.PLACES[8 + k:9 + k])
            names[full, 0] = np.add.reduceat(hashes, at)
            names[full, 1] = np.add.reduceat(words.mix(hashes * words.PLACES[5]), at)
        # One byte of each half key, seven to a word: enough to estimate a similarity.
        prints = np.zeros((len(sizes), -(-2 * n_keys // 7)), np.uint64)
        for k in range(2 * n_keys):
            prints[:, k // 7] |= (keys[:, k] & np.uint64(255)) << np.uint64(8 * (k % 7))
        halves_of = [pa.FixedSizeListArray.from_arrays(pa.array(part.view(np.int64).ravel()), n_keys).cast(
            pa.list_(pa.int64())) for part in (np.ascontiguousarray(keys[:, :n_keys]),
                                               np.ascontiguousarray(keys[:, n_keys:]))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes.astype(np.int64)), *(pa.array(x.view(np.int64)) for x in names.T.copy()),
             *halves_of, *(pa.array(x.view(np.int64)) for x in prints.T.copy())],
            ["doc_id", "text_hash", "n_shingles", "name_1", "name_2", "left", "right", *(f"p{k}" for k in range(prints.shape[1]))])


def _verified(batches, n_words: int, percent: int):
    """The components (a, b) of pairs of texts whose sets meet the similarity."""
    for batch in words.portions(words.portions(batches, "text_a"), "text_b"):
        sets = [words.shingle_sets(batch.column(c), n_words) for c in ("text_a", "text_b")]
        shared = words.shared_counts(*sets)
        union = sum(np.diff(first) for _, first in sets) - shared
        keep = pa.array((shared > 0) & (100 * shared >= percent * union))
        yield batch.select(["component_a", "component_b"]).rename_columns(["a", "b"]).filter(keep)


def _classes(linkable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name_1, name_2, first, doc) for each set, its smallest id and its node; and those whose node is no id.

    A node is the smallest id. Where ids repeat, several sets may have the same one: they get numbers above all ids.
    """
    named = stored(linkable.groupBy("name_1", "name_2").agg(F.min("doc_id").alias("first")), "classes")
    taken = named.groupBy("first").agg(F.count("*").alias("n")).filter("n > 1").select("first")
    clashing = stored(named.join(taken, "first", "left_semi"), "clashing")
    own = named.withColumn("doc", F.col("first"))
    if clashing.isEmpty():
        return own, own.limit(0)
    above = linkable.agg(F.max("doc_id")).first()[0] + 1
    numbered = stored(clashing.withColumn("doc", F.monotonically_increasing_id() + above), "numbered")
    rest = own.join(clashing.select("first").distinct(), "first", "left_anti").select(numbered.columns)
    return stored(rest.unionByName(numbered), "nodes"), numbered


def _shared_nodes(same: DataFrame, numbered: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of one id, and from numbered nodes to the id they stand for."""
    several = same.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).filter("low <> high")
    return (same.join(several.select("a", "low"), "a").filter("b <> low").select("b", "low")
            .union(numbered.select("doc", "first")).toDF("a", "b"))


def _colliding(docs: DataFrame, side: str) -> DataFrame:
    """(doc, half keys) of one collection, only keys that two documents share."""
    exploded = docs.select("doc", F.explode(side).alias("half"))
    shared = stored(exploded.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half"), "halves")
    return exploded.join(shared, "half").groupBy("doc").agg(F.collect_list("half").alias(side))


def _equal_bytes(a: str, b: str) -> str:
    """SQL for the number of equal bytes among the lower seven of two words."""
    low = 0x7F7F7F7F7F7F7F
    return f"bit_count(~((({a} ^ {b}) & {low}) + {low} | ({a} ^ {b}) | {low}) & {low ^ ((1 << 56) - 1)})"


def _renamed(members: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows with their components after components were joined (node, component)."""
    to = joined.select(F.col("node").alias("was"), F.col("component").alias("to"))
    return (members.join(to, members.component == to.was, "left")
            .withColumn("component", F.coalesce("to", "component")).drop("was", "to"))


def _mixed(members: DataFrame, pivots: int) -> DataFrame:
    """Tables that hold untried pairs: more members than the pivots, of several components."""
    return members.groupBy("table").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).filter(
        f"low <> high AND n > {pivots + 1}").select("table")


def _shingle_rows(batches, n_words: int, percent: int):
    """(doc, length of its prefix, hash) for each shingle."""
    for batch in words.portions(batches, "text"):
        hashes, first = words.shingle_sets(batch.column("text"), n_words)
        sizes = np.diff(first)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        prefix = sizes + (-sizes * percent // 100) + 1
        yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(rows)), pa.array(prefix[rows]),
                                          pa.array(hashes.view(np.int64))], ["doc", "prefix", "table"])


def _rare_shingles(texts: DataFrame, sketches: DataFrame, n_words: int, percent: int) -> DataFrame:
    """The sketches with (table, nth): each document's rarest shingles, so that two similar documents share one.

    Of n shingles a similar document must hold percent % at least, so it holds one of any n - that + 1. nth is the place
    among all shingles of the document, in one order for all documents. Shingles that could only be the first common
    one of dissimilar documents are left out: see _first_common.
    """
    all_ = stored(texts.mapInArrow(lambda batches: _shingle_rows(batches, n_words, percent),
                                   "doc long, prefix long, table long"), "shingles")
    counts = all_.groupBy("table").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("doc").orderBy("n", "table")
    rare = (all_.join(counts, "table").withColumn("nth", F.row_number().over(rarest))
            .filter("nth <= prefix AND n > 1").select("table", "doc", "nth").join(sketches, "doc"))
    # The smaller document of a pair bounds what it can share with one of its own size or more.
    early = rare.groupBy("table").agg(F.max(F.expr(_first_common(percent, "nth", "n_shingles", "n_shingles"))).alias(
        "early")).filter("early").select("table")
    return stored(rare.join(early, "table", "left_semi"), "rarest")


def _first_common(percent: int, nth: str, n: str, other_n: str) -> str:
    """SQL: a set of n shingles whose nth is the first in common with a set of other_n can be similar to it.

    They share the nth and later ones at most, and must share percent / (100 + percent) of both sizes together.
    """
    return f"{100 + percent} * (1 + {n} - {nth}) >= {percent} * ({n} + {other_n})"


def near_duplicates(documents: DataFrame, n_words: int = 5, percent: int = 80, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * shared >= percent * union of their distinct n_words shingles; A-Z count as
    lower case and words end at ASCII white space. component_id is the smallest id reachable by links, kept says
    whether it is the document's own.

    - Documents with one and the same set are one class, with the smallest id as its name; only classes are compared.
    - Half keys that no other class has are dropped; tables are the pairs of those that remain.
    - In every table the members are compared with one pivot, which settles most groups of copies.
    - Documents of tables that still hold several components are indexed by their rarest shingles instead, enough of
      them that similar documents share one; a pair counts where this can be the first shingle they share. In these
      tables the members are compared with GROWTH pivots, then with GROWTH times as many in each round, until all
      pairs of a table were compared or have become one component.
    - A pair of a table is a candidate if sizes and the share of equal half keys allow the similarity (a pair that has
      it is missed with chance MISS / 10); every candidate is verified on the full sets of both texts.

    Null or empty text, or one without words: set size 0, no links. A null id: no links, component_id null, kept.
    Rows that share an id are one document in the links, each text of it with its own links; each still gets its row.
    Such ids must stay below 2 ** 62. Other columns are ignored.
    An empty table gives an empty result.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
                             F.xxhash64(F.col(text_column)).alias("text_hash"))
    n_keys = halves(percent / 100)
    prints = [f"p{k}" for k in range(-(-2 * n_keys // 7))]
    rows = stored(texts.mapInArrow(
        lambda batches: _sketches(batches, n_words, n_keys),
        "doc_id long, text_hash long, n_shingles long, name_1 long, name_2 long, left array<long>, right array<long>, "
        + ", ".join(f"{p} long" for p in prints)), "sketches")
    linkable = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes, numbered = _classes(linkable)
    same = stored(linkable.select("doc_id", "name_1", "name_2").join(classes, ["name_1", "name_2"])
                  .select(F.col("doc_id").alias("a"), F.col("doc").alias("b")).distinct(), "same")
    # One row for each set, though its first document may be repeated.
    first = Window.partitionBy("doc_id", "name_1", "name_2").orderBy("text_hash")
    sketches = stored(linkable.join(classes.withColumnRenamed("first", "doc_id"), ["doc_id", "name_1", "name_2"])
                      .withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth"), "sets")

    member = ["doc", "n_shingles", *prints]
    tables = (_colliding(sketches, "left").join(_colliding(sketches, "right"), "doc")
              .select("doc", F.explode("left").alias("left"), "right")
              .select("doc", "left", F.explode("right").alias("right"))
              .select("doc", F.xxhash64("left", "right").alias("table")))
    shared = tables.groupBy("table").agg(F.count("*").alias("n")).filter("n > 1").select("table")
    left = stored(tables.join(shared, "table").join(sketches.select(member), "doc")
                  .withColumn("component", F.col("doc")), "members")
    wanted = sketches.join(left.select("doc").distinct(), "doc", "left_semi").select("doc", "doc_id", "text_hash")
    compared = stored(texts.join(wanted, ["doc_id", "text_hash"]).select("doc", "text").dropDuplicates(["doc"]), "texts")

    # Components that were joined, (node, component) for each time: a later one joins components of earlier ones.
    joins = []
    shared_nodes = stored(_shared_nodes(same, numbered), "shared_nodes")
    if not shared_nodes.isEmpty():
        joins.append(stars(shared_nodes))
        left = _renamed(left, joins[-1])

    matches = " + ".join(_equal_bytes(p, f"pivot_{p}") for p in prints)
    # Bytes that no half key fills are equal in every pair.
    matches = f"{matches} - {7 * len(prints) - 2 * n_keys} >= {alike(percent / 100, n_keys)}"
    sizes = f"100 * least(n_shingles, pivot_n_shingles) >= {percent} * greatest(n_shingles, pivot_n_shingles)"
    near = (F.col("component") != F.col("pivot_component")) & F.expr(sizes) & F.expr(matches)
    by_table = Window.partitionBy("table").orderBy("doc")
    tried, before, pivots, exact = None, 0, 1, False
    while True:
        chosen = stored(left.withColumn("turn", F.row_number().over(by_table))
                        .filter((F.col("turn") <= pivots) & (F.col("turn") > before))
                        .select(*(F.col(c).alias(f"pivot_{c}") for c in left.columns)), "pivots")
        meet = (F.col("table") == F.col("pivot_table")) & (F.col("doc") > F.col("pivot_doc")) & near
        if exact:
            meet &= (F.expr(_first_common(percent, "nth", "n_shingles", "pivot_n_shingles"))
                     & F.expr(_first_common(percent, "pivot_nth", "pivot_n_shingles", "n_shingles")))
        pairs = left.join(chosen, meet).select(
            F.col("doc").alias("a"), F.col("pivot_doc").alias("b"), F.col("component").alias("component_a"),
            F.col("pivot_component").alias("component_b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs.select("a", "b") if tried is None else tried.union(pairs.select("a", "b"))
        found = stored(pairs.join(compared.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
                       .join(compared.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
                       .select("component_a", "component_b", "text_a", "text_b")
                       .mapInArrow(lambda batches: _verified(batches, n_words, percent), "a long, b long")
                       .distinct(), "edges")
        if not found.isEmpty():
            joins.append(stars(found))
            left = _renamed(left, joins[-1])
        mixed = stored(_mixed(left, pivots), "mixed")
        if mixed.isEmpty():
            break
        left = left.join(mixed, "table")
        if exact:
            left, before, pivots = stored(left, "open"), pivots, pivots * GROWTH
        else:
            exact, pivots = True, GROWTH
            left = stored(left.select(*member, "component").distinct(), "open")
            left = _rare_shingles(compared.join(left.select("doc"), "doc", "left_semi"), left, n_words, percent)
    labels = same.filter("a <> b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    for joined in joins:
        labels = _renamed(labels, joined).union(joined)
    labels = stored(labels.groupBy("node").agg(F.min("component").alias("component")), "components")
    named = rows.join(labels, rows.doc_id == labels.node, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias(
            "component_id"))
    return named.withColumn("kept", F.expr("doc_id <=> component_id"))
