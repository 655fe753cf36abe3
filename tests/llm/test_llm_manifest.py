"""The Merkle manifest against a plain tree."""

import hashlib

from pyspark.sql import functions as F

from quire.llm import manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(hashes):
    """All levels of one tree."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain(rows):
    """(doc_id, leaf, subroot, root, joined siblings) of every row, sorted."""
    trees = {}
    for row in rows:
        key = b"0" if row[2] is None else b"1" + row[2].encode()
        trees.setdefault(key, []).append((row[0] is not None, row[0] or 0, h(*map(field, row))))
    order = sorted(trees)
    built = {key: climb([leaf for *_, leaf in sorted(trees[key])]) for key in order}
    top = climb([built[key][-1][0] for key in order])
    made = []
    for no, key in enumerate(order):
        for at, (known, doc_id, leaf) in enumerate(sorted(trees[key])):
            proof = []
            for levels, place in ((built[key], at), (top, no)):
                for level in levels[:-1]:
                    first = place // 8 * 8
                    proof += [x for i, x in enumerate(level[first:first + 8], first) if i != place]
                    place //= 8
            made.append((doc_id if known else None, leaf, built[key][-1][0], top[-1][0], "".join(proof)))
    return sorted(made, key=repr)


def audited(spark, rows, where="false"):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumns({name: F.lit("clash") for name in ("row", "tree", "leaf", "no", "n", "a.b", "claim")})
    return manifest.audited(docs, COLUMNS, "lang", "doc_id", F.expr(where), {"text": F.lower("text")}).collect()


def compare(spark, rows):
    found = audited(spark, rows)
    assert all(r.verified and r.folded_root == r.root for r in found)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof.hex()) for r in found), key=repr) == plain(rows)


def test_trees_of_all_shapes(spark):
    rows = [(i, "s", "big", 4, f"Text {i}") for i in range(585)]
    rows += [(i, None, "eight", i, "x") for i in range(8)] + [(i, "é", "nine", None, None) for i in range(9)]
    rows += [(7, "s", "lone", 1, ""), (None, None, None, None, None), (3, "s", None, 1, "a"), (3, "s", None, 1, "a"),
             (None, "s", "big", 1, "no id")]
    rows += [(i, "s", f"l{i}", 1, "many trees") for i in range(70)]
    compare(spark, rows)


def test_more_than_one_block(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 2)
    compare(spark, [(i, "s", "big" if i % 5 else None, i, "x" * (i % 7)) for i in range(700)])


def test_single_and_empty(spark):
    compare(spark, [(1, "a", "en", 2, "b")])
    compare(spark, [(1, "a", "en", 2, "b"), (2, "a", "en", 2, "b")])
    assert audited(spark, []) == []


def test_a_changed_row_does_not_verify(spark):
    rows = [(i, "s", "en", 1, "Upper" if i % 2 else "lower") for i in range(100)]
    for r in audited(spark, rows, "doc_id < 50"):
        assert r.verified == (r.doc_id >= 50 or r.doc_id % 2 == 0)
        assert (r.folded_root == r.root) == r.verified


def test_more_rows_than_the_recursion_limit(spark):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    try:
        compare(spark, [(i, "s", "en", 1, f"t{i}") for i in range(100)])
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
