"""DuckDB SQL that must give the rows of the queries, written from their definitions."""

from __future__ import annotations


def secret_scan() -> str:
    keywords = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                "[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])")
    kinds = [  # kind, pattern, group that is measured, shortest length, base kind
        ("assign", keywords + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
        ("access", "AKIA[A-Z0-9]+", 0, 20, True),
        ("hex", "[0-9a-f]+", 0, 24, True),
        ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, False),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, False),
        ("code_host", "gh[oprsu]_[A-Za-z0-9]{36,}", 0, 1, False),
        ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, False),
        ("url_password", r"://[^/\s:@]{1,64}:[^/\s:@]{1,64}@", 0, 1, False),
    ]
    parts = "\nUNION ALL ".join(
        f"SELECT doc_id, {no} AS no, '{kind}' AS kind, {str(base).lower()} AS base, {least} AS least,"
        f" regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {group}) AS part,"
        f" string_split_regex(text, '{pattern}') AS gaps FROM docs"
        for no, (kind, pattern, group, least, base) in enumerate(kinds))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({parts}),
each AS (
  SELECT doc_id, no, kind, base, least, i, whole[i] AS w, part[i] AS p,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM found)),
spans AS (
  SELECT doc_id, no, kind, base, s, kind || ':' || s::BIGINT || ':' || (s + length(w))::BIGINT AS span
  FROM each WHERE length(p) >= least),
summed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY s, no) FILTER (base) AS base,
         string_agg(span, ',' ORDER BY s, no) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN summed USING (doc_id)"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def contained_items() -> str:
    def words(table, key):
        return f"""
  SELECT {key}, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
                                   '[^\\x20\\x09-\\x0D!-/:-@\\[-`{{-~]+') AS w
  FROM {table} WHERE text IS NOT NULL"""

    def sets(rows, key):
        return f"""
  SELECT DISTINCT {key}, size, array_to_string(w[i:i + size - 1], ' ') AS shingle
  FROM (SELECT {key}, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM {rows} WHERE len(w) >= size)"""
    return f"""
WITH doc_words AS ({words("documents", "doc_id")}),
item_words AS (SELECT *, least(len(w), 5) AS size FROM ({words("benchmark", "item_id")}) WHERE len(w) > 0),
doc_sets AS ({sets("(SELECT * FROM doc_words, (SELECT DISTINCT size FROM item_words))", "doc_id")}),
item_sets AS ({sets("item_words", "item_id")}),
sizes AS (SELECT item_id, count(*) AS n FROM item_sets GROUP BY item_id)
SELECT doc_id, item_id, any_value(n) AS n_item_shingles, count(*) AS n_shared
FROM doc_sets JOIN item_sets USING (size, shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n)"""


def nearest() -> str:
    return """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
        FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0))
WHERE rank <= 5"""


def url_filter() -> str:
    listed = [("example.org/en/1", "block"), ("example.org/es/", "block"), ("com/de/", "block"),
              ("com/fr/", "allow"), ("org/", "allow")]
    spam = ("casino-win", "cheap-pills", "adserver", "free-money", "hot-singles", "online-casino", "payday-loan",
            "replica-watches", "viagra", "warez")
    fits = [(f"regexp_matches(host || path, '^([^/]*\\.)?{site.replace('.', chr(92) + '.')}')", site, verdict)
            for site, verdict in listed]
    rule = "CASE " + " ".join(f"WHEN {fit} THEN '{site}'" for fit, site, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fit} THEN '{verdict}'" for fit, _, verdict in fits)
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT page_id, host, path, {rule} AS rule,
       {verdict} WHEN regexp_matches(low, '(^|[^a-z0-9])({"|".join(spam)})([^a-z0-9]|$)') THEN 'block'
       ELSE 'allow' END AS verdict
FROM parts"""


#: CRC-32 of a list of byte values, with the 256 steps of a byte in the list t of a table named steps.
_STEPS = """steps AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)"""


def _crc(codes: str) -> str:
    return (f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), "
            "4294967295)")


def merkle_manifest(levels: int = 7, top_levels: int = 3) -> str:
    """For up to 8 ** levels documents of a language and 8 ** top_levels languages."""
    def leaf(text):
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(
            f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"

    def climb(name, source, tree, n_levels):
        """Tables name_0, name_1, ... of all nodes (tree, no, n, h), and of what each document's claim folds to."""
        parts = [f"{name}_0 AS ({source})"]
        for k in range(1, n_levels + 1):
            parts.append(f"""{name}_{k} AS (
  SELECT {tree}, no // 8 AS no, (n + 7) // 8 AS n, sha256(string_agg(h, '' ORDER BY no)) AS h
  FROM {name}_{k - 1} WHERE n > 1 GROUP BY {tree}, no // 8, n)""")
        return parts

    def fold(name, start, nodes, tree, n_levels):
        parts = [f"{name}_0 AS ({start})"]
        for k in range(n_levels):
            parts.append(f"""{name}_{k + 1} AS (
  SELECT f.doc_id, f.tree, f.at // 8 AS at,
         coalesce(sha256(string_agg(CASE WHEN s.no = f.at THEN f.folded ELSE s.h END, '' ORDER BY s.no)
                         FILTER (s.h IS NOT NULL)), any_value(f.folded)) AS folded,
         any_value(f.proof) || coalesce(string_agg(s.h, '' ORDER BY s.no) FILTER (s.no <> f.at), '') AS proof
  FROM {name}_{k} f LEFT JOIN {nodes}_{k} s ON s.{tree} = f.tree AND s.n > 1 AND s.no // 8 = f.at // 8
  GROUP BY f.doc_id, f.tree, f.at)""")
        return parts

    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)"
    every = ", ".join
    subroots = " UNION ALL ".join(f"SELECT tree, h FROM low_{k} WHERE n = 1" for k in range(levels + 1))
    roots = " UNION ALL ".join(f"SELECT h FROM top_{k} WHERE n = 1" for k in range(top_levels + 1))
    return "WITH " + every([
        _STEPS,
        f"""docs AS (SELECT doc_id, coalesce('1' || lang, '0') AS tree, {leaf("text")} AS leaf,
  CASE WHEN {_crc(codes)} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS claim FROM documents, steps)""",
        *climb("low", """SELECT tree, doc_id, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS no,
  count(*) OVER (PARTITION BY tree) AS n, leaf AS h FROM docs""", "tree", levels),
        f"subroot AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS no, count(*) OVER () AS n FROM ({subroots}))",
        *climb("top", "SELECT '' AS root, no, n, h FROM subroot", "root", top_levels),
        *fold("up", "SELECT doc_id, d.tree, no AS at, claim AS folded, '' AS proof FROM docs d JOIN low_0 USING (doc_id)",
              "low", "tree", levels),
        *fold("over", f"SELECT u.doc_id, '' AS tree, s.no AS at, folded, proof FROM up_{levels} u JOIN subroot s USING (tree)",
              "top", "root", top_levels),
    ]) + f"""
SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root,
       o.folded = r.h AS verified
FROM docs d JOIN subroot s USING (tree) JOIN over_{top_levels} o USING (doc_id) CROSS JOIN ({roots}) r"""


def importance_resampling() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    codes = ("list_transform(range(1, strlen(feature) + 1), lambda i: "
             "('0x' || substr(hex(feature), 2 * i - 1, 2))::BIGINT)")

    def runs(table, key):
        return " UNION ALL ".join(
            f"SELECT {key}, unnest(list_transform(range(1, len(w) + 2 - {n}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')))"
            f" AS feature FROM {table}" for n in (1, 2, 3))

    def words(table, key):
        return f"""SELECT {key}, regexp_extract_all(coalesce(translate(text, '{UPPER}', '{LOWER}'), ''), '{word}') AS w
  FROM {table}"""

    return f"""WITH {_STEPS},
docs AS ({words("documents", "doc_id")}),
items AS ({words("benchmark", "item_id")}),
of_docs AS (SELECT doc_id, feature, count(*) AS k FROM ({runs("docs", "doc_id")}) GROUP BY ALL),
of_items AS (SELECT feature, count(*) AS k FROM ({runs("items", "item_id")}) GROUP BY ALL),
buckets AS (SELECT feature, {_crc(codes)} % 10000 AS bucket
  FROM (SELECT feature FROM of_docs UNION SELECT feature FROM of_items), steps),
source AS (SELECT bucket, sum(k) AS s FROM of_docs JOIN buckets USING (feature) GROUP BY bucket),
target AS (SELECT bucket, sum(k) AS t FROM of_items JOIN buckets USING (feature) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM source)::DOUBLE AS s_all,
                  (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE AS t_all),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000)
                                        / ((s::DOUBLE + 1) * (t_all + 10000)))) AS g
  FROM source LEFT JOIN target USING (bucket), totals),
weights AS (SELECT doc_id, sum(k)::BIGINT AS n_features, sum(k * g)::BIGINT AS weight
  FROM of_docs JOIN buckets USING (feature) JOIN gain USING (bucket) GROUP BY doc_id),
noise AS (SELECT doc_id, len(w) AS n_words,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS g
  FROM docs),
scored AS (SELECT doc_id, n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + g)::BIGINT AS score FROM noise LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)"""
