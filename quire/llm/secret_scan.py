"""Secrets in versioned text: every distinct content is scanned once per rule version, findings go to all its paths.

Only DataFrame functions: content is addressed by its SHA-256, the ledger lists which rule versions have seen it, and
findings are joined back to the rows that hold the content.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.llm.store import stored


class Rule(NamedTuple):
    """Leftmost, non-overlapping matches of a pattern; those whose group is shorter than `least` do not count."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    #: Every match holds one of these literals (none: look at all text).
    literals: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(_either_case(w).replace("_", "_?") for w in ("password", "passwd", "secret", "token", "api_key"))

#: The patterns of the three base kinds, then further well-known formats.
RULES = (
    Rule("assign", rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, (":", "=")),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, ("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", literals=("PRIVATE KEY-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", literals=("eyJ",)),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}", literals=("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", literals=("xox",)),
    Rule("url_password", r"://[^/\s:@]{1,64}:[^/\s:@]{1,64}@", literals=("://",)),
)
BASE = ("assign", "access", "hex")

SPANS = "array<struct<start: long, kind_no: int, kind: string, end: long>>"
LEDGER = f"blob string, versions array<string>, spans {SPANS}"


def blob(text: Column) -> Column:
    """The address of a content; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan(documents: DataFrame, rules=RULES, ledger: DataFrame | None = None, text_column: str = "text") -> DataFrame:
    """New ledger rows (blob, versions, spans): one for each distinct content with rule versions it has not seen yet.

    Append them to the ledger and pass it to the next call, which then scans new content by all rules and known
    content by new or changed rules only. spans are sorted by start, then rule order; positions are code points.
    """
    contents = documents.select(F.coalesce(text_column, F.lit("")).alias("text"))
    blobs = contents.withColumn("blob", blob(F.col("text"))).dropDuplicates(["blob"])
    if ledger is None:
        blobs = blobs.withColumn("done", F.array().cast("array<string>"))
    else:
        done = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("versions"))).alias("done"))
        versions = F.array(*[F.lit(rule.version) for rule in rules])
        blobs = (blobs.join(done, "blob", "left")
                 .withColumn("done", F.coalesce("done", F.array().cast("array<string>")))
                 .filter(F.size(F.array_except(versions, "done")) > 0))
    for no, rule in enumerate(rules):
        wanted = ~F.array_contains("done", rule.version)
        if rule.literals:
            holds = F.lit(False)
            for literal in rule.literals:
                holds = holds | F.contains("text", F.lit(literal))
            wanted = wanted & holds
        blobs = blobs.withColumn(f"found_{no}", F.when(wanted, F.regexp_extract_all(
            "text", F.lit(rule.pattern), F.lit(rule.group))))
    pieces = []
    for no, rule in enumerate(rules):
        # Text between the matches and the matches alternate; their lengths give the positions.
        whole = F.col(f"found_{no}") if rule.group == 0 else F.regexp_extract_all(
            "text", F.lit(rule.pattern), F.lit(0))
        pieces.append(F.when(F.size(f"found_{no}") > 0, F.zip_with(
            F.zip_with(whole, F.col(f"found_{no}"), lambda m, v: F.struct(
                F.length(m).alias("size"), (F.length(v) >= rule.least).alias("good"))),
            F.split("text", rule.pattern, -1),
            lambda m, gap: F.struct(F.lit(no).alias("kind_no"), m["size"].alias("size"), m["good"].alias("good"),
                                    F.length(gap).alias("gap")))))
    none = F.array().cast("array<struct<kind_no: int, size: int, good: boolean, gap: int>>")
    parts = blobs.select("blob", "done", F.concat(*[F.coalesce(p, none) for p in pieces]).alias("parts"))
    order = Window.partitionBy("blob", "kind_no").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    placed = (parts.select("blob", "done", F.posexplode_outer("parts").alias("place", "part"))
              .select("blob", "done", "place", "part.*")
              .withColumn("end", F.sum(F.coalesce("size", F.lit(0)) + F.coalesce("gap", F.lit(0))).over(order)))
    span = F.when(F.col("good"), F.struct(
        (F.col("end") - F.col("size")).alias("start"), "kind_no",
        F.get(kinds, F.col("kind_no")).alias("kind"), F.col("end").cast("long").alias("end")))
    versions = F.array(*[F.lit(rule.version) for rule in rules])
    return placed.groupBy("blob").agg(F.first("done").alias("done"), F.array_sort(F.collect_list(span)).alias("spans")
                                      ).select("blob", F.array_except(versions, "done").alias("versions"),
                                               F.col("spans").cast(SPANS).alias("spans"))


def findings(documents: DataFrame, ledger: DataFrame, rules=RULES, text_column: str = "text") -> DataFrame:
    """All rows of `documents` with `spans` from the ledger by the present rule versions (empty where there are none).

    Content with findings is written first and then joined on its address, so that Spark may split the rows of a content
    with many paths, also of an empty one. A column of `documents` that is called spans is replaced.
    """
    present = F.array(*[F.struct(F.lit(rule.version).alias("v"), F.lit(rule.kind).alias("k")) for rule in rules])
    known = (ledger.filter(F.size("spans") > 0)
             .select(F.col("blob").alias("_blob"), "spans",
                     F.explode(present).alias("_rule"), "versions")
             .filter("array_contains(versions, _rule.v)")
             .select("_blob", F.expr("filter(spans, s -> s.kind = _rule.k)").alias("_spans"))
             .groupBy("_blob").agg(F.array_sort(F.flatten(F.collect_list("_spans"))).alias("spans")))
    known = stored(known, "known")
    return (documents.drop("spans").withColumn("_blob", blob(F.col(text_column))).join(known, "_blob", "left")
            .withColumn("spans", F.coalesce("spans", F.array().cast(SPANS))).drop("_blob"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by a mark; spans that touch or overlap become one mark."""
    merged = F.aggregate(spans, F.array().cast("array<struct<start: long, end: long>>"), lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"),
            F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))).otherwise(
        F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    cut = F.transform(merged, lambda s, i: F.substr(
        text, F.coalesce(F.get(merged, i - 1)["end"], F.lit(0)).cast("int") + 1,
        (s["start"] - F.coalesce(F.get(merged, i - 1)["end"], F.lit(0))).cast("int")))
    rest = F.substr(text, F.element_at(merged, -1)["end"].cast("int") + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(cut, mark), F.lit(mark), rest)).otherwise(text)
