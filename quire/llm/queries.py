"""The operators as queries on the driver tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.llm import languages, licenses, manifest, packing, pieces, quality, resampling, secret_scan, sql, url_rules
from quire.llm.decontamination import contained_items
from quire.llm.near_duplicates import near_duplicates
from quire.llm.neighbours import nearest
from quire.llm.repeats import remove_repeats
from quire.llm.store import ship, stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_block_matrix_neighbours(spark, folder):
    """The five nearest rows, by cosine, of every row whose id is divisible by 50."""
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


#: The listed rules of the query.
LISTED = [url_rules.Rule(f"||{site}", verdict) for site, verdict in (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
    ("com/de/", "block"))]


def op2_url_filter(spark, folder):
    """Verdict for every page's url: by the listed rules, else by the rules for spam words."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_rules.judged(pages, [*LISTED, *url_rules.SPAM])
    return judged.select("page_id", "host", "path", "verdict",
                         F.when(F.startswith("rule", F.lit("||")), F.substr("rule", F.lit(3))).alias("rule"))


def held_out():
    """Whether a document's label must not be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_model(spark, docs, folder):
    """Trained on the labels of documents that are not held out."""
    return quality.fit(docs.filter(~held_out()), table(spark, folder, "labels").filter(~held_out()))


def op3_quality_classifier(spark, folder):
    """Quality score of every whole text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, docs, folder), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_benchmark_decontamination(spark, folder):
    """Benchmark items of which a document holds four fifths or more of the 5-word shingles."""
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_language_id(spark, folder):
    """Language of every whole text, learned from documents that are not held out."""
    docs = table(spark, folder, "documents")
    model = languages.fit(docs.filter(~held_out()))
    found = languages.identify(docs.select("doc_id", "text"), model, keep=["doc_id"], with_spans=False)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_sentencepiece(spark, folder):
    """Piece ids of every whole text, and whether they decode to the text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode(docs, keep=["doc_id"], check="exact").select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "exact")


def op7_license_scan(spark, folder):
    """Stretches of documents that hold four fifths or more of a license notice."""
    return licenses.find_licenses(table(spark, folder, "documents"), licenses.default_templates(spark))


def op8_minhash_near_dedup(spark, folder):
    """Links at 85 % of distinct 3-word shingles, over all documents."""
    return near_duplicates(table(spark, folder, "documents"), n_words=3, percent=85)


def op9_suffix_array_dedup(spark, folder):
    """Bytes in 200-byte strings that also start elsewhere are removed, over all documents."""
    return remove_repeats(table(spark, folder, "documents"), 200).drop("kept")


def op10_secret_scan(spark, folder):
    """Secrets of every document; a text is scanned once by each rule and its findings go to all documents with it.

    The ledger grows in two steps: half of the documents arrive when only the base rules exist; then all documents are
    there with all rules, and what is scanned are new texts, and known ones by new rules only.
    """
    docs = table(spark, folder, "documents").select("doc_id", "text")
    early = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    first = stored(secret_scan.scan(early, secret_scan.RULES[:len(secret_scan.BASE)]), "ledger")
    ledger = first.union(stored(secret_scan.scan(docs, ledger=first), "ledger"))

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.BASE]
    return secret_scan.findings(docs, ledger).select("doc_id", *counts, F.sha2(joined(of(*secret_scan.BASE)), 256).alias("base_sha256"),
                                                 joined(F.col("spans")).alias("spans"))


def op11_merkle_manifest(spark, folder):
    """Every document as a leaf of a tree per language: its proof, and the root that its row leads to where an intruder
    lower-cased some of the texts."""
    docs = table(spark, folder, "documents")
    found = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", sql.UPPER, sql.LOWER)
    made = manifest.audited(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", found, {"text": lowered})
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(
        manifest.hex_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


def op12_importance_resampling(spark, folder):
    """Weight, score and rank of every document; a twentieth of the longer ones is drawn towards the benchmark."""
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_best_fit_packing(spark, folder):
    """Every piece of every document with its place in sequences of 2,048 tokens."""
    import public_tokenizers
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.packed(packing.tokenized(docs, public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {name: make for name, make in list(globals().items()) if name.startswith("op")}
ORACLES: dict[str, str] = {
    "op1_block_matrix_neighbours": sql.nearest(),
    "op2_url_filter": sql.url_filter(),
    "op4_benchmark_decontamination": sql.contained_items(),
    "op10_secret_scan": sql.secret_scan(),
    "op11_merkle_manifest": sql.merkle_manifest(),
    "op12_importance_resampling": sql.importance_resampling(),
}
