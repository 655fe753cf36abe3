"""From raw documents to token ids in five stages; every stage is written before the next one reads it.

Each stage takes what its predecessor kept and returns rows with the columns of `documents`, the last one token ids.
Rows of one id and text count as one document and one of them stays; rows without an id are never near copies. Further
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.llm import pieces, quality, secret_scan
from quire.llm.decontamination import contained_items
from quire.llm.near_duplicates import near_duplicates
from quire.llm.queries import quality_model, table
from quire.llm.store import ship, stored

#: SQL cannot express the classifier and the token ids; tests hold the stages against brute-force versions.
ORACLE_SQL = None
#: Documents of a lower quality score go.
LEAST_QUALITY = 0.3


def _columns(docs: DataFrame) -> list[Column]:
    """All columns, whatever their names."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in docs.columns]


def _unused(docs: DataFrame, name: str) -> str:
    """The name, made longer until no column has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of documents that are not held out."""
    ship(spark)
    weights = quality_model(spark, docs, sf_dir)
    whole = F.struct(*[column for column, name in zip(_columns(docs), docs.columns) if name != "text"]).alias("document")
    scored = quality.score(docs.select(whole, "text"), weights, keep=["document", "text"], into="score")
    return scored.filter(F.col("score") >= LEAST_QUALITY).select(*[
        F.col("text") if name == "text" else F.col("document").getField(name).alias(name) for name in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id."""
    ship(spark)
    kept = near_duplicates(docs).filter("kept").select("doc_id").distinct()
    return (docs.join(kept, docs.doc_id.eqNullSafe(kept.doc_id), "left_semi").dropDuplicates(["doc_id", "text"])
            .select(*_columns(docs)))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths or more of a benchmark item go."""
    ship(spark)
    row, name = F.xxhash64("doc_id", "text"), _unused(docs, "row")
    tainted = contained_items(docs.select(row.alias("row"), "text"), table(spark, sf_dir, "benchmark"),
                              id_column="row").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(tainted, row == F.col(name), "left_anti").select(*_columns(docs))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and n_chars counts the new text."""
    ledger = stored(secret_scan.scan(docs), "ledger")
    whole = F.struct(*_columns(docs)).alias("document")
    found = secret_scan.findings(docs.select(whole, "text"), ledger)
    clean = found.select("document", secret_scan.redacted(F.col("text"), F.col("spans")).alias("clean"))
    return clean.select(*[F.col("clean").alias("text") if c == "text" else F.length("clean").cast("long").alias(c)
                          if c == "n_chars" else F.col("document").getField(c).alias(c) for c in docs.columns])


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    ship(spark)
    return pieces.encode(docs.select("doc_id", "text"), keep=["doc_id"], check="exact").select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "exact")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_redaction", secret_redaction),
    ("sentencepiece_encoding", sentencepiece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
