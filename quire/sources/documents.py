"""JSON sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; files split across tasks."""
    return spark.read.schema(schema).json(path)


def read_json_docs(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.json") -> DataFrame:
    """A folder of JSON files, each one document or one array of documents (an element becomes a row).

    ``doc_key`` is the file name without its ending; an empty folder gives no rows.
    """
    docs = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", pattern).json(folder)
    file_name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return docs.select("*", F.regexp_replace(file_name, r"\.[^.]*$", "").alias("doc_key"))
