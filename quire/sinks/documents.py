"""JSON sinks. Null struct fields are left out of the output; the input is not changed for that."""

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line."""
    df.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_documents(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Documents as a folder of JSON Lines files, the form document stores load in parallel."""
    write_jsonl(df, path, mode)
