"""Delimited, Parquet and graph-export sinks."""

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.sources.tables import CSV_OPTIONS


def write_table(df: DataFrame, path: str, header: bool = True, sep: str = ";", mode: str = "errorifexists") -> None:
    """Write a delimited table that `read_table` gives back unchanged (outer blanks and empty strings included)."""
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**CSV_OPTIONS, **keep_blanks, sep=sep, header=header).csv(path)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    """Write Parquet; pass ``compression="none"`` for plain pages."""
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def committed(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """Folder and version of the table that `materialize` committed to ``path``; None and 0 where there is none yet.

    The highest version counts, and of several writers of it the one that committed first.
    """
    commits = f"{path}/commit-*"
    try:
        commit = (spark.read.schema("attempt string, version long").json(commits).filter("attempt IS NOT NULL")
                  .select("attempt", "version", F.col("_metadata.file_modification_time").alias("at"))
                  .orderBy(F.desc("version"), "at", "attempt").first())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        commit = None
    return (None, 0) if commit is None else (f"{path}/data-{commit.attempt}", commit.version)


def materialize(spark: SparkSession, make: Callable[[], DataFrame], path: str, overwrite: bool = False) -> DataFrame:
    """Write the table ``make`` builds unless a finished one is already there, and read it back.

    Every writer has a data folder of its own below ``path``. A finished one is committed by a record beside it, a file
    that appears as a whole. A writer that dies leaves no record and is ignored; several writers at a time all read the
    table that was committed first. ``overwrite`` commits a new version. Nothing is replaced or removed, so tables that
    are being read stay whole; data folders that `committed` does not name may be deleted once no job uses them.
    """
    folder, version = committed(spark, path)
    if folder is None or overwrite:
        attempt = uuid.uuid4().hex
        write_parquet(make(), f"{path}/data-{attempt}")
        record = spark.range(1).select(F.lit(attempt).alias("attempt"), F.lit(version + 1).alias("version"))
        record.coalesce(1).write.json(f"{path}/commit-{attempt}")
        folder, _ = committed(spark, path)
    return spark.read.parquet(folder)


_HEADER_TYPES = {
    T.ByteType: "byte", T.ShortType: "short", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float",
    T.DoubleType: "double", T.BooleanType: "boolean", T.DateType: "date", T.TimestampType: "datetime",
    T.TimestampNTZType: "localdatetime", T.StringType: "string",
}


def _header_token(field: T.StructField) -> str:
    """Name and type; types that the header has no word for (decimals, binary) are written as strings."""
    if field.name in ("id", "start_id", "end_id"):
        return ":" + field.name.upper()
    if isinstance(field.dataType, T.ArrayType):
        return f"{field.name}:{_HEADER_TYPES.get(type(field.dataType.elementType), 'string')}[]"
    return f"{field.name}:{_HEADER_TYPES.get(type(field.dataType), 'string')}"


def flatten_arrays(df: DataFrame, array_sep: str = "|") -> DataFrame:
    """Arrays joined into one text field; other columns as they are.

    A null array stays null. Inside a field ``\\e`` is an array without elements, ``\\n`` a null element, ``\\p`` the
    separator and ``\\b`` a backslash; elements without these characters are written as they are.
    """
    def flat(column):
        escaped = F.transform(column.cast("array<string>"), lambda x: F.coalesce(F.replace(
            F.replace(x, F.lit("\\"), F.lit("\\b")), F.lit(array_sep), F.lit("\\p")), F.lit("\\n")))
        return F.when(F.size(column) == 0, F.lit("\\e")).otherwise(F.array_join(escaped, array_sep))
    arrays = {f.name: flat(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    return df.withColumns(arrays) if arrays else df


def export_graph(spark: SparkSession, nodes: dict[str, DataFrame], edges: dict[str, DataFrame], path: str,
                 sep: str = ";", array_sep: str = "|", mode: str = "errorifexists") -> DataFrame:
    """Write bulk-loader input: per node label and edge type a headerless data folder and a one-row header.

    Returns the manifest (kind, label, header, data) that is also written next to the files.
    """
    manifest = []
    for kind, tables in (("nodes", nodes), ("edges", edges)):
        for label, df in tables.items():
            name = label.replace(":", "_").lower()
            data, header = f"{path}/{kind}/{name}", f"{path}/{kind}/{name}_header"
            write_table(flatten_arrays(df, array_sep), data, header=False, sep=sep, mode=mode)
            line = sep.join(_header_token(field) for field in df.schema)
            spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode(mode).text(header)
            manifest.append((kind, label, header, data))
    listing = spark.createDataFrame(manifest, "kind string, label string, header string, data string")
    listing.coalesce(1).write.mode(mode).json(f"{path}/manifest")
    return listing
