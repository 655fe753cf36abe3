"""Delimited and Parquet sources."""

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.columns import conform

# Quotes inside a quoted field are doubled, not escaped by a backslash.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ";",
               header: bool = True, multi_line: bool = False) -> DataFrame:
    """Read a delimited table; without a schema the types are inferred (for exploration only).

    Large files are read by many tasks. Only values with line breaks need ``multi_line``, which gives each file to
    one task.
    """
    # A bare empty field is null; a quoted one stays an empty string as long as the null marker is not empty too.
    reader = spark.read.options(**CSV_OPTIONS, sep=sep, header=header, multiLine=multi_line, nullValue="\0")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


_TOKEN_TYPES = {
    "ID": T.LongType(), "START_ID": T.LongType(), "END_ID": T.LongType(), "int": T.IntegerType(),
    "long": T.LongType(), "byte": T.ByteType(), "short": T.ShortType(), "float": T.FloatType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "datetime": T.TimestampType(),
    "localdatetime": T.TimestampNTZType(),
}


def parse_header_tokens(tokens: list[str]) -> T.StructType:
    """Schema of a sidecar header: ``name:type`` tokens. The first one is the id, unless it starts or ends an edge."""
    fields = []
    for position, token in enumerate(tokens):
        name, _, kind = token.partition(":")
        name = {"START_ID": "start_id", "END_ID": "end_id"}.get(kind, name)
        if position == 0 and kind not in ("START_ID", "END_ID"):
            name, kind = "id", "ID"
        base = _TOKEN_TYPES.get(kind.removesuffix("[]"), T.StringType())
        fields.append(T.StructField(name, T.ArrayType(base) if kind.endswith("[]") else base))
    return T.StructType(fields)


def _elements(text: Column, array_sep: str) -> Column:
    """The array behind a field that `quire.sinks.tables.flatten_arrays` wrote."""
    plain = F.transform(F.split(text, f"\\Q{array_sep}\\E"), lambda x: F.when(x != "\\n", F.replace(
        F.replace(x, F.lit("\\p"), F.lit(array_sep)), F.lit("\\b"), F.lit("\\"))))
    return F.when(text == "\\e", F.array().cast("array<string>")).otherwise(plain)


def read_with_header_file(spark: SparkSession, data: str, header: str, sep: str = ";",
                          array_sep: str = "|", multi_line: bool = False) -> DataFrame:
    """Read headerless data whose names and types stand in a one-row sidecar file."""
    line = spark.read.text(header).first()
    schema = parse_header_tokens(next(csv.reader([line.value], delimiter=sep)))
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = read_table(spark, data, as_text, sep, header=False, multi_line=multi_line)
    split_arrays = {f.name: _elements(F.col(f"`{f.name}`"), array_sep)
                    for f in schema if isinstance(f.dataType, T.ArrayType)}
    return conform(raw.withColumns(split_arrays) if split_arrays else raw, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
