"""Compare registered queries with their SQL: python -m checks.compare FOLDER [NAME ...]"""

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE"}


def local_session(cores: str = "8") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own settings."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("quire")
             .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    """What differs in names, types, row count or values; empty when all agree."""
    names = sorted(df.columns)
    described = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != names:
        return [f"columns {names} against {sorted(described)}"]
    found = [f"type of {name}: {kind} against {described[name]}" for name, kind in df.dtypes
             if KINDS.get(kind) != described[name]]
    quoted = ", ".join(f'"{name}"' for name in names)
    left = sorted(repr(tuple(row)) for row in df.select(*[f"`{name}`" for name in names]).collect())
    right = sorted(repr(row) for row in connection.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if len(left) != len(right):
        found.append(f"rows: {len(left)} against {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0][0][:300]} against {wrong[0][1][:300]}")
    if not left:
        found.append("no rows")
    return found


def main(folder: str, names: list[str]) -> int:
    from checks import ORACLES, QUERIES
    spark, connection, failed = local_session(), connect(folder), 0
    for name in names or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, folder)
        if name in ORACLES:
            found = differences(df, connection, ORACLES[name])
        else:
            found = [] if df.count() else ["no rows"]
        failed += bool(found)
        print(f"{name:36s} {'ok' if not found else found} {time.time() - start:.2f}s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
