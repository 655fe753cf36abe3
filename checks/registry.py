"""Registered queries and the SQL that must give the same rows."""

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its own name."""
    def register(make):
        QUERIES[make.__name__] = make
        if sql is not None:
            ORACLES[make.__name__] = sql
        return make
    return register


def scratch(spark, name):
    """A new folder in the space all executors share, which a cluster names in spark.checkpoint.dir; a temporary one
    where driver and executors are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quire-")
    return f"{base}/{name}-{uuid.uuid4().hex}"
