"""Exact positions in a global order, by runs: no task sees more than one run."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quire.llm.store import stored


def with_places(rows: DataFrame, group: str) -> DataFrame:
    """Add ``run``, the number of the task, and ``place``, how many rows of the same ``group`` came before in this run.

    The result is meant to be stored at once: what is stored fixes runs and places.
    """
    def number(batches):
        run, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            codes = batch.column(group).dictionary_encode()
            names = codes.dictionary.to_pylist()
            codes = codes.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            counts = np.bincount(codes, minlength=len(names))
            places = np.empty(len(codes), np.int64)
            places[order] = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
            places += np.array([seen.get(name, 0) for name in names], np.int64)[codes]
            for name, count in zip(names, counts.tolist()):
                seen[name] = seen.get(name, 0) + count
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), run, np.int32)), pa.array(places)],
                [*batch.schema.names, "run", "place"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(number, f"{fields}, run int, place long")


def run_offsets(placed: DataFrame, group: str) -> DataFrame:
    """(group, run, before, total): how many rows of the group lie in earlier runs, and in all. One row for each group
    and run that has it; stored, so that Spark knows its size when it plans a join."""
    counts = placed.groupBy(group, "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return stored(counts.select(group, "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                                F.sum("n").over(Window.partitionBy(group)).alias("total")), "offsets")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``no``, the position from 0 within the group (a non-null string) in the order of the named columns, nulls
    first, and ``n``, the size of the group.

    Rows are cut into ranges of (group, order) and numbered inside their range; exact counts of the ranges before give
    the rest, so a group of any size is numbered by many tasks. Columns after which rows can still tie should end with
    a unique one, or equal rows share a task.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(with_places(ranged, group), "places")
    return (placed.join(run_offsets(placed, group), [group, "run"])
            .withColumn("no", F.col("before") + F.col("place")).withColumnRenamed("total", "n")
            .drop("run", "place", "before"))
