"""Positions in a total order of all rows, without a task that holds them all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workers import shared_table


def places_in(rows: DataFrame, group: list[str], order: list[str | Column], name: str = "place") -> DataFrame:
    """`rows` with their places, from 1, inside their group; a group that holds most rows is dealt over tasks like any other."""
    placed = positions(rows, [*group, *order], name)
    least = placed.groupBy(*group).agg(F.min(name).alias("__least"))
    return placed.join(least, group).select(*rows.columns, (F.col(name) - F.col("__least") + 1).cast("int").alias(name))


def positions(rows: DataFrame, order: list[str | Column], name: str = "place", start: int = 0) -> DataFrame:
    """`rows` with their positions, from `start`, in a total order.

    Rows are dealt over ranges of the order and sorted inside; a row's position is its place in the range and the number of rows in the
    ranges before, of which there is a row each. Rows alike in the order take their positions as they happen to come.
    """
    spark = rows.sparkSession
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], names=[*batch.schema.names, "__part", name])
            at += n

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = shared_table(dealt.mapInArrow(run, f"{own}, __part int, `{name}` bigint"), "placed")
    before, offsets = start, []
    for part, size in sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((part, before))
        before += size
    table = spark.createDataFrame(offsets, "__part int, __before bigint")
    return placed.join(F.broadcast(table), "__part").select(*rows.columns, (F.col(name) + F.col("__before")).alias(name))
