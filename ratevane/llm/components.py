"""Connected components of links between 64-bit integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written

#: Links that one task may hold: 64 MB. More are contracted in rounds first.
TASK_LINKS = 4_000_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component)."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))
    for x, y in zip(index[: len(a)].tolist(), index[len(a) :].tolist(), strict=True):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
    root = np.array(parent, np.int64)
    while True:
        nxt = root[root]
        if (nxt == root).all():
            return nodes, nodes[root]
        root = nxt


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, label) of every node in `links` (a, b); nodes share a label if and only if links connect them.

    While there are over `task_links` links, every node is replaced by its smallest neighbour or itself, which keeps what is
    connected and leaves far fewer nodes; sums before the shuffle keep a node with very many links cheap. The rest is one task's
    union-find. No links give no rows.
    """
    links, maps = written(links.select("a", "b").distinct(), "links"), []
    while links.count() > task_links:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")).select(F.col("a").alias("node"), "to"), "step")
        maps.append(step)
        ends = links.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        links = written(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if got:
            nodes, labels = union_find(*map(np.concatenate, zip(*got, strict=True)))
            yield pa.record_batch([pa.array(nodes), pa.array(labels)], names=["node", "label"])

    out = links.coalesce(1).mapInArrow(run, "node bigint, label bigint")
    for step in reversed(maps):
        out = step.join(out.select(F.col("node").alias("to"), "label"), "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    return out
