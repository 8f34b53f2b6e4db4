"""Validity intervals over a stream whose rows come late: what a late row changes of earlier ones goes out as a retraction and a new end."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schema import KEY

_OUT = "source string, model_id string, observed_at string, pos bigint, valid_from string, valid_to string, change int"


class _Chain(StatefulProcessor):
    """A key's items by (observed_at, pos), each with its start and the least start of all later ones.

    That least start never falls from one item to the next, so a late row changes a stretch of items right before it and no others.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getMapState("items", "observed_at string, pos bigint", "start string, later string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  the interface's names
        held = {tuple(k): tuple(v) for k, v in self.items.iterator()} if self.items.exists() else {}
        order, before = sorted(held), {}
        for frame in rows:
            for row in frame.itertuples(index=False):
                at = (row.observed_at, int(row.pos))
                if at in held:
                    continue  # a row that comes again
                place = bisect_left(order, at)
                nxt = held[order[place]] if place < len(order) else None
                held[at] = (row.start, None if nxt is None else min(nxt[0], nxt[1] or nxt[0]))
                before[at] = None
                order.insert(place, at)
                for k in range(place - 1, -1, -1):
                    start, later = held[order[k]]
                    if later is not None and later <= row.start:
                        break
                    before.setdefault(order[k], (start, later))
                    held[order[k]] = (start, row.start)
        out = []
        for at in sorted(before):
            old, new = (None if v is None else (v[0], None if v[1] is None else max(v[0], v[1])) for v in (before[at], held[at]))
            self.items.updateValue(at, held[at])
            if old != new:
                out += [(*key, *at, *old, -1)] if old else []
                out.append((*key, *at, *new, 1))
        yield pd.DataFrame(out, columns=["source", "model_id", "observed_at", "pos", "valid_from", "valid_to", "change"])

    def close(self) -> None:
        pass


def interval_stream(log: DataFrame) -> DataFrame:
    """(source, model_id, observed_at, pos, valid_from, valid_to, change) over a stream of log rows that come in any order.

    `change` is 1 where an interval holds from now on and -1 where an earlier one doesn't any more; what is left after all changes are
    added up is temporal.interval_chain() of the rows that have come. A row that comes again, by (observed_at, pos), changes nothing. The
    state, in RocksDB (spark.sql.streaming.stateStore.providerClass must say so), has a key's items as single entries; a batch writes
    those that change. The output mode is append.
    """
    start = F.when(F.coalesce("removed", F.lit(False)), F.col("observed_at")).otherwise(F.coalesce("effective_at", "observed_at"))
    rows = log.select(*KEY, "observed_at", F.col("pos").cast("bigint").alias("pos"), start.alias("start"))
    return rows.groupBy(*KEY).transformWithStateInPandas(_Chain(), _OUT, "Append", "None")


def standing(changes: DataFrame) -> DataFrame:
    """The intervals that hold after all changes of interval_stream() so far."""
    return changes.groupBy("source", "model_id", "observed_at", "pos", "valid_from", "valid_to").agg(F.sum("change").alias("n")).where("n > 0").drop("n")
