"""The log as a stream: changes, removals and counts per window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def change_stream(log: DataFrame, value: str) -> DataFrame:
    """(source, model_id, pos, value, reappeared) of rows whose value differs from the key's last, or that follow a removal.

    `log` is a stream of (source, model_id, pos, removed, value) whose rows of a key come in the order of pos across batches; the state of
    a key is its last value and whether it was removed.
    """
    kind = log.schema[value].dataType.simpleString()

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, gone, some = state.get if state.exists else (None, False, False)
        out = []
        for row in pd.concat(list(frames)).sort_values("pos").itertuples(index=False):
            now = None if pd.isna(row.value) else str(row.value)
            if not row.removed and (not some or gone or now != last):
                out.append((*key, row.pos, row.value, bool(some and gone)))
            last, gone, some = now, bool(row.removed), True
        state.update((last, gone, some))
        yield pd.DataFrame(out, columns=["source", "model_id", "pos", "value", "reappeared"])

    named = log.select("source", "model_id", "pos", "removed", F.col(value).alias("value"))
    return named.groupBy("source", "model_id").applyInPandasWithState(step, f"source string, model_id string, pos bigint, value {kind}, reappeared boolean", "last string, gone boolean, some boolean", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(log: DataFrame, at: str, width: str, late: str) -> DataFrame:
    """(source, start, n) of each window of event time; rows over `late` behind the newest are dropped, as a watermark says."""
    w = log.withWatermark(at, late).groupBy(F.window(at, width), "source").agg(F.count(F.lit(1)).alias("n"))
    return w.select("source", F.col("window.start").alias("start"), "n")
