"""Two absences in a row make a removal: as a batch over all runs, and as keyed streaming state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def two_strikes(seen: DataFrame, key: tuple[str, ...] = ("source", "model_id"), run: str = "run") -> DataFrame:
    """State of every key after every run: absent_runs (0, 1 or 2), since (the run that began the absence) and `removes` (the run that reaches 2).

    `seen` has a row for each key and run with `present`, and `settled`: whether the run's detection was whole. Runs that aren't
    settled, or in which a key is `held`, leave its state as it is. Counting stops at 2; a presence clears it.
    """
    w = Window.partitionBy(*key).orderBy(run)
    counts = F.col("settled") & ~F.col("held")
    stretch = F.sum((F.col("settled") & F.col("present")).cast("int")).over(w)
    inside = Window.partitionBy(*key, "_stretch").orderBy(run)
    marked = seen.withColumn("_stretch", stretch).withColumn("_absent", (counts & ~F.col("present")).cast("int"))
    n = F.sum("_absent").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    out = marked.withColumn("_n", n).withColumn("since", F.when(F.col("_n") > 0, F.min(F.when(F.col("_absent") == 1, F.col(run))).over(inside.rowsBetween(Window.unboundedPreceding, 0))))
    return out.withColumn("absent_runs", F.least("_n", F.lit(2)).cast("int")).withColumn("removes", (F.col("_n") == 2) & (F.col("_absent") == 1)).drop("_stretch", "_absent", "_n")


def stream_removals(seen: DataFrame, key: tuple[str, ...] = ("source", "model_id")) -> DataFrame:
    """(key, run, absent_runs) whenever a key reaches its second absence: the same rule over a stream of (key, run, present, settled, held), whose runs of a key come in order."""
    schema = ", ".join(f"{k} string" for k in key) + ", run string, absent_runs int"

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (n,) = state.get if state.exists else (0,)
        out = []
        for row in pd.concat(list(frames)).sort_values("run").itertuples(index=False):
            if row.settled and row.present:
                n = 0
            elif row.settled and not row.held:
                n = min(n + 1, 3)
                if n == 2:
                    out.append((*k, row.run, 2))
        state.update((n,))
        yield pd.DataFrame(out, columns=[*key, "run", "absent_runs"])

    return seen.groupBy(*key).applyInPandasWithState(step, schema, "n int", "append", GroupStateTimeout.NoTimeout)


def failing_twice(runs: DataFrame, key: str = "provider", run: str = "run") -> DataFrame:
    """(provider, run, alert, recovered): a hard failure in two checked runs in a row alerts; a checked run without one recovers."""
    w = Window.partitionBy(key).orderBy(run)
    before = F.lag("hard").over(w)
    return runs.select(key, run, (F.col("hard") & F.coalesce(before, F.lit(False))).alias("alert"), (~F.col("hard") & F.coalesce(before, F.lit(False))).alias("recovered"))
