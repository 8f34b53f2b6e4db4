"""Validity intervals, point-in-time lookup, runs and step points."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY


def cuts_of(rows: DataFrame, column: str, slices: int) -> list[str]:
    """Values that part `rows` into about `slices` even slices by `column`, for keys too large for one task."""
    if slices < 2:
        return []
    days = F.expr(f"percentile_approx(unix_date(to_date({column})), array({','.join(str(i / slices) for i in range(1, slices))}))")
    got = rows.select(days.alias("d")).first()["d"] or []
    epoch = datetime.date(1970, 1, 1)
    return sorted({(epoch + datetime.timedelta(d)).isoformat() for d in got})


def _slice(column: Column, cuts: list[str]) -> Column:
    out = F.lit(0)
    for c in cuts:
        out = out + F.coalesce((column >= c).cast("int"), F.lit(0))
    return out


def interval_chain(log: DataFrame, key: tuple[str, ...] = KEY, cuts: list[str] | None = None) -> DataFrame:
    """`log` with valid_from and valid_to (null: open).

    A row starts at its effective date, a removal and a row without one at its observation. It ends where the first of all rows that
    come later, by (observed_at, pos), starts, but not before its own start: a future effective date and a backfill clamp it to an
    empty interval. One sort a key, where comparing each row with all later ones would take the square. `cuts` (see cuts_of) split the
    keys by observation date: each slice is a task's, and a key's later slices are known by their least start alone.
    """
    start = F.when(F.coalesce("removed", F.lit(False)), F.col("observed_at")).otherwise(F.coalesce("effective_at", "observed_at"))
    chained = log.withColumn("valid_from", start)
    if not cuts:
        later = Window.partitionBy(*key).orderBy("observed_at", "pos").rowsBetween(1, Window.unboundedFollowing)
        ended = chained.withColumn("valid_to", F.min("valid_from").over(later))
    else:
        sliced = chained.withColumn("_slice", _slice(F.col("observed_at"), cuts))
        later = Window.partitionBy(*key, "_slice").orderBy("observed_at", "pos").rowsBetween(1, Window.unboundedFollowing)
        after = Window.partitionBy(*key).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
        rest = sliced.groupBy(*key, "_slice").agg(F.min("valid_from").alias("_least")).withColumn("_rest", F.min("_least").over(after)).drop("_least")
        ended = sliced.withColumn("_own", F.min("valid_from").over(later)).join(rest, [*key, "_slice"]).withColumn("valid_to", F.least("_own", "_rest")).select(*chained.columns, "valid_to")
    return ended.withColumn("valid_to", F.when(F.col("valid_to").isNotNull(), F.greatest("valid_to", "valid_from")))


def solid(chain: DataFrame) -> DataFrame:
    """The items that hold on some day."""
    return chain.where("valid_to is null or valid_to > valid_from")


def as_of(left: DataFrame, right: DataFrame, key: tuple[str, ...], left_at: str, right_at: str, take: list[str], tie: str, cuts: list[str] | None = None) -> DataFrame:
    """`left` with `take` of the last row of `right`, by (right_at, tie), at or before `left_at` in the same key; nulls if there is none.

    Both sides go through one window over their union, so a key costs the sort of its rows, not their product. `cuts` split the keys by
    time: each slice is a task's, and of a key's earlier slices only the last row is carried on.
    """
    fields = [c for c in left.columns if c not in key]
    a = left.select(*key, F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), F.struct(*fields).alias("_left"))
    b = right.select(*key, F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.struct(*take).alias("_held"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_slice", _slice(F.col("_at"), cuts or []))
    w = Window.partitionBy(*key, *(["_slice"] if cuts else [])).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = both.withColumn("_held", F.last("_held", ignorenulls=True).over(w)).where("_side = 1")
    if cuts:
        ends = both.where("_side = 0").groupBy(*key, "_slice").agg(F.max_by("_held", F.struct("_at", "_tie")).alias("_end"))
        slots = both.select(*key, "_slice").distinct().join(ends, [*key, "_slice"], "left")
        before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = slots.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).drop("_end")
        got = got.join(carried, [*key, "_slice"]).withColumn("_held", F.coalesce("_held", "_carried"))
    return got.select(*key, "_left.*", *[F.col(f"_held.{c}").alias(c) for c in take])


def price_as_of(chain: DataFrame, probes: DataFrame, take: list[str], day: str = "day", key: tuple[str, ...] = KEY, cuts: list[str] | None = None) -> DataFrame:
    """`probes` with `take` of the item that holds on its day. Solid items of a key follow each other without a gap, so it is the last that has started."""
    return as_of(probes, solid(chain), key, day, "valid_from", take, "pos", cuts)


def every_day(chain: DataFrame, last_day: str, take: list[str], key: tuple[str, ...] = KEY) -> DataFrame:
    """One row for each key and day from an item's start to the day before its end, or to `last_day`."""
    end = F.coalesce(F.date_sub(F.to_date("valid_to"), 1), F.to_date(F.lit(last_day)))
    days = solid(chain).withColumn("_end", end).where("_end >= to_date(valid_from)")
    return days.select(*key, F.explode(F.sequence(F.to_date("valid_from"), F.col("_end"))).alias("day"), *take).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def runs(chain: DataFrame, value: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """Stretches without a gap in the price: a removed or unpriced item closes a run where it starts; empty items count for nothing."""
    w = Window.partitionBy(*key).orderBy("valid_from", "observed_at", "pos")
    gap = F.coalesce("removed", F.lit(False)) | F.col(value).isNull()
    islands = solid(chain).withColumn("_gap", gap).withColumn("run", F.sum(F.col("_gap").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = islands.where("not _gap").groupBy(*key, "run").agg(
        F.min("valid_from").alias("run_start"),
        F.when(F.count_if(F.col("valid_to").isNull()) > 0, F.lit(None)).otherwise(F.max("valid_to")).alias("run_end"),
        F.count(F.lit(1)).alias("points"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    return numbered.withColumn("run", F.row_number().over(Window.partitionBy(*key).orderBy("run")))


def steps(chain: DataFrame, value: str, domain_end: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """The polyline of a price: each value, rounded to two places, holds from its start to its end, the last to `domain_end`."""
    priced = solid(chain).where(~F.coalesce("removed", F.lit(False)) & F.col(value).isNotNull())
    return priced.select(*key, F.col("valid_from").alias("x0"), F.coalesce("valid_to", F.lit(domain_end)).alias("x1"), F.round(value, 2).alias("y"))


def current_era(chain: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """The solid priced item observed last; that of the key's newest priced row if it is solid."""
    priced = solid(chain).where(~F.coalesce("removed", F.lit(False)))
    return priced.groupBy(*key).agg(F.max_by(F.struct("valid_from", "valid_to", "rate_input"), F.struct("observed_at", "pos")).alias("era")).select(*key, "era.*")


def charts(chain: DataFrame, value: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """(key, runs, start, finish, top, flat) of every key that is priced on some day: `runs` in order, each with its points (date, value) and its end (null: open).

    The domain runs from the first point to the last run's end, null while that is open; `top` is the highest value, 0 at least; `flat`
    tells that no value differs from it.
    """
    gap = F.coalesce("removed", F.lit(False)) | F.col(value).isNull()
    w = Window.partitionBy(*key).orderBy("valid_from", "observed_at", "pos")
    run = F.sum(gap.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = solid(chain).withColumn("_gap", gap).withColumn("_run", run).withColumn("_next", F.lead("valid_from").over(w))
    point = F.struct(F.col("valid_from").alias("date"), F.col(value).cast("double").alias("value"))
    last = F.max_by("valid_to", F.struct("valid_from", "observed_at", "pos"))
    each = marked.where(~F.col("_gap")).groupBy(*key, "_run").agg(F.array_sort(F.collect_list(F.struct("valid_from", "observed_at", "pos", point.alias("p")))).alias("points"), last.alias("end"))
    each = each.select(*key, "_run", F.transform("points", lambda x: x["p"]).alias("points"), "end")
    whole = each.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_run", "points", "end"))), lambda r: F.struct(r["points"].alias("points"), r["end"].alias("end"))).alias("runs"))
    values = F.flatten(F.transform("runs", lambda r: F.transform(r["points"], lambda p: p["value"])))
    top = F.greatest(F.array_max(values), F.lit(0.0))
    return whole.select(*key, "runs", F.get("runs", 0)["points"][0]["date"].alias("start"), F.element_at("runs", -1)["end"].alias("finish"), top.alias("top"), F.forall(values, lambda v: v == top).alias("flat"))
