"""Semantics of an append-only log: changes, unions, first and last rows of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY


def changes(log: DataFrame, comparable: list[str], key: tuple[str, ...] = KEY, order: str = "pos") -> DataFrame:
    """Rows that a watcher would append: priced rows whose comparable fields differ from the row before, by input order, or that follow none or a removal. `reappeared` marks the last case."""
    w = Window.partitionBy(*key).orderBy(order)
    value = F.struct(*comparable)
    last_removed, last_value = F.lag("removed").over(w), F.lag(value).over(w)
    marked = log.withColumn("_r", last_removed).withColumn("_same", value.eqNullSafe(last_value) & F.lag(F.lit(True)).over(w).isNotNull())
    kept = marked.where(~F.coalesce("removed", F.lit(False)) & (F.col("_r").isNull() | F.col("_r") | ~F.col("_same")))
    return kept.withColumn("reappeared", F.coalesce("_r", F.lit(False))).drop("_r", "_same")


def partition_view(log: DataFrame, value: Column, key: tuple[str, ...] = KEY) -> DataFrame:
    """One row for each key: first_seen over all rows, and the newest priced and the newest row by date, ties to the later position."""
    at = F.struct("observed_at", "pos")
    priced = ~F.coalesce("removed", F.lit(False))
    return log.groupBy(*key).agg(
        F.min("observed_at").alias("first_seen"),
        F.max_by(value, F.when(priced, at)).alias("priced"),
        F.max(F.when(priced, F.col("observed_at"))).alias("priced_at"),
        F.max("observed_at").alias("newest_at"),
        F.max_by(F.coalesce("removed", F.lit(False)), at).alias("newest_removed"),
    ).withColumn("removed_at", F.when(F.col("newest_removed"), F.col("newest_at")))


def last_by_input(log: DataFrame, fields: list[str], key: tuple[str, ...] = KEY) -> DataFrame:
    """One row for each key: the last priced row and the last row of any kind, by input order, not date."""
    row = F.struct(*fields)
    return log.groupBy(*key).agg(F.max_by(row, F.when(~F.coalesce("removed", F.lit(False)), F.col("pos"))).alias("last"), F.max_by(row, "pos").alias("newest"))


def recorded(rows: DataFrame, log: DataFrame, key: tuple[str, ...] = (*KEY, "observed_at"), line: str = "line") -> DataFrame:
    """The rows that the log has already: of the same key and day, and the same line."""
    return rows.join(log.select(*key, line).distinct(), [*key, line], "left_semi")


def line_union(base: DataFrame, extra: DataFrame, line: str = "line", order: str = "pos") -> DataFrame:
    """Lines of `extra` that `base` lacks, each once, where it first stands."""
    fresh = extra.join(base.select(line).distinct(), line, "left_anti")
    return fresh.groupBy(line).agg(F.min(order).alias(order))


def key_union(base: DataFrame, extra: DataFrame, key: tuple[str, ...] = (*KEY, "observed_at"), order: str = "pos") -> DataFrame:
    """Rows of `extra` that a key union keeps, in closed form instead of one after the other.

    A price row is kept if `base` has no row of its key and it is the key's first row in `extra`; a removal if `base` has no removal of
    its key and it is the key's first removal in `extra`.
    """
    gone = F.coalesce("removed", F.lit(False))
    have = base.groupBy(*key).agg(F.max(gone).alias("_base_removed"))
    any_first = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    own_first = F.row_number().over(Window.partitionBy(*key, "_gone").orderBy(order))
    ranked = extra.withColumn("_gone", gone).withColumn("_any", any_first).withColumn("_own", own_first)
    joined = ranked.join(have, list(key), "left")
    keep = F.when(F.col("_gone"), ~F.coalesce("_base_removed", F.lit(False)) & (F.col("_own") == 1)).otherwise(F.col("_base_removed").isNull() & (F.col("_any") == 1))
    return joined.where(keep).select(*extra.columns)


def churn(base: DataFrame, branch: DataFrame, group: str, key: tuple[str, ...] = KEY, line: str = "line") -> DataFrame:
    """For each group of `branch`: rows appended (lines that `base` lacks), new keys among them and removals."""
    fresh = branch.join(base.select(line).distinct(), line, "left_anti")
    known = base.select(*key).distinct().withColumn("_known", F.lit(True))
    marked = fresh.join(known, list(key), "left")
    return marked.groupBy(group).agg(
        F.count(F.lit(1)).alias("appended"),
        F.count_distinct(F.when(F.col("_known").isNull(), F.struct(*key))).alias("created"),
        F.count_if(F.coalesce("removed", F.lit(False))).alias("removed"),
    )


def stats(log: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """One row: models, sources, rows, first_seen ('-' without rows), days covered (0 unless two dates), last."""
    days = F.datediff(F.max(F.to_date("observed_at")), F.min(F.to_date("observed_at"))) + 1
    return log.agg(
        F.count_distinct(*key).alias("models"),
        F.count_distinct("source").alias("sources"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.min("observed_at"), F.lit("-")).alias("first_seen"),
        F.when(F.count_distinct("observed_at") > 1, days).otherwise(0).cast("bigint").alias("days"),
        F.coalesce(F.max("observed_at"), F.lit("")).alias("updated_at"),
    )
