"""Whether a run saw its sources whole, what it saw of the stored ids, and what absence makes of that."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY

#: Sources whose pages list more than they price; their absence goes by what is priced.
BY_PRICE = ("dashscope", "mistral", "moonshot")


def _run(df: DataFrame) -> DataFrame:
    return df.withColumn("run", F.coalesce("run", F.lit("")))


def validity(fetched: DataFrame, page_faults: DataFrame, priced: DataFrame) -> DataFrame:
    """(source, run, settled, reason) of every source that a run fetched.

    A detection is whole if every page of the source could be read, none of its rows was skipped, and there is a row at all: a page of
    another shape than expected, as under a changed heading, gives none. `fetched` has (source, run), `page_faults` (source, run, url,
    fault), `priced` the rows of the pages with their fault. A null run is the run ''.
    """
    key = ["source", "run"]
    first = lambda name: F.min(F.when(F.col("fault").isNotNull(), F.struct(name, "fault")))  # noqa: E731  the least id, which another may begin with
    named = lambda x, name: F.concat_ws(": ", f"{x}.{name}", f"{x}.fault")
    rows = _run(priced).groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), first("model_id").alias("_skip"))
    pages = _run(page_faults).groupBy(*key).agg(first("url").alias("_page"))
    j = _run(fetched).select(*key).distinct().join(rows, key, "left").join(pages, key, "left")
    reason = F.when(F.col("_page").isNotNull(), F.concat(F.lit("page "), named("_page", "url"))).when(F.col("_rows").isNull(), "no row").when(F.col("_skip").isNotNull(), F.concat(F.lit("skipped "), named("_skip", "model_id")))
    return j.select(*key, reason.isNull().alias("settled"), reason.alias("reason"))


def sightings(stored: DataFrame, priced: DataFrame, names: DataFrame, valid: DataFrame, held: DataFrame) -> DataFrame:
    """(source, model_id, run, present, settled, held) of every stored id and every run that fetched its source.

    A page's id stands for the first of its spellings (`names`: source, model_id, ord, spelling) that is stored. Of sources in BY_PRICE only
    priced ids count. `held` has the keys that open branches hold.
    """
    keys = stored.select(*KEY).distinct()
    counted = _run(priced).where(F.col("fault").isNull() & (~F.col("source").isin(*BY_PRICE) | F.col("rates").isNotNull())).select(*KEY, "run").distinct()
    hit = names.join(keys.withColumnRenamed("model_id", "spelling"), ["source", "spelling"]).groupBy(*KEY).agg(F.min_by("spelling", "ord").alias("stored_id"))
    seen = counted.join(hit, list(KEY)).select("source", F.col("stored_id").alias("model_id"), "run", F.lit(True).alias("_present")).distinct()
    each = keys.join(valid.select("source", "run", "settled"), "source").join(seen, [*KEY, "run"], "left")
    each = each.join(held.select(*KEY).distinct().withColumn("_held", F.lit(True)), list(KEY), "left")
    return each.select(*KEY, "run", F.col("_present").isNotNull().alias("present"), "settled", F.col("_held").isNotNull().alias("held"))


def advance(state: DataFrame, seen: DataFrame, removed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(state, due) after one run: `state` (source, model_id, absent_runs, since) of ids absent once or twice, `due` the keys to remove.

    `seen` are one run's sightings(), `removed` (source, model_id) the keys whose newest row is a removal, landed or pending: these leave the
    state. A presence clears an id; an absence counts if the run is settled and nothing holds the id; the second is due, and stays so
    until the removal lands. Ids of sources that the run didn't fetch keep their state; ids no longer stored lose it.
    """
    gone = removed.select(*KEY).distinct().withColumn("_gone", F.lit(True))
    j = seen.join(state, list(KEY), "left").join(gone, list(KEY), "left")
    before = F.coalesce("absent_runs", F.lit(0))
    counts = F.col("settled") & ~F.col("present") & ~F.col("held")
    now = F.when(F.col("_gone").isNotNull() | (F.col("settled") & F.col("present")), 0).when(counts, F.least(before + 1, F.lit(2))).otherwise(before)
    moved = j.select(*KEY, now.cast("int").alias("absent_runs"), F.when(before > 0, F.col("since")).otherwise(F.col("run")).alias("since"), (counts & (now == 2)).alias("_due"))
    others = state.join(seen.select("source").distinct(), "source", "left_anti").select(*KEY, F.col("absent_runs").cast("int").alias("absent_runs"), "since")
    return moved.where("absent_runs > 0").drop("_due").unionByName(others), moved.where("_due").select(*KEY)
