"""Published views: flat export, nested index, per-source twins, page data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def display_name(catalog_name: Column, quoted_name: Column, model_id: Column) -> Column:
    """The first of catalog name, quoted name and id that isn't empty."""
    return F.coalesce(F.nullif(catalog_name, F.lit("")), F.nullif(quoted_name, F.lit("")), model_id)


def flat(view: DataFrame, intervals: DataFrame, key: tuple[str, ...] = ("source", "model_id")) -> DataFrame:
    """One row for each key with its ordered chain."""
    chain = intervals.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("valid_from", "observed_at", "pos", "valid_to", "rate_input", "removed"))).alias("intervals"))
    return view.join(chain, list(key), "left")


def index(flat_rows: DataFrame, source: str = "source") -> DataFrame:
    """One row for each source: its entries by id, as one JSON object."""
    entry = F.struct(*[c for c in flat_rows.columns if c not in (source, "model_id")])
    return flat_rows.groupBy(source).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_id", entry.alias("entry")))))).alias("entries"), F.count(F.lit(1)).alias("models"))


def island(payload: Column) -> Column:
    """JSON safe inside a page's script."""
    return F.replace(payload, F.lit("<"), F.lit("\\u003c"))


def write_flat(rows: DataFrame, path: str, version: int) -> None:
    """The flat export and a twin for each source; version 2 keeps chat rows only and drops modality."""
    own = rows
    if version == 2 and "modality" in rows.columns:
        own = rows.where("modality is null").drop("modality")
    own.write.mode("overwrite").json(f"{path}/flat.v{version}")
    own.withColumn("_source", F.col("source")).write.mode("overwrite").partitionBy("_source").json(f"{path}/by_source.v{version}")
