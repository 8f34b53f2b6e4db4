"""Identities: catalog joins, alias ranges, vendors and seeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY


def with_catalog(keys: DataFrame, bridge: DataFrame) -> DataFrame:
    """`keys` with the entry that claims each; of several claims the last entry's stands."""
    one = bridge.groupBy(*KEY).agg(F.max_by(F.struct("canonical", "name", "vendor"), "canonical").alias("_e"))
    return keys.join(one, list(KEY), "left").select(*keys.columns, F.col("_e.canonical").alias("canonical"), F.col("_e.name").alias("name"), F.col("_e.vendor").alias("vendor"))


def unclaimed(keys: DataFrame, bridge: DataFrame) -> DataFrame:
    """Keys that no entry claims, as seeds of entries to come."""
    return keys.select(*KEY).distinct().join(bridge.select(*KEY).distinct(), list(KEY), "left_anti").withColumn("canonical", F.concat_ws("/", *KEY))


def seeds(keys: DataFrame, bridge: DataFrame, catalog: DataFrame) -> DataFrame:
    """unclaimed() for a catalog (canonical): a seed whose name an entry has already stops the query with that name."""
    taken = catalog.select("canonical").distinct().withColumn("_taken", F.lit(True))
    stop = F.raise_error(F.concat(F.lit("seed collides with an entry of the catalog: "), "canonical")).cast("string")
    return unclaimed(keys, bridge).join(taken, "canonical", "left").select(*KEY, F.when(F.col("_taken"), stop).otherwise(F.col("canonical")).alias("canonical"))


def alias_on(probes: DataFrame, aliases: DataFrame, day: str = "day", cuts: list[str] | None = None) -> DataFrame:
    """`probes` with the canonical that its alias named on its day: ranges are half-open, null ends open.

    `cuts` (see temporal.cuts_of) are for few aliases with many records: they split an alias over tasks by day. A record goes to the slices
    that it reaches into, without the bounds that hold for all days of a slice, so most records of a slice are its rows' matches, and
    the work is about that of the result.
    """
    keys = ["alias"]
    if cuts:
        spark = probes.sparkSession
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        begin, end, slices = F.col("valid_from"), F.col("valid_to"), len(cuts)
        count = lambda x, fits: reduce(Column.__add__, [F.coalesce(fits(x, F.lit(c)).cast("int"), F.lit(0)) for c in cuts])
        low = F.when(begin.isNull() & end.isNull(), -1).otherwise(count(begin, Column.__ge__))  # rows without a day are in slice -1
        high = F.when(end.isNull(), slices).otherwise(count(end, Column.__gt__))
        bound = lambda i: F.get(F.array(*map(F.lit, cuts)), i)
        at = F.col("_slice")
        each = aliases.withColumns({"_low": low, "_high": high}).where("_low <= _high").withColumn("_slice", F.explode(F.sequence("_low", "_high")))
        clipped = {"valid_from": F.when(~((at > 0) & (begin <= bound(at - 1))), begin), "valid_to": F.when(~((at < slices) & (end >= bound(at))), end)}
        aliases = each.withColumns({k: F.when(F.col(k).isNotNull(), v) for k, v in clipped.items()}).select("alias", "_slice", "valid_from", "valid_to", "canonical").repartition(n, "alias", "_slice")
        sliced = F.when(F.col(day).isNull(), -1).otherwise(count(F.col(day), Column.__ge__))
        probes, keys = probes.withColumn("_slice", sliced).repartition(n, "alias", "_slice"), ["alias", "_slice"]
    a, p = aliases.alias("a"), probes.alias("p")
    inside = (F.col("a.valid_from").isNull() | (F.col("a.valid_from") <= F.col(f"p.{day}"))) & (F.col("a.valid_to").isNull() | (F.col(f"p.{day}") < F.col("a.valid_to")))
    same = reduce(Column.__and__, [F.col(f"p.{k}") == F.col(f"a.{k}") for k in keys])
    return p.join(a, same & inside, "left").select("p.*", "a.canonical").drop("_slice")


def family(model_id: Column, makers: dict[str, str]) -> Column:
    """The maker that the id's words name, if they name exactly one."""
    table = F.create_map(*[F.lit(x) for kv in makers.items() for x in kv])
    words = F.split(F.lower(model_id), "[^a-z0-9]+")
    named = F.array_distinct(F.filter(F.transform(words, lambda w: F.try_element_at(table, w)), lambda v: v.isNotNull()))
    return F.when(F.size(named) == 1, F.get(named, 0))


def vendor_of(model_id: Column, provider_vendor: Column, provider_kind: Column, makers: dict[str, str]) -> Column:
    """The maker of an id by its shape: `@cf/vendor/model`, `vendor/model`, a family word, or a first party's own; else null."""
    parts = F.split(model_id, "/", -1)
    at = lambda i: F.get(parts, i)
    return (
        F.when((F.size(parts) == 3) & (at(0) == "@cf") & (at(1) != ""), F.lower(at(1)))
        .when((F.size(parts) == 2) & (at(0) != ""), F.lower(at(0)))
        .otherwise(F.coalesce(family(model_id, makers), F.when((F.size(parts) == 1) & (provider_kind == "first_party") & (provider_vendor != ""), F.lower(provider_vendor))))
    )


def resold(provider_vendor: Column, vendor: Column) -> Column:
    """A provider without a vendor resells everything; otherwise what another makes, or nobody known."""
    return provider_vendor.isNull() | ~provider_vendor.eqNullSafe(vendor)


def slug_collisions(rows: DataFrame, group: str, slug: str, within: tuple[str, ...] = ()) -> DataFrame:
    """`rows` with the path of a channel: the slug, and where it isn't alone in its group (and `within`) the first 8 digits of the url's SHA-256 behind it."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*within, group, slug))
    return rows.withColumn("collides", n > 1).withColumn("path", F.concat(F.lit("state/announce/"), F.col(group), F.lit("/"), F.col(slug), F.when(F.col("collides"), F.concat(F.lit("-"), F.substring(F.sha2("url", 256), 1, 8))).otherwise(""), F.lit(".md")))
