"""What a run takes up: unseen ids, stored spellings, held keys, pages' tiers and promotions, and the state of a page's selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEY

# Paths that a merge owns, by kind; the first that fits names a path.
PATH_KINDS = (
    ("exact", r"^(data/catalog/(billing-rules|models)\.json|tests/test_billing_rules\.py)$"),
    ("shard", r"^data/history/[^/]*$"),
    ("announce", r"^state/announce/(index\.json|[^/]*/[^/]*\.md)$"),
    ("absence", r"^state/absence/[^/]*\.json$"),
)


def to_scrape(detected: DataFrame, stored: DataFrame, held: DataFrame) -> DataFrame:
    """(key, emits): detected keys without a stored row, each once; a held key is scraped too but emits nothing."""
    fresh = detected.select(*KEY).distinct().join(stored.select(*KEY).distinct(), list(KEY), "left_anti")
    marked = held.select(*KEY).distinct().withColumn("_held", F.lit(True))
    return fresh.join(marked, list(KEY), "left").select(*KEY, F.col("_held").isNull().alias("emits"))


def priced_none(attempts: DataFrame) -> DataFrame:
    """Providers of which every attempt came back without a price, with how many there were."""
    g = attempts.groupBy("provider").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(~F.col("priced")).alias("unpriced"))
    return g.where("unpriced = attempts").select("provider", "attempts")


def tiers(rows: DataFrame) -> DataFrame:
    """(model, bound, base, over): the row up to a bound and the row over it as one entry; a row without its partner stands alone."""
    low = rows.where("kind = 'up to'").select("model", "bound", F.col("rate").alias("base"))
    high = rows.where("kind = 'over'").select("model", "bound", F.col("rate").alias("over"))
    return low.join(high, ["model", "bound"], "full")


def held_channels(carriers: DataFrame) -> DataFrame:
    """(source, url) whose newest carrier is judged no: the base stays. Newest by fetch time, then number."""
    newest = carriers.groupBy("source", "url").agg(F.max_by("verdict", F.struct(F.col("fetched").isNotNull().alias("timed"), "fetched", "number")).alias("verdict"))
    return newest.where(~F.coalesce(F.col("verdict") == "yes", F.lit(False))).select("source", "url")


def promoted(text: Column, listed: Column) -> Column:
    """The price in force: `NN% off` is taken from the list price in decimals, an amount that isn't the list price stands itself, anything else leaves the list price."""
    off = F.regexp_extract(text, r"(\d{1,2})% off", 1).try_cast("int")
    amount = F.regexp_extract(text, r"\$(\d+(?:\.\d+)?)", 1).try_cast("decimal(18,6)")
    exact = listed.cast("decimal(18,6)")
    cut = (exact * (F.lit(100) - off).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")).cast("double")
    return F.when(off.isNotNull(), F.round(cut, 6)).when(amount.isNotNull() & (amount != exact), amount.cast("double")).otherwise(listed)


def path_kind(path: Column) -> Column:
    return F.coalesce(*[F.when(path.rlike(p), F.lit(k)) for k, p in PATH_KINDS], F.lit("other"))


def branch_name(key: Column, prefix: str = "rows/") -> Column:
    """A branch's name: the key, each character that a name can't have as a hyphen, and the first 8 digits of its SHA-256, so that keys that look alike stay apart."""
    return F.concat(F.lit(prefix), F.regexp_replace(key, "[^A-Za-z0-9._-]", "-"), F.lit("-"), F.substring(F.sha2(key, 256), 1, 8))


def decoded(fragment: Column) -> Column:
    """A page's state from its url fragment, as a map; later keys win no fight, as keys stand once."""
    pairs = F.filter(F.split(F.regexp_replace(fragment, "^#", ""), "&"), lambda p: p.contains("="))
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.try_url_decode(F.split_part(p, F.lit("="), F.lit(1))), F.try_url_decode(F.split_part(p, F.lit("="), F.lit(2))))))


def encoded(state: Column) -> Column:
    """The fragment of a state, keys in order."""
    return F.concat(F.lit("#"), F.array_join(F.transform(F.array_sort(F.map_entries(state)), lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"]))), "&"))


def priced_positive(rates: Column) -> Column:
    """Whether input and output have a price above zero."""
    return F.coalesce((rates["input"] > 0) & (rates["output"] > 0), F.lit(False))


def refused(priced: DataFrame, stored: DataFrame, covered: DataFrame) -> DataFrame:
    """(source, model_id, stored, why) of ids that a page prices but none detects, and that can't be taken up.

    `priced` (source, model_id, stored) has the id on the page and the one it is stored under, `stored` the newest row of each stored key
    (source, model_id, removed), `covered` (source, model_id) the stored keys that a detected id refreshes. Why: `removed`, as a page that
    only prices tells of no reappearance, else `covered`, as one key would be read from two rows. A stored id that no row has is new.
    """
    newest = stored.select("source", F.col("model_id").alias("stored"), F.coalesce("removed", F.lit(False)).alias("_removed"))
    other = covered.select("source", F.col("model_id").alias("stored")).distinct().withColumn("_covered", F.lit(True))
    j = priced.join(newest, ["source", "stored"], "left").join(other, ["source", "stored"], "left")
    why = F.when(F.col("_removed"), "removed").when(F.col("_covered"), "covered")
    return j.select(*KEY, "stored", why.alias("why")).where("why is not null").distinct()


def keepers(named: DataFrame) -> DataFrame:
    """(source, stored, model_id): of the page ids that are stored under one key, the one that stands: the key's own name, else the first by name."""
    return named.groupBy("source", "stored").agg(F.min_by("model_id", F.struct(F.col("model_id") != F.col("stored"), "model_id")).alias("model_id"))
