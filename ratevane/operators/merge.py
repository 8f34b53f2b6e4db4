"""Merging branches: catalogs, rules, absence files, settled channels."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workers import shared_table
from .positions import positions


def rule_union(head: DataFrame, branches: DataFrame) -> DataFrame:
    """Rules by id: the head's stand; of branches that add an id the first does."""
    new = branches.join(head.select("id"), "id", "left_anti")
    first = new.groupBy("id").agg(F.min_by(F.struct(*[c for c in new.columns if c not in ("id", "branch")]), "branch").alias("r"))
    return head.unionByName(first.select("id", "r.*").select(head.columns))


def catalog_union(merge_base: DataFrame, head: DataFrame, branch: DataFrame) -> DataFrame:
    """(canonical, source, model_id) claims of `branch` to land: entries that it added or changed since the merge base, unless the head claims one of their ids, whichever entry does."""
    whole = lambda df: df.groupBy("canonical").agg(F.array_sort(F.collect_set(F.struct("source", "model_id"))).alias("claims"))
    changed = whole(branch).join(whole(merge_base).withColumnRenamed("claims", "old"), "canonical", "left").where(F.col("old").isNull() | (F.col("old") != F.col("claims"))).select("canonical")
    mine = branch.join(changed, "canonical")
    taken = mine.join(head.select("source", "model_id").distinct(), ["source", "model_id"], "left_semi").select("canonical").distinct()
    return mine.join(taken, "canonical", "left_anti").select("canonical", "source", "model_id")


#: Claims of entries that are left undecided which one task takes up in their order.
TASK_CLAIMS = 100_000


def first_unblocked(items: DataFrame, taken: DataFrame, task_claims: int = TASK_CLAIMS) -> DataFrame:
    """(no) of the items that land if each, in the order of `no`, lands unless one of its claims is taken already, by `taken` (claim) or an item before it.

    `items` has (no, claims). By rounds: an item that comes first on all its claims lands, which refuses every other item on them. Each
    round decides the first item of every group of conflicts; once few claims are left, one task goes through them in their order.
    """
    each = items.select("no", F.explode("claims").alias("claim")).distinct()
    free = items.where(F.size("claims") == 0).select("no")
    blocked = each.join(taken.select("claim").distinct(), "claim", "left_semi").select("no").distinct()
    left = shared_table(each.join(blocked, "no", "left_anti"), "undecided")
    landed = [free]
    while True:
        n = left.count()
        if not n:
            break
        if n <= task_claims:
            landed.append(left.groupBy(F.lit(0).alias("all")).applyInPandas(_in_order, "no bigint"))
            break
        first = left.groupBy("claim").agg(F.min("no").alias("first"))
        lands = shared_table(left.join(first, "claim").groupBy("no").agg(F.bool_and(F.col("no") == F.col("first")).alias("lands")).where("lands").select("no"), "lands")
        landed.append(lands)
        closed = left.join(lands, "no", "left_semi").select("claim").distinct()
        refused = left.join(closed, "claim", "left_semi").select("no").distinct()
        left = shared_table(left.join(refused, "no", "left_anti"), "undecided")
    return reduce(DataFrame.unionByName, [x.select(F.col("no").cast("bigint").alias("no")) for x in landed])


def _in_order(frame: pd.DataFrame) -> pd.DataFrame:
    taken: set[str] = set()
    out = []
    for no, own in frame.sort_values("no").groupby("no", sort=True):
        claims = set(own["claim"])
        if not claims & taken:
            out.append(no)
            taken |= claims
    return pd.DataFrame({"no": pd.Series(out, dtype="int64")})


def claims_of(entry: Column) -> Column:
    """The claims of a catalog entry in JSON, each as `source/id`; an id may stand alone or in a list."""
    ids = lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(v))
    sources = F.map_entries(F.from_json(entry, "struct<sources:map<string,string>>")["sources"])
    flat = F.flatten(F.transform(sources, lambda s: F.transform(ids(s["value"]), lambda i: F.concat(s["key"], F.lit("/"), i))))
    return F.coalesce(F.array_distinct(flat), F.array().cast("array<string>"))


def _same(entry: Column) -> Column:
    """An entry's JSON with its keys in order."""
    return F.to_json(F.try_parse_json(entry))


def catalog_merge(head: DataFrame, branches: DataFrame, task_claims: int = TASK_CLAIMS) -> tuple[DataFrame, DataFrame]:
    """(catalog, refused): the head's entries (canonical, entry) and those that branches land, and the branches' entries that don't.

    `branches` has (branch, ord, canonical, entry, base_entry): an entry as JSON and as it was in the branch's merge base (null: not
    there); the order is that of branch, then ord. What a branch added or changed lands unless one of its claims is the head's or one of an
    entry that landed before. A canonical name that lands more than once keeps the last.
    """
    changed = branches.where(F.col("base_entry").isNull() | ~_same(F.col("base_entry")).eqNullSafe(_same(F.col("entry"))))
    items = shared_table(positions(changed.select("branch", "ord", "canonical", "entry"), ["branch", "ord"], "no").withColumn("claims", claims_of(F.col("entry"))), "entries")
    taken = head.select(F.explode(claims_of(F.col("entry"))).alias("claim"))
    lands = first_unblocked(items.select("no", "claims"), taken, task_claims)
    new = items.join(lands, "no", "left_semi").groupBy("canonical").agg(F.max_by("entry", "no").alias("entry"))
    kept = head.select("canonical", "entry").join(new, "canonical", "left_anti").unionByName(new)
    return kept, items.join(lands, "no", "left_anti").select("branch", "canonical")


def sorted_lines(lines: DataFrame) -> DataFrame:
    """(path, pos, line) of shards' lines in the order of (model_id, observed_at), ties as they stood; the lines are as they were, `pos` is the new place."""
    key = [F.get_json_object("line", f"$.{k}") for k in ("model_id", "observed_at")]
    w = Window.partitionBy("path").orderBy(*key, "pos")  # a shard is one file
    return lines.select("path", (F.row_number().over(w) - 1).alias("pos"), "line")


def uncovered(appended: DataFrame, claims: DataFrame) -> DataFrame:
    """Appended price rows whose key nobody claims; removals need no claim."""
    return appended.where(~F.coalesce("removed", F.lit(False))).join(claims.select("source", "model_id").distinct(), ["source", "model_id"], "left_anti")


def absence_merge(files: DataFrame) -> DataFrame:
    """The file of each source that was written last, by author time; the head's wins a tie."""
    return files.groupBy("source").agg(F.max_by(F.struct("state", "ref"), F.struct("authored", (F.col("ref") == "head").alias("head"))).alias("x")).select("source", "x.state", "x.ref")


def settled(carried: DataFrame) -> DataFrame:
    """(number, settled): whether every channel that a branch carries is settled; a branch without any is not."""
    return carried.groupBy("number").agg(F.coalesce(F.bool_and("channel_settled"), F.lit(False)).alias("settled"))


def carriers(base: DataFrame, branches: DataFrame) -> DataFrame:
    """Branch rows that carry a channel's news: the base lacks it, or its hash differs and its fetch is older."""
    b = base.select("source", "url", F.col("sha").alias("base_sha"), F.col("fetched").alias("base_fetched"))
    return branches.join(b, ["source", "url"], "left").where(F.col("base_sha").isNull() | ((F.col("sha") != F.col("base_sha")) & (F.col("fetched") > F.col("base_fetched")))).select(branches.columns)


def within_bounds(churn: DataFrame, created: int = 50, removed: int = 50, appended: int = 500) -> DataFrame:
    """`churn` with the bound that a branch exceeds, or null."""
    over = F.when(F.col("created") > created, "created").when(F.col("removed") > removed, "removed").when(F.col("appended") > appended, "appended")
    return churn.withColumn("exceeds", over)


def effective_terms(products: DataFrame, terms: DataFrame) -> DataFrame:
    """(product, rates by axis, effective): products with their terms by exact sku; two terms for an axis stop the query; effective is the latest of the axes' dates."""
    both = products.join(terms, "sku")
    one = F.when(F.count(F.lit(1)) == 1, F.first("rate")).otherwise(F.raise_error(F.concat(F.lit("ambiguous term of "), F.first("product"), F.lit(" "), F.first("axis"))).cast("double"))
    axis = both.groupBy("product", "axis").agg(one.alias("rate"), F.max("day").alias("day"))
    return axis.groupBy("product").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("axis", "rate")))).alias("rates"), F.max("day").alias("effective"))


def implausible(base: Column, overrides: Column) -> Column:
    """Whether cached tokens cost more than fresh ones, at the base or in an override."""
    return F.coalesce(base["cache_read"] > base["input"], F.lit(False)) | F.exists(F.coalesce(overrides, F.array()), lambda o: F.coalesce(o["rates"]["cache_read"] > o["rates"]["input"], F.lit(False)))
