"""Entry points: `python -m ratevane.jobs <job> ...`, each a batch over tables and files that a cluster reads."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .operators import absence, build, candidates, contract, log, merge, ops, review, runs, validate
from .operators.positions import positions
from .plans import publish
from .schema import FIELDS, INCOMPARABLE, KEY, RATES, ROW, VERSION
from .sources import dimensions, listing, registry
from .sources.observations import append_run, exists, parse_lines, read_fx, read_lines, read_log, shard_of, write_shards
from .workers import shared_table

JOBS: dict[str, Callable[[SparkSession, argparse.Namespace], None]] = {}
COMPARED = [f for f in FIELDS if f not in INCOMPARABLE and f not in (*KEY, "removed")]


def job(f):
    JOBS[f.__name__.replace("_", "-")] = f
    return f


def snapshot(stored: DataFrame) -> DataFrame:
    """(source, model_id, was, gone, removed) of each key of the log, in one pass over it.

    `was` is what a change is judged by, overrides in their order, and `gone` whether it is a removal, of the key's last row in the order of
    the log (path and pos); `removed` tells of its newest row, by day and then that order.
    """
    out = F.coalesce("removed", F.lit(False))
    last = F.max_by(F.struct(F.to_json(F.struct(*COMPARED)).alias("was"), out.alias("gone")), F.struct("path", "pos"))
    newest = F.max_by(out, F.struct("observed_at", "path", "pos"))
    return stored.groupBy(*KEY).agg(last.alias("l"), newest.alias("removed")).select(*KEY, "l.was", "l.gone", "removed")


def drift(rows: DataFrame, last: DataFrame) -> DataFrame:
    """`rows` whose price differs from the last stored row of their key, or that come back after a removal, or that are new; `last` is the log's snapshot()."""
    j = rows.withColumn("_now", F.to_json(F.struct(*COMPARED))).join(last.select(*KEY, "was", "gone"), list(KEY), "left")
    return j.where(F.col("was").isNull() | F.col("gone") | (F.col("_now") != F.col("was"))).select(rows.columns)


#: The source whose pages are listings of an API; how messages of a run that took up no provider begin.
LISTING = "openrouter"
HOLDS = ("pending scan failed; opening no pr this run", "store empty at load and the seed pr is still open; skipping the run")


@dataclass(frozen=True)
class Taken:
    """What a run makes of its pages: rows to append, a report (source, model_id, fault), whether each source was seen whole, what was seen of the stored ids, the absence state after it, and the keys due for removal."""

    rows: DataFrame
    report: DataFrame
    validity: DataFrame
    sightings: DataFrame
    state: DataFrame
    due: DataFrame


def ingested(spark: SparkSession, pages: DataFrame, stored: DataFrame, fx: DataFrame, providers: DataFrame, lines: DataFrame | None, state: DataFrame | None, day: str) -> Taken:
    """One run over `pages` (source, url, body), listings of an API among them, against the log `stored` (read_log()).

    Each page's ids go by the first of their spellings that has a stored row. `lines` are those of open branches (branch, path, pos, line):
    their valid rows stand in the log for what a price is compared with, but are not written again, and their keys append nothing. A row
    that breaks the contract, or a quote without a rate, is reported and left out. A source that wasn't seen whole leaves the absence of
    its ids as it was.
    """
    held = spark.createDataFrame([], "source string, model_id string")
    known = stored
    if lines is not None:
        landed = stored.select(F.concat(shard_of(F.col("path")), F.lit(".ndjson")).alias("path"), "line")
        read = parse_lines(lines.select("path", "pos", "line"), strict=False)
        waiting, held = review.pending_rows(read, landed, validate.fault(F.col("line")))
        known = stored.unionByName(waiting.withColumn("path", F.concat(F.lit("~"), "path")).select(stored.columns))  # behind all landed lines
    last = shared_table(snapshot(known), "snapshot")
    ids = last.select(*KEY)
    found = registry.read(pages)
    priced = shared_table(registry.all_priced(found), "priced")
    names = registry.spellings(priced.select(*KEY).distinct())
    hit = names.join(ids.withColumnRenamed("model_id", "spelling"), ["source", "spelling"]).groupBy(*KEY).agg(F.min_by("spelling", "ord").alias("_stored"))
    pairs = shared_table(priced.select(*KEY).distinct().join(hit, list(KEY), "left").select(*KEY, F.coalesce("_stored", "model_id").alias("stored")), "pairs")
    standing = candidates.keepers(pairs)
    twice = candidates.refused(pairs.join(standing, ["source", "stored", "model_id"], "left_anti"), last.where("false"), standing.select("source", F.col("stored").alias("model_id")))
    named = shared_table(priced.join(standing, list(KEY)).withColumn("model_id", F.col("stored")).drop("stored"), "named")
    quotes = shared_table(build.resolved(build.scraped_of(named).withColumn("observed_at", F.lit(day)), fx, providers, strict=False), "quotes")
    own = pages.where(F.col("source") == LISTING)
    listed, listing_faults = shared_table(listing.listing_rows(own, LISTING, day), "listed"), listing.listing_faults(own, LISTING).select(F.lit(LISTING).alias("source"), "model_id", "fault")
    rows = shared_table(build.price_rows(quotes.where("fx_fault is null"), day).unionByName(as_contract(listed), allowMissingColumns=True), "built")
    checked = shared_table(rows.withColumn("_fault", validate.fault()), "checked")  # each step of its own, as plans grow by their product
    fresh = drift(checked.where("_fault is null").drop("_fault"), last).join(held.select(*KEY).distinct(), list(KEY), "left_anti")
    report = named.where("fault is not null").select(*KEY, "fault").unionByName(quotes.where("fx_fault is not null").select(*KEY, F.col("fx_fault").alias("fault"))).unionByName(checked.where("_fault is not null").select(*KEY, F.concat(F.lit("contract: "), "_fault").alias("fault"))).unionByName(listing_faults)
    report = report.unionByName(twice.select(*KEY, F.concat(F.lit("stored under "), "stored", F.lit(", which another id refreshes")).alias("fault")))

    seen_rows = priced.select(*KEY, "run", "rates", "fault").unionByName(listed.select(*KEY, F.lit(None).cast("string").alias("run"), "rates", F.lit(None).cast("string").alias("fault")))
    seen_rows = seen_rows.unionByName(listing_faults.select(*KEY, F.lit(None).cast("string").alias("run"), F.lit(None).cast(RATES).alias("rates"), "fault"))
    fetched = pages.select("source", F.lit(None).cast("string").alias("run"))
    valid = shared_table(runs.validity(fetched, found.faults, seen_rows).withColumn("run", F.lit(day)), "validity")
    all_names = names.unionByName(listed.select(*KEY, F.lit(0).alias("ord"), F.col("model_id").alias("spelling")))
    sighted = shared_table(runs.sightings(ids, seen_rows.withColumn("run", F.lit(day)), all_names, valid, held), "sightings")
    before = state if state is not None else spark.createDataFrame([], "source string, model_id string, absent_runs int, since string")
    after, due = runs.advance(before, sighted, last.where("removed"))
    return Taken(fresh, report, valid, sighted, after, due)


def as_contract(rows: DataFrame) -> DataFrame:
    """`rows` with the fields of the contract in their types; those that are missing are null."""
    have = {f.name for f in rows.schema}
    kinds = {f.name: f.dataType for f in rows.sparkSession.createDataFrame([], ROW).schema}
    made = []
    for name, kind in kinds.items():
        if name not in have:
            made.append(F.lit(None).cast(kind).alias(name))
        elif isinstance(kind, StructType) and {f.name for f in rows.schema[name].dataType} != set(kind.names):
            inner = set(rows.schema[name].dataType.names)
            whole = F.struct(*[(F.col(f"{name}.{f.name}") if f.name in inner else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind])
            made.append(F.when(F.col(name).isNotNull(), whole).alias(name))
        else:
            made.append(F.col(name).cast(kind).alias(name))
    return rows.select(*made)


def take_up(spark: SparkSession, pages: DataFrame, run: str, day: str, root: str, out: str, pending: str | None) -> None:
    """One run, exactly once: it reads the log without what an earlier attempt at the same run has added, and what it writes takes that attempt's place."""
    log_at = f"{root}/data/history"
    stored = read_log(spark, log_at).where(~F.contains("path", F.lit(f"/run={run}/")))
    fx, providers = read_fx(spark, f"{root}/data/catalog/fx-rates.json"), dimensions.providers(spark, f"{root}/providers.toml")
    state = dimensions.absence(spark, f"{root}/state/absence", strict=False) if exists(spark, f"{root}/state/absence") else None
    earlier = f"{out}/state"
    if exists(spark, earlier):  # states of runs before this one; the last of them counts
        kept = spark.read.parquet(earlier).where(F.col("run").cast("string") < run)
        last = kept.agg(F.max("run").alias("run")).first()["run"]
        state = kept.where(F.col("run") == last).drop("run") if last is not None else state
    got = ingested(spark, pages, stored, fx, providers, spark.read.parquet(pending) if pending else None, state, day)
    ending = stored.join(shared_table(got.due, "due"), list(KEY), "left_semi").withColumn("removed", F.coalesce("removed", F.lit(False)))
    last = log.last_by_input(ending, [f for f in FIELDS if f not in KEY]).where("last is not null and not newest.removed")
    gone = build.removal_rows(last.select(*KEY, "last.*"), day)
    rows = shared_table(got.rows.unionByName(as_contract(gone), allowMissingColumns=True), "appended")
    got.report.write.mode("overwrite").json(f"{out}/report/run={run}")
    got.validity.write.mode("overwrite").parquet(f"{out}/validity/run={run}")
    got.state.write.mode("overwrite").parquet(f"{out}/state/run={run}")
    rows.write.mode("overwrite").parquet(f"{out}/appended/run={run}")
    append_run(rows, log_at, run)


@job
def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pages to rows of the log: --pages (source, url, body as Parquet), --root (log, catalogs, state), --day, --out; --pending (branch, path, pos, line as Parquet) for lines of open branches.

    With --checkpoint the folder of pages is a stream: each batch of new files is a run, numbered by the batch, whose replay adds nothing.
    """
    if not args.checkpoint:
        take_up(spark, spark.read.parquet(args.pages), args.day, args.day, args.root, args.out, args.pending)
        return

    def step(batch: DataFrame, number: int) -> None:
        take_up(batch.sparkSession, batch, f"{args.day}-{number:08d}", args.day, args.root, args.out, args.pending)

    stream = spark.readStream.schema("source string, url string, body string").parquet(args.pages)
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", args.checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


@job
def removals(spark: SparkSession, args: argparse.Namespace) -> None:
    """Runs' detections to removal rows: --seen (source, model_id, run, present, settled, held as Parquet), --root, --day, --out."""
    stored = read_log(spark, f"{args.root}/data/history")
    due = absence.two_strikes(spark.read.parquet(args.seen)).where("removes").where(F.col("run") == args.day).select(*KEY)
    last = log.last_by_input(stored.withColumn("removed", F.coalesce("removed", F.lit(False))), [f for f in FIELDS if f not in KEY]).where("last is not null and not newest.removed")
    build.removal_rows(last.join(due, list(KEY), "left_semi").select(*KEY, "last.*"), args.day).write.mode("overwrite").parquet(f"{args.out}/removed")


@job
def publish_views(spark: SparkSession, args: argparse.Namespace) -> None:
    """The log to its published tree: --root, --out; --readme renews the counts between its marks."""
    rows = read_log(spark, f"{args.root}/data/history")
    shards = rows.select(shard_of(F.col("path")).alias("source")).distinct()
    entries = dimensions.catalog(spark, f"{args.root}/data/catalog/models.json", allow_missing=False)
    ordered = rows.withColumn("pos", F.struct("path", "pos"))
    publish.write(spark, ordered, entries, args.out, VERSION, shards)
    if args.readme:
        table = publish.counts_table(publish.counts(rows, entries)).first()["text"]
        with open(args.readme, encoding="utf-8") as file:
            text = file.read()
        with open(args.readme, "w", encoding="utf-8") as file:
            file.write(publish.rendered(text, "stats", table))


@job
def merge_branches(spark: SparkSession, args: argparse.Namespace) -> None:
    """Branches to the log, catalog, rules, absence state and channels, as a new root in --out. --root, --branches (branch, path, pos, line as Parquet).

    Lines that the log has are left out; a branch with an invalid line, one that nobody claims, or more changes than the bounds allow is
    refused whole. --changes is a folder of Parquet tables, each of which may be missing: `entries` (branch, ord, canonical, entry,
    base_entry), `rules` (branch, id, rule), `absence` (ref, authored, source, state) and `channels` (branch, number, source, url, sha,
    fetched, text, verdict); branches land in the order of their names. With --schema, the file of the row contract, lines are held against it at every depth too. A key that a landed removal ends leaves the absence state.
    """
    head = read_lines(spark, f"{args.root}/data/history")
    landed_lines = head.select(F.concat(shard_of(F.col("path")), F.lit(".ndjson")).alias("path"), "line").distinct()
    lines = spark.read.parquet(args.branches)
    new = lines.join(landed_lines, ["path", "line"], "left_anti")
    fresh = parse_lines(new.select("path", "pos", "line"), strict=False).dropDuplicates(["path", "line"])
    deep = contract.contract_fault(F.col("line"), contract.load_schema(spark, args.schema)) if args.schema else F.lit(None)
    checked = fresh.join(new.select("path", "line", "branch").distinct(), ["path", "line"]).withColumn("_fault", F.coalesce(validate.fault(F.col("line")), deep))
    known = parse_lines(head.select("path", "pos", "line"))
    part = lambda name: spark.read.parquet(f"{args.changes}/{name}") if args.changes and exists(spark, f"{args.changes}/{name}") else None
    catalog_at = f"{args.root}/data/catalog/models.json"
    entries = part("entries")
    head_entries = raw_entries(spark, catalog_at)
    churned = merge.within_bounds(log.churn(known, checked.withColumn("removed", F.coalesce("removed", F.lit(False))), "branch"))
    bad = checked.where("_fault is not null").select("branch").unionByName(churned.where("exceeds is not null").select("branch"))
    claimed = F.explode(merge.claims_of(F.col("entry"))).alias("claim")
    unclaimed = checked.where(~F.coalesce("removed", F.lit(False))).select("branch", F.concat("source", F.lit("/"), "model_id").alias("claim")).join(head_entries.select(claimed), "claim", "left_anti")
    if entries is not None:  # a branch may bring the claim itself
        unclaimed = unclaimed.join(entries.select("branch", claimed), ["branch", "claim"], "left_anti")
    refused = shared_table(bad.unionByName(unclaimed.select("branch")).distinct(), "refused")
    standing = lambda df: df.join(refused, "branch", "left_anti")
    landed = standing(checked).drop("branch", "_fault").dropDuplicates(["path", "line"])
    refused.write.mode("overwrite").json(f"{args.out}/refused")
    whole = known.unionByName(landed.withColumn("path", F.concat(F.lit("~"), "path")).select(known.columns))
    write_shards(positions(whole, ["source", "model_id", "observed_at", "path", "pos"], "_at").drop("path", "line", "pos").withColumnRenamed("_at", "pos"), f"{args.out}/data/history")

    if entries is not None:
        merged, late = merge.catalog_merge(head_entries, standing(entries))
        merged.write.mode("overwrite").parquet(f"{args.out}/catalog")
        late.write.mode("overwrite").json(f"{args.out}/refused-entries")
    if (rules := part("rules")) is not None:
        at = f"{args.root}/data/catalog/billing-rules.json"
        old = spark.read.text(at, wholetext=True).select(F.explode(F.try_variant_get(F.parse_json("value"), "$.rules", "array<variant>")).alias("r")).select(F.try_variant_get("r", "$.id", "string").alias("id"), F.to_json("r").alias("rule")) if exists(spark, at) else spark.createDataFrame([], "id string, rule string")
        merge.rule_union(old, standing(rules)).write.mode("overwrite").parquet(f"{args.out}/rules")
    if (files := part("absence")) is not None:
        last = merge.absence_merge(standing(files.withColumnRenamed("ref", "branch")).withColumnRenamed("branch", "ref"))
        state = last.select("source", F.explode(F.from_json("state", "map<string,struct<absent_runs:int,since:string>>")).alias("model_id", "s")).select("source", "model_id", "s.absent_runs", "s.since")
        gone = snapshot(whole).where("removed").select(*KEY)
        state.join(gone, list(KEY), "left_anti").write.mode("overwrite").parquet(f"{args.out}/absence")
    if (channels := part("channels")) is not None:
        base = dimensions.announce(spark, args.root, strict=False).where("fault is null")
        own = standing(channels)
        holds = candidates.held_channels(merge.carriers(base, own))
        free = own.join(holds, ["source", "url"], "left_anti")
        ops.resolved_channels(base, free).write.mode("overwrite").parquet(f"{args.out}/channels")


def raw_entries(spark: SparkSession, path: str) -> DataFrame:
    """(canonical, entry): the catalog's entries as JSON."""
    if not exists(spark, path):
        return spark.createDataFrame([], "canonical string, entry string")
    models = F.try_variant_get("v", "$.models", "map<string,variant>")
    return dimensions.document(spark, path).select(F.explode(models).alias("canonical", "v")).select("canonical", F.to_json("v").alias("entry"))


@job
def merge_verified(spark: SparkSession, args: argparse.Namespace) -> None:
    """Requests and comments to what is merged, judged and settled: --requests (number, head, oid), --comments (number, pos, author, body), --bot, --prefix, --limit, --out.

    `eligible` are own requests whose bound verdict is yes, `awaiting` those to be judged again, oldest first. With --changes, a folder
    with `channels` (number, source, url, sha, fetched, verdict), `channel_settled` tells of every request whether all it carries is settled,
    and `requeued` are the requests refused earlier whose channels a newer carrier has superseded.
    """
    open_, comments = spark.read.parquet(args.requests), spark.read.parquet(args.comments)
    said = ops.verdicts(comments.join(open_.select("number", F.col("oid").alias("head")), "number"), args.bot)
    bound = open_.select("number").join(said.select("number", "verdict"), "number", "left")
    review.eligible(open_, bound, args.prefix).write.mode("overwrite").json(f"{args.out}/eligible")
    review.awaiting(open_, bound, args.prefix, args.limit).write.mode("overwrite").json(f"{args.out}/awaiting")
    if args.changes:
        channels = spark.read.parquet(f"{args.changes}/channels")
        base = dimensions.announce(spark, args.root, strict=False).where("fault is null").select("source", "url", F.col("sha").alias("_sha"), F.col("fetched").alias("_at"))
        newest = Window.partitionBy("source", "url").orderBy(F.desc("fetched"), F.desc("number"))
        ranked = channels.join(bound.withColumnRenamed("verdict", "_said"), "number", "left").join(base, ["source", "url"], "left").withColumn("_nth", F.row_number().over(newest))
        passed = F.max(F.when(F.col("_said") == "yes", F.col("fetched"))).over(Window.partitionBy("source", "url"))
        done = F.coalesce((F.col("sha") == F.col("_sha")) | (F.col("_at") >= F.col("fetched")), F.lit(False)) | F.coalesce(passed > F.col("fetched"), F.lit(False))
        each = ranked.withColumn("channel_settled", done)
        merge.settled(each).write.mode("overwrite").json(f"{args.out}/channel_settled")
        each.where("channel_settled and _said = 'no'").select("number").distinct().write.mode("overwrite").json(f"{args.out}/requeued")


@job
def health(spark: SparkSession, args: argparse.Namespace) -> None:
    """A run's log and the run before it to alerts: --now, --before (text files), --alerts (titles of open ones as Parquet), --prefix, --out.

    A run that was held opens and closes nothing: `held` has the reason. `skips` counts what detections left out. With --runs, a folder
    with `runs` (id, created, status) and `jobs` (id, name, conclusion), `probe` has the state of the weekly probe and `probe_change` the
    alert that it opens or closes.
    """
    read = lambda at: spark.read.text(at, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    now, before, open_ = read(args.now), read(args.before), spark.read.parquet(args.alerts)
    hard = lambda lines: ops.issues(lines).where("class = 'hard'").select("provider").distinct()
    message = ops.message(F.col("line"))
    reason = review.hold_reason(now, message, HOLDS)
    ops.warning(ops.issues(now)).write.mode("overwrite").json(f"{args.out}/warning")
    reason.where("reason is not null").write.mode("overwrite").json(f"{args.out}/held")
    review.skips_by_run(now.withColumn("run", F.lit(args.day)), message).write.mode("overwrite").json(f"{args.out}/skips")
    free = lambda df: df.join(F.broadcast(reason), F.col("reason").isNotNull(), "left_anti")  # noqa: E731  one row
    free(review.pings(hard(now), hard(before), open_, args.prefix)).write.mode("overwrite").json(f"{args.out}/opened")
    checked = review.checked_providers(now, message)
    free(review.recovered(open_, checked, hard(now), args.prefix)).write.mode("overwrite").json(f"{args.out}/closed")
    if args.runs:
        probe = review.weekly_probe(spark.read.parquet(f"{args.runs}/runs"), spark.read.parquet(f"{args.runs}/jobs"))
        probe.write.mode("overwrite").json(f"{args.out}/probe")
        state = probe.select(F.lit(f"{args.prefix}weekly probe").alias("title"), F.when(F.col("state").isin("failed", "missing"), "dead").when(F.col("state") == "ok", "alive").alias("state"))
        review.alert_changes(state, open_).write.mode("overwrite").json(f"{args.out}/probe_change")


@job
def smoke(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pages of one source must price something: --pages, --source, --model (else the first id); anything else is an error."""
    rows = registry.all_priced(spark.read.parquet(args.pages), (args.source,))
    own = rows.where(F.col("model_id") == args.model) if args.model else rows.orderBy("model_id").limit(1)
    got = own.select(candidates.priced_positive(F.col("rates")).alias("good"), "fault").first()
    if got is None or not got["good"]:
        raise ValueError(f"{args.source}: no positive price ({got['fault'] if got else 'no id'})")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ratevane.jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    for name in ("pages", "root", "day", "out", "seen", "readme", "branches", "requests", "comments", "bot", "prefix", "now", "before", "alerts", "source", "model", "pending", "checkpoint", "changes", "runs", "schema"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--limit", type=int, default=20)
    args = parser.parse_args(argv)
    JOBS[args.job](SparkSession.builder.getOrCreate(), args)


if __name__ == "__main__":
    main()
