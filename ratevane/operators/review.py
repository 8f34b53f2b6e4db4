"""Open requests, their verdicts and channels; run and alert states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug
from .catalog import slug_collisions
from .merge import carriers as _carriers


def listing(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(number, title, head, oid) of the open requests in JSON listings; entries without a number are left out, a body that isn't a list stops the query."""
    v = F.try_parse_json(body)
    rows = F.try_variant_get(v, "$", "array<variant>")
    checked = F.when(rows.isNull(), F.raise_error(F.lit("listing isn't a list")).cast("array<variant>")).otherwise(rows)
    flat = bodies.select(F.explode(checked).alias("e"))
    get = lambda k: F.coalesce(F.try_variant_get("e", f"$.{k}", "string"), F.lit(""))
    return flat.select(F.try_variant_get("e", "$.number", "bigint").alias("number"), get("title").alias("title"), get("headRefName").alias("head"), get("headRefOid").alias("oid")).where("number is not null")


def seed_pending(open_: DataFrame, seed: str) -> DataFrame:
    """One row: whether the request that seeds the log is open."""
    return open_.agg(F.coalesce(F.max(F.col("head") == seed), F.lit(False)).alias("pending"))


def present(open_: DataFrame, refs: DataFrame) -> DataFrame:
    """`open_` with `present`: whether its head still resolves; one whose branch is gone is about to close."""
    return open_.join(refs.select("head").distinct().withColumn("_there", F.lit(True)), "head", "left").withColumn("present", F.col("_there").isNotNull()).drop("_there")


def eligible(open_: DataFrame, bound: DataFrame, prefix: str) -> DataFrame:
    """(number, head) of own requests whose bound verdict is yes, oldest first."""
    own = open_.where(F.col("head").startswith(prefix)).join(bound.where("verdict = 'yes'").select("number"), "number", "left_semi")
    return own.select("number", "head").orderBy("number")


def awaiting(open_: DataFrame, bound: DataFrame, prefix: str, limit: int, requeue: DataFrame | None = None) -> DataFrame:
    """(number, head) of own requests without a bound verdict, or to be judged again, oldest first, `limit` at most."""
    judged = bound.where("verdict is not null").select("number")
    if requeue is not None:
        judged = judged.join(requeue.select("number"), "number", "left_anti")
    return open_.where(F.col("head").startswith(prefix)).join(judged, "number", "left_anti").select("number", "head").orderBy("number").limit(limit)


def stale_yeses(open_: DataFrame, verdicts: DataFrame, prefix: str) -> DataFrame:
    """(head, stamp, oid) of own requests said yes to for another head; `verdicts` has (number, said, stamp)."""
    j = open_.where(F.col("head").startswith(prefix)).join(verdicts.where("said = 'yes'"), "number")
    return j.where(~F.coalesce((F.col("stamp") == F.col("oid")) & (F.col("oid") != ""), F.lit(False))).select("head", "stamp", "oid")


def newest_carriers(carried: DataFrame, times: DataFrame) -> DataFrame:
    """(source, url, number): of a channel's carriers the one judged last; one without a judgement is below any, ties go to the larger number."""
    j = carried.join(times.select("number", F.nullif(F.col("at"), F.lit("")).alias("at")), "number", "left")
    return j.groupBy("source", "url").agg(F.max_by("number", F.struct(F.col("at").isNotNull().alias("judged"), "at", "number")).alias("number"))


def held(base: DataFrame, branches: DataFrame, bound: DataFrame, times: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source, url) of channels that stay at the base: their newest carrier has no bound yes, or some candidate's index couldn't be read (`unread`).

    Nothing is held where every candidate has a bound yes. `base` and `branches` are channel indexes (source, url, sha, fetched; number).
    """
    yes = bound.where("verdict = 'yes'").select("number")
    flags = candidates.join(yes.withColumn("_yes", F.lit(True)), "number", "left").agg(F.coalesce(F.max(F.col("_yes").isNull()), F.lit(False)).alias("some_open"), F.coalesce(F.max("unread"), F.lit(False)).alias("some_unread"))
    carried = _carriers(base, branches)
    newest = newest_carriers(carried, times).join(yes.withColumn("_yes", F.lit(True)), "number", "left")
    return newest.join(F.broadcast(flags), F.col("some_open") & (F.col("some_unread") | F.col("_yes").isNull())).select("source", "url")  # one row of flags


def settled(base: DataFrame, branches: DataFrame, changed: DataFrame, bound: DataFrame, times: DataFrame, candidates: DataFrame) -> DataFrame:
    """(number) of requests with a bound no, and a readable index, whose every channel changed by their own commits is settled; one that changed none isn't.

    A channel is settled if the base has the same text or one fetched no earlier, or if its newest carrier has a bound yes.
    """
    own = branches.join(changed.select("number", "source", "url").distinct(), ["number", "source", "url"])
    b = base.select("source", "url", F.col("sha").alias("_sha"), F.col("fetched").alias("_at"))
    yes = bound.where("verdict = 'yes'").select("number")
    good = newest_carriers(_carriers(base, branches), times).join(yes, "number", "left_semi").select("source", "url").withColumn("_good", F.lit(True))
    j = own.join(b, ["source", "url"], "left").join(good, ["source", "url"], "left")
    done = F.coalesce((F.col("sha") == F.col("_sha")) | (F.col("_at") >= F.col("fetched")), F.lit(False)) | F.col("_good").isNotNull()
    each = j.groupBy("number").agg(F.min(done).alias("done")).where("done")
    return each.join(candidates.where("not unread").select("number"), "number", "left_semi").join(bound.where("verdict = 'no'").select("number"), "number", "left_semi").select("number")


def changed_channels(branches: DataFrame, diffs: DataFrame) -> DataFrame:
    """(number, source, url) of channels whose file a request's own commits changed.

    `branches` (number, source, url) is each request's index, `diffs` (number, path) the files that its commits changed. A channel's path
    comes from its own index, in which slugs may collide. A file of no channel of the index, such as a deleted one's, is none.
    """
    named = slug_collisions(branches.select("number", "source", "url").distinct().withColumn("_slug", slug(F.col("url"))), "source", "_slug", ("number",))
    return named.join(diffs.select("number", "path").distinct(), ["number", "path"], "left_semi").select("number", "source", "url")


def hold_reason(lines: DataFrame, message: Column, starts: tuple[str, ...], order: str = "pos") -> DataFrame:
    """One row: the first message that says why no provider ran; null if none does."""
    said = F.when(message.rlike("^(" + "|".join(starts) + ")"), message)
    return lines.agg(F.min_by(said, F.when(said.isNotNull(), F.col(order))).alias("reason"))


def checked_providers(lines: DataFrame, message: Column, start: str = "providers checked:", order: str = "pos") -> DataFrame:
    """(provider) named by the first line of the run that tells which were checked; none if no line does."""
    said = F.when(message.startswith(start), F.substring(message, len(start) + 1, 1 << 20))
    first = lines.agg(F.min_by(said, F.when(said.isNotNull(), F.col(order))).alias("t"))
    return first.select(F.explode(F.split(F.trim("t"), r"\s+")).alias("provider")).where("provider <> ''").distinct()


def previous_run(runs: DataFrame, current: str) -> DataFrame:
    """The newest completed run before the current one that wasn't held: `runs` has (id, number, status, held)."""
    return runs.where((F.col("id") != current) & (F.col("status") == "completed") & ~F.col("held")).orderBy(F.desc("number")).limit(1)


def weekly_probe(runs: DataFrame, jobs: DataFrame, job: str = "smoke") -> DataFrame:
    """One row (state, run): of the newest Monday run whose probe ran: ok, failed, missing or skipped; pending while the newest Monday run goes on.

    `runs` has (id, created, status), `jobs` (id, name, conclusion). Without a Monday run there is no state.
    """
    monday = runs.withColumn("at", F.try_to_timestamp("created")).where(F.weekday("at") == 0)
    own = jobs.where(F.col("name") == job).groupBy("id").agg(F.first("conclusion").alias("conclusion"), F.lit(True).alias("_there"))
    each = monday.join(own, "id", "left").withColumn("nth", F.struct("at", "id"))
    state = F.when(F.col("_there").isNull(), "missing").when(F.col("conclusion") == "success", "ok").when(F.col("conclusion") == "skipped", F.lit(None)).otherwise("failed")
    one = each.agg(F.max_by("status", "nth").alias("newest"), F.max_by(F.struct(state.alias("state"), "id"), F.when((F.col("status") == "completed") & state.isNotNull(), F.col("nth"))).alias("x"), F.count(F.lit(1)).alias("n"))
    return one.select(F.when(F.col("n") == 0, F.lit(None)).when(F.col("newest") != "completed", "pending").otherwise(F.coalesce("x.state", F.lit("skipped"))).alias("state"), F.when((F.col("newest") == "completed"), F.col("x.id")).alias("run"))


def alert_changes(state: DataFrame, open_: DataFrame) -> DataFrame:
    """(title, change): alerts to open or close. `state` has (title, state: dead, alive or null), `open_` the titles of open issues; a state that isn't known changes nothing."""
    j = state.join(open_.select("title").distinct().withColumn("_open", F.lit(True)), "title", "left")
    change = F.when((F.col("state") == "dead") & F.col("_open").isNull(), "opened").when((F.col("state") == "alive") & F.col("_open").isNotNull(), "closed")
    return j.select("title", change.alias("change")).where("change is not null")


def recovered(open_: DataFrame, checked: DataFrame, hard: DataFrame, prefix: str) -> DataFrame:
    """(title) of open alerts whose provider this run checked and found without a hard failure."""
    own = open_.where(F.col("title").startswith(prefix)).withColumn("provider", F.substring("title", len(prefix) + 1, 1 << 20))
    return own.join(checked, "provider", "left_semi").join(hard.select("provider"), "provider", "left_anti").select("title")


def pings(now: DataFrame, before: DataFrame, open_: DataFrame, prefix: str) -> DataFrame:
    """(provider, title) of providers that failed hard in both runs and have no open alert."""
    both = now.select("provider").distinct().join(before.select("provider").distinct(), "provider", "left_semi").withColumn("title", F.concat(F.lit(prefix), "provider"))
    return both.join(open_.select("title"), "title", "left_anti").select("provider", "title")


def pending_rows(lines: DataFrame, landed: DataFrame, fault: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, held): of the lines that open branches append and the log doesn't have, the valid ones, and the keys of all.

    A refused line gives no row, but its key is held all the same. `lines` has (branch, path, pos, line, source, model_id, ...).
    """
    fresh = lines.join(landed.select("path", "line").distinct(), ["path", "line"], "left_anti").withColumn("_fault", fault)
    return fresh.where("_fault is null").drop("_fault"), fresh.select("source", "model_id").distinct()


def skips_by_run(lines: DataFrame, message: Column, run: str = "run") -> DataFrame:
    """(run, provider, skips): how often a run's detection left something out; where it did, absence can't be told and counters stand still."""
    said = r"^detect skip for (\S+):"
    return lines.where(message.rlike(said)).groupBy(run, F.regexp_extract(message, said, 1).alias("provider")).agg(F.count(F.lit(1)).alias("skips"))


def channel_update(snapshot: DataFrame, fetched: DataFrame, now: str) -> DataFrame:
    """(source, url, sha, text, fetched, change) after a pass: `fetched` has (source, url, sha, text; sha null where the fetch failed).

    A failed fetch keeps the old entry; the time moves only with the hash; `change` tells which channels differ from what was committed.
    Channels that weren't fetched at all are gone.
    """
    old = snapshot.select("source", "url", F.col("sha").alias("o_sha"), F.col("text").alias("o_text"), F.col("fetched").alias("o_at"))
    j = fetched.join(old, ["source", "url"], "left")
    failed = F.col("sha").isNull()
    same = F.col("sha") == F.col("o_sha")
    at = F.when(failed | F.coalesce(same, F.lit(False)), F.col("o_at")).otherwise(F.lit(now))
    change = ~failed & F.col("o_sha").isNotNull() & ~same
    return j.where(~failed | F.col("o_sha").isNotNull()).select("source", "url", F.coalesce("sha", "o_sha").alias("sha"), F.when(failed, F.col("o_text")).otherwise(F.col("text")).alias("text"), at.alias("fetched"), F.coalesce(change, F.lit(False)).alias("change"))
