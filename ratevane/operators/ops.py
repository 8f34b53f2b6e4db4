"""Run logs, verdicts and published channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The messages that run logs carry, matched at a message's start, first rule first. (pattern, class, key or None: the pattern's group)
RULES = (
    (r"detector for (\S+) failed", "hard", None),
    (r"scraper module for (\S+) failed", "hard", None),
    (r"priced detection for (\S+) failed", "hard", None),
    (r"scraper (\S+) failed for \S+", "hard", None),
    (r"refresh scrape failed for \S+ \((\S+)\)", "hard", None),
    (r"openrouter fetch failed", "hard", "openrouter"),
    (r"priced none of the tried ids for (\S+):", "hard", None),
    (r"entry \S+ failed validation for (\S+):", "soft", None),
    (r"entry \S+ failed row build for (\S+):", "soft", None),
    (r"parse skip for (\S+):", "soft", None),
    (r"refresh for \S+ skipped in (\S+):", "soft", None),
    (r"fast-mode name .* names no model in the pricing table for (\S+) on \S+$", "soft", None),
    (r"detect skip for (\S+):", "soft", None),
)
PREFIX = r"^(?:[^\t\n]*\t[^\t\n]*\t\S+ )?[A-Z]+:[\w.]+:"


def message(line: Column) -> Column:
    """What stands after a log line's prefixes; null for a line without them, as of a traceback."""
    return F.when(line.rlike(PREFIX), F.regexp_replace(line, PREFIX, ""))


def issues(lines: DataFrame, line: str = "line") -> DataFrame:
    """`lines` that report an issue, with provider and class: of the first rule that the message meets."""

    def first_rule(m: Column) -> Column:
        met = [F.when(m.rlike("^" + p), F.struct((F.lit(fixed) if fixed else F.regexp_extract(m, "^" + p, 1)).alias("provider"), F.lit(c).alias("class"))) for p, c, fixed in RULES]
        return F.coalesce(*met)

    once = F.transform(F.array(message(F.col(line))), first_rule)  # a lambda's argument is computed once, not for every rule
    return lines.withColumn("_i", F.get(once, 0)).where("_i is not null").select(*lines.columns, "_i.provider", "_i.class")


def issue_summary(found: DataFrame) -> DataFrame:
    """One row for each provider: its hard and soft counts; `level` is hard if there is any hard issue."""
    g = found.groupBy("provider").agg(F.count_if(F.col("class") == "hard").alias("hard"), F.count_if(F.col("class") == "soft").alias("soft"))
    return g.withColumn("level", F.when(F.col("hard") > 0, "hard").otherwise("soft"))


def last_errors(found: DataFrame, n: int = 6, order: str = "pos") -> DataFrame:
    """The last `n` hard lines of each provider; `back` counts from the end."""
    w = Window.partitionBy("provider").orderBy(F.col(order).desc())
    return found.where("class = 'hard'").withColumn("back", F.row_number().over(w)).where(F.col("back") <= n)


def verdict_line(body: Column) -> Column:
    """The last line that is a verdict, as (said, stamp): a stamp has 7 to 64 hexadecimal digits; null without such a line."""
    line = r"^\s*automerge: (yes|no)(?: ([0-9a-f]{7,64}))?\s*$"
    found = F.try_element_at(F.filter(F.split(body, "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"), lambda x: x.rlike(line)), F.lit(-1))
    return F.when(found.isNotNull(), F.struct(F.regexp_extract(found, line, 1).alias("said"), F.nullif(F.regexp_extract(found, line, 2), F.lit("")).alias("stamp")))


def verdicts(comments: DataFrame, bot: str, head: str = "head", order: str = "pos") -> DataFrame:
    """(number, verdict, stamp, bound): the bot's last comment with a verdict stands; a stamp other than the head leaves no verdict."""
    parsed = comments.where(F.col("author") == bot).withColumn("_v", verdict_line(F.col("body"))).where("_v is not null")
    one = parsed.groupBy("number", head).agg(F.max_by("_v", order).alias("x"))
    bound = F.col("x.stamp").isNotNull() & (F.col("x.stamp") == F.col(head)) & (F.col(head) != "")
    return one.select("number", F.when(bound, F.col("x.said")).alias("verdict"), F.col("x.stamp").alias("stamp"), F.coalesce(bound, F.lit(False)).alias("bound"))


def warning(found: DataFrame) -> DataFrame:
    """One row, if there is any issue: providers with hard failures, then those that only skip, as one escaped command."""
    from ..functions.text import command

    g = issue_summary(found).agg(F.array_sort(F.collect_list(F.when(F.col("level") == "hard", F.col("provider")))).alias("hard"), F.array_sort(F.collect_list(F.when(F.col("level") == "soft", F.col("provider")))).alias("soft"))
    parts = F.concat_ws("; ", F.when(F.size("hard") > 0, F.concat(F.lit("hard failures: "), F.array_join("hard", ", "))), F.when(F.size("soft") > 0, F.concat(F.lit("skips: "), F.array_join("soft", ", "))))
    return g.where(parts != "").select(F.concat(F.lit("::warning::"), command(parts)).alias("warning"))


def channel_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(source, url, change): urls added, removed or of another hash between two snapshots."""
    a, b = before.select("source", "url", F.col("sha").alias("old")), after.select("source", "url", F.col("sha").alias("new"))
    both = a.join(b, ["source", "url"], "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("source", "url", change.alias("change"))


def resolved_channels(base: DataFrame, branches: DataFrame) -> DataFrame:
    """(source, url, sha, fetched) after branches land: the newest fetch wins, the base wins ties with a branch, the newest branch ties among branches."""
    held_ = base.select("source", "url", "sha", "fetched", F.lit(True).alias("from_base"), F.lit(None).cast("bigint").alias("number"))
    rows = held_.unionByName(branches.select("source", "url", "sha", "fetched", F.lit(False).alias("from_base"), F.col("number").cast("bigint").alias("number")))
    best = F.max_by(F.struct("sha", "fetched", "from_base"), F.struct("fetched", "from_base", "number"))
    return rows.groupBy("source", "url").agg(best.alias("x")).select("source", "url", "x.sha", "x.fetched", "x.from_base")
