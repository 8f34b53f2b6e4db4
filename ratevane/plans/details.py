"""Queries of what the published page shows of entries (intervals, rates, charts, orders, searches) and of ids and channels that can't be taken up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import page
from ..operators import candidates, catalog, rates, review
from ..operators.log import partition_view
from ..operators.positions import places_in
from ..schema import AXES, OVERRIDES, RATES
from ..sources.observations import observations, table
from . import publish
from .more import _CHAIN, _CHANNELS, _FLAT, _ROWS, _charts, _flat

QUERIES, SQL = {}, {}
c, lit = F.col, F.lit


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return put


@query(f"WITH {_ROWS}, {_CHAIN} SELECT source, model_id, valid_from, CASE WHEN e IS NOT NULL THEN greatest(e, valid_from) END AS valid_to, observed_at, r AS input, CASE WHEN removed THEN true END AS removed, CASE WHEN k % 2 = 0 THEN 'EUR' END AS currency, CASE WHEN k % 3 = 1 THEN CAST(k AS BIGINT) END AS context FROM ended")
def published_intervals(spark, sf_dir):
    """Every interval of every published entry, empty ones too."""
    each = _flat(spark, sf_dir).select("source", "model_id", F.explode("intervals").alias("i"))
    return each.select("source", "model_id", "i.valid_from", "i.valid_to", "i.observed_at", c("i.rates.input").alias("input"), "i.removed", "i.currency", c("i.limits.context").alias("context"))


@query(f"WITH {_FLAT} SELECT source, model_id, input, '—' AS cached, '—' AS output FROM flat")
def static_rates(spark, sf_dir):
    """The rates in a row of the static page; a rate's text reads back as the same number."""
    cells = F.regexp_extract_all("row", lit("<td>(.*?)</td>"), lit(1))
    rows = publish.static_rows(_flat(spark, sf_dir)).select("source", "model_id", F.slice(cells, -3, 3).alias("x"))
    return rows.select("source", "model_id", F.get("x", 0).try_cast("double").alias("input"), F.get("x", 1).alias("cached"), F.get("x", 2).alias("output"))


_STEPS = f"""WITH {_ROWS}, {_CHAIN},
p AS (SELECT source, model_id, run, observed_at, pos, valid_from, valid_to, CAST(r AS DOUBLE) AS v FROM runs WHERE NOT gap),
g AS (SELECT source, model_id, min(run) AS first, min(valid_from) AS start, CASE WHEN count(*) FILTER (valid_to IS NULL) > 0 THEN '2024-02-05' ELSE max(valid_to) END AS finish, greatest(max(v), 0) AS top, min(v) = greatest(max(v), 0) AS flat FROM p GROUP BY 1, 2),
o AS (SELECT p.*, start, top, flat, CAST(greatest(date_diff('day', CAST(start AS DATE), CAST(finish AS DATE)), 1) AS DOUBLE) AS span, coalesce(valid_to, finish) AS stop, row_number() OVER w AS n, lead(valid_from) OVER w AS next FROM p JOIN g ON p.source = g.source AND p.model_id = g.model_id AND p.run = g.first WINDOW w AS (PARTITION BY p.source, p.model_id ORDER BY valid_from, observed_at, pos)),
y AS (SELECT *, CASE WHEN flat THEN 50e0 WHEN top > 0 THEN 100 - v / top * 100 ELSE 100e0 END AS h FROM o),
q AS (SELECT source, model_id, 2 * n - 2 AS corner, valid_from AS d, span, start, h FROM y UNION ALL SELECT source, model_id, 2 * n - 1, coalesce(next, stop), span, start, h FROM y)
SELECT source, model_id, CAST(corner AS INT) AS corner, floor(least(100e0, greatest(0e0, CAST(date_diff('day', CAST(start AS DATE), CAST(d AS DATE)) AS DOUBLE) / span * 100)) * 100 + 0.5e0) / 100 AS x, floor(h * 100 + 0.5e0) / 100 AS y FROM q"""


@query(_STEPS)
def chart_lines(spark, sf_dir):
    """The corners of every chart's first line, read back from its text."""
    got, first = _charts(spark, sf_dir), F.get("runs", 0)
    line = page.polyline(first["points"], first["end"], c("start"), F.coalesce("finish", lit("2024-02-05")), c("top"), c("flat"))
    each = got.select("source", "model_id", F.posexplode(F.split(line, " ")).alias("corner", "t"))
    part = lambda i: F.get(F.split("t", ","), i).cast("double")
    return each.select("source", "model_id", "corner", part(0).alias("x"), part(1).alias("y"))


NEEDLES = ("", "  ", "#00000001", " CuStOmEr#0000", "canada", "FRANCE ", "%", "_", "nothing like it")
_SHOWN = " UNION ALL ".join(f"SELECT '{n}' AS needle, count(*) AS shown, min(c_custkey) AS least, max(c_custkey) AS most FROM e WHERE trim('{n}') = '' OR contains(lower(c_name), lower(trim('{n}'))) OR contains(lower(coalesce(n_name, '')), lower(trim('{n}')))" for n in NEEDLES)


@query(f"WITH e AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 > 0 THEN n_name END AS n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) {_SHOWN}")
def shown_entries(spark, sf_dir):
    """How many entries each search shows, by name or vendor, and the first and last of them; one pass over the entries."""
    named = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey")).select("c_custkey", "c_name", F.when(c("c_custkey") % 5 > 0, c("n_name")).alias("vendor"))
    here = lambda n: F.when(page.found(lit(n), c("c_name"), c("vendor")), c("c_custkey"))
    each = F.array(*[F.struct(lit(n).alias("needle"), F.count(here(n)).alias("shown"), F.min(here(n)).alias("least"), F.max(here(n)).alias("most")) for n in NEEDLES])
    return named.agg(each.alias("e")).select(F.inline("e"))


def _windowed(spark, sf_dir):
    """Parts with base rates and overrides: a clock window prices audio and may price more than the base, a mode never counts."""
    s = c("p_size")
    own = lambda **axes: F.struct(*[axes.get(a, lit(None)).cast("double").alias(a) for a in AXES]).cast(RATES)
    when = lambda window, mode: F.struct(lit(None).cast("array<string>").alias("days"), window.cast("array<int>").alias("window"), lit("UTC").alias("timezone"), lit(None).cast("bigint").alias("min_tokens"), mode.cast("string").alias("mode"))
    entry = lambda w, m, r: F.struct(when(w, m).alias("when"), r.alias("rates"), lit(None).cast("double").alias("quota_multiplier"))
    clock = F.when(s % 3 == 0, entry(F.array(lit(100), lit(400)), lit(None), own(audio=s / 4, input=F.when(s % 2 == 0, s * 2))))
    mode = F.when(s % 5 == 0, entry(lit(None), lit("fast"), own(image=s, input=s * 9)))
    overrides = F.array_compact(F.array(clock, mode)).cast(OVERRIDES)
    return table(spark, sf_dir, "part").select("p_partkey", F.when(s % 7 > 0, own(input=s, output=F.when(s % 4 > 0, s * 3))).alias("rates"), F.when(s % 11 > 0, overrides).alias("overrides"), F.when(s % 6 > 0, c("p_brand")).alias("vendor"), F.when(s % 8 > 0, c("p_name")).alias("name"), text_key().alias("model_id"))


def text_key():
    return F.concat(lit("ID"), c("p_partkey").cast("string"))


_PEAK = "b AS (SELECT p_partkey, p_size AS s, p_brand, p_name, p_size % 7 > 0 AS based, p_size % 3 = 0 AND p_size % 11 > 0 AS timed FROM part)"


@query(f"WITH {_PEAK} SELECT p_partkey, concat_ws(',', CASE WHEN based OR (timed AND s % 2 = 0) THEN 'input' END, CASE WHEN based AND s % 4 > 0 THEN 'output' END, CASE WHEN timed THEN 'audio' END) AS axes FROM b")
def peak_axes(spark, sf_dir):
    return _windowed(spark, sf_dir).select("p_partkey", F.array_join(rates.priced_axes(c("rates"), c("overrides")), ",").alias("axes"))


_VALUES = "v AS (SELECT p_partkey, s, CASE WHEN timed AND s % 2 = 0 THEN CAST(s * 2 AS DOUBLE) WHEN based THEN CAST(s AS DOUBLE) END AS peak, CASE WHEN s % 6 > 0 THEN lower(p_brand) END AS vendor, lower(CASE WHEN s % 8 > 0 THEN p_name ELSE 'ID' || p_partkey END) AS name FROM b)"


@query(f"WITH {_PEAK}, {_VALUES} SELECT p_partkey, CAST(row_number() OVER (ORDER BY peak DESC NULLS LAST, p_partkey) AS INT) AS by_peak, CAST(row_number() OVER (ORDER BY vendor NULLS LAST, p_partkey) AS INT) AS by_vendor, CAST(row_number() OVER (PARTITION BY s % 2 ORDER BY name DESC NULLS LAST, p_partkey) AS INT) AS by_name FROM v")
def sorted_entries(spark, sf_dir):
    """Places of entries by their peak rate falling, by vendor rising and, in two groups, by name falling; a missing fact is last in either direction."""
    rows = _windowed(spark, sf_dir)
    entry = {x: c(x) for x in ("rates", "overrides", "vendor", "name", "model_id")}
    keys = rows.select("p_partkey", lit(0).alias("all"), page.sort_value(entry, "input", True).alias("peak"), page.sort_value(entry, "vendor", False).alias("vendor"), page.sort_value(entry, "name", False).alias("name"))
    keys = keys.join(table(spark, sf_dir, "part").select("p_partkey", (c("p_size") % 2).alias("half")), "p_partkey")
    one = places_in(keys, ["all"], [c("peak").desc_nulls_last(), c("p_partkey")], "by_peak")
    two = places_in(one, ["all"], [c("vendor").asc_nulls_last(), c("p_partkey")], "by_vendor")
    return places_in(two, ["half"], [c("name").desc_nulls_last(), c("p_partkey")], "by_name").select("p_partkey", "by_peak", "by_vendor", "by_name")


_KNOWN = f"""{_ROWS}, newest AS (SELECT source, model_id, u, arg_max(removed, (observed_at, pos)) AS gone FROM obs GROUP BY 1, 2, 3)"""


@query(f"WITH {_KNOWN} SELECT source, CASE WHEN u % 2 = 0 THEN 'page-' ELSE '' END || model_id AS model_id, model_id AS stored, CASE WHEN gone THEN 'removed' ELSE 'covered' END AS why FROM newest WHERE gone OR u % 3 = 0")
def refused_ids(spark, sf_dir):
    """Ids that pages price and none detects, against the log's newest rows and the keys that detected ids refresh; ids without a row are new."""
    newest = partition_view(observations(spark, sf_dir), c("rate_input")).select("source", "model_id", c("newest_removed").alias("removed"))
    even = c("model_id").cast("int") % 2 == 0
    known = newest.select("source", F.when(even, F.concat(lit("page-"), "model_id")).otherwise(c("model_id")).alias("model_id"), c("model_id").alias("stored"))
    fresh = newest.select("source", F.concat(lit("new-"), "model_id").alias("model_id"), F.concat(lit("new-"), "model_id").alias("stored"))
    return candidates.refused(known.unionByName(fresh), newest, newest.where(c("model_id").cast("int") % 3 == 0))


@query(f"WITH {_KNOWN} SELECT source, model_id, source || '/' || model_id AS canonical FROM newest WHERE u % 3 > 0")
def seeded_entries(spark, sf_dir):
    """Seeds of keys that no entry claims, beside a catalog whose names none of them takes."""
    keys = observations(spark, sf_dir).select("source", "model_id").distinct()
    claimed = keys.where(c("model_id").cast("int") % 3 == 0)
    return catalog.seeds(keys, claimed, claimed.select(F.concat_ws("/", "source", "model_id").alias("canonical")))


@query("SELECT page_id AS number, source, url FROM (SELECT page_id, 's' || page_id % 3 AS source, unnest(['https://h/a/x', 'https://h/b/x', 'https://h/y?q']) AS url FROM pages) WHERE CASE page_id % 4 WHEN 0 THEN url LIKE '%x' WHEN 1 THEN url = 'https://h/b/x' WHEN 2 THEN url LIKE '%y%' ELSE false END")
def changed_channels(spark, sf_dir):
    """Channels that requests' own commits changed, from the files they touched: two channels of an index share a slug, a deleted one's file is none."""
    n = c("page_id")
    base = table(spark, sf_dir, "pages").select(n.alias("number"), F.concat(lit("s"), (n % 3).cast("string")).alias("source"), (n % 4).alias("k"))
    urls = ("https://h/a/x", "https://h/b/x", "https://h/y?q")
    branches = base.select("number", "source", F.explode(F.array(*map(lit, urls))).alias("url"))
    file = lambda name: F.concat(lit("state/announce/"), c("source"), lit(f"/{name}.md"))
    coded = lambda u: F.concat(lit("state/announce/"), c("source"), lit("/x-"), F.substring(F.sha2(lit(u), 256), 1, 8), lit(".md"))
    touched = F.when(c("k") == 0, F.array(coded(urls[0]), coded(urls[1]))).when(c("k") == 1, F.array(coded(urls[1]), file("gone"))).when(c("k") == 2, F.array(file("y"), file("y"))).otherwise(F.array(file("x"), lit("else/y.md")))
    return review.changed_channels(branches, base.select("number", F.explode(touched).alias("path")))


_SHARED = _CHANNELS.replace("page_id % 40", "page_id % 37")
assert _SHARED != _CHANNELS


@query(f"WITH {_SHARED} SELECT br.number FROM br LEFT JOIN base USING (source, url) LEFT JOIN newest USING (source, url) WHERE br.n = 1 AND br.number % 6 <> 0 AND br.number % 13 <> 0 AND (coalesce(br.sha = base.sha OR base.fetched >= br.fetched, false) OR coalesce(newest.number % 5 = 0, false))")
def settled_shared(spark, sf_dir):
    """Requests with a no whose changed channels are settled, where requests and the base share urls; some changed none, some have no readable index."""
    n = c("page_id")
    rows = table(spark, sf_dir, "pages").select(n.alias("number"), F.concat(lit("s"), (n % 3).cast("string")).alias("source"), F.concat(lit("u"), (n % 37).cast("string")).alias("url"), (n % 7).alias("sha"), (n % 11).alias("fetched"), (n % 5).alias("n"))
    base = rows.where("number % 4 = 0").groupBy("source", "url").agg(F.max("sha").alias("sha"), F.max("fetched").alias("fetched"))
    branches = rows.where("number % 4 <> 0")
    bound = branches.select("number", F.when(c("n") == 0, "yes").when(c("n") == 1, "no").alias("verdict"))
    times = branches.select("number", F.when(c("n") < 4, c("n").cast("string")).otherwise("").alias("at"))
    return review.settled(base, branches.drop("n"), branches.where("number % 6 <> 0"), bound, times, branches.select("number", (c("number") % 13 == 0).alias("unread")))
