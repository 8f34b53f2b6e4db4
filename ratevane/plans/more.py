"""Queries of row building, publishing, review, page texts and pages of sources, with SQL of the same meaning where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import literals, mentions, money, page
from ..operators import build, contract, ops, review, runs, temporal
from ..operators.positions import places_in
from ..schema import AXES, OVERRIDES, RATES
from ..sources import registry
from ..sources.observations import observations, table
from . import publish

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
c, lit = F.col, F.lit


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def _rates(**axes):
    return F.struct(*[axes.get(a, lit(None)).cast("double").alias(a) for a in AXES]).cast(RATES)


def scraped(spark, sf_dir):
    """A scraped price for each part: quotes in three currencies, peak costs on two windows, none or no schedule, an entry for long prompts."""
    k, size, price = c("p_partkey"), c("p_size"), c("p_retailprice")
    entry = F.struct(lit(None).cast("array<string>").alias("days"), lit(None).cast("array<int>").alias("window"), (size * 1000).cast("bigint").alias("min_tokens"), lit(None).cast("string").alias("mode"), F.when(size % 2 == 0, 0.5).alias("quota_multiplier"), _rates(input=price / 500).alias("rates"))
    return table(spark, sf_dir, "part").select(
        lit("s").alias("source"),
        k.cast("string").alias("model_id"),
        _rates(input=price / 1e9, output=size / 1e7, cache_read=F.when(size % 4 == 0, size / 1e8)).alias("costs"),
        F.when(size % 3 < 2, _rates(input=price / 5e8)).alias("peak_costs"),
        F.when(size % 3 == 0, F.array(F.array(lit(100), lit(400)), F.array(lit(600), lit(1000)))).alias("peak_windows"),
        F.when(size % 6 == 0, F.array(lit("monday"), lit("friday"))).alias("peak_days"),
        F.when(size % 5 == 0, F.array(entry)).cast(build.WINDOW_RATES).alias("window_rates"),
        lit("UTC").alias("timezone"),
        F.when(size % 7 == 0, F.struct(lit(0.01).alias("web_search"), lit(None).cast("double").alias("search"), lit(None).cast("double").alias("fetch"))).alias("fees"),
        F.struct((size * 1024).cast("bigint").alias("context"), F.when(size % 2 == 0, 0).cast("bigint").alias("output")).alias("limits"),
        F.when(size % 9 == 0, "2026-01-01").alias("effective_at"),
        F.when(k % 3 == 0, "EUR").when(k % 3 == 1, "DBU").otherwise("USD").alias("currency"),
        lit("tokens").alias("unit"),
        F.when(size % 2 == 0, "").otherwise("https://own.example").alias("url"),
    )


def _quotes(spark, sf_dir):
    fx = spark.createDataFrame([("EUR", "2026-01-05", 1.25), ("EUR", "2026-02-01", 1.5), ("EUR", "2026-03-01", 9.0)], "currency string, day string, rate double")
    own = spark.createDataFrame([("s", 0.07)], "source string, currency_rate double")
    return build.resolved(scraped(spark, sf_dir).withColumn("observed_at", lit("2026-02-10")), fx, own)


_FACTOR = "CASE p_partkey % 3 WHEN 0 THEN 1.5e0 WHEN 1 THEN 0.07e0 END"


@query(
    f"""WITH f AS (SELECT *, {_FACTOR} AS fx, coalesce({_FACTOR}, 1e0) AS m FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS model_id, CASE p_partkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'DBU' END AS currency, fx AS fx_rate, CASE p_partkey % 3 WHEN 0 THEN '2026-02-01' WHEN 1 THEN '2026-02-10' END AS fx_rate_date,
round(p_retailprice / 1e9 * m * 1e6, 6) AS input, round(p_size / 1e7 * m * 1e6, 6) AS output, CASE WHEN p_size % 4 = 0 THEN round(p_size / 1e8 * m * 1e6, 6) END AS cache_read,
CAST(CASE WHEN p_size % 3 = 0 THEN 2 WHEN p_size % 3 = 1 THEN 1 ELSE 0 END + CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS INT) AS n_overrides,
CASE WHEN p_size % 3 < 2 THEN round(p_retailprice / 5e8 * m * 1e6, 6) WHEN p_size % 5 = 0 THEN round(p_retailprice / 500 * m, 6) END AS first_rate,
CASE WHEN p_size % 3 = 0 OR (p_size % 3 = 2 AND p_size % 5 = 0) THEN 'UTC' END AS zone, CASE WHEN p_size % 5 = 0 THEN p_size * 1000 END AS bound, CASE WHEN p_size % 10 = 0 THEN 0.5e0 END AS multiplier,
CASE WHEN p_size % 7 = 0 THEN 0.01e0 END AS fee, p_size * 1024 AS context, CASE WHEN p_size % 9 = 0 THEN '2026-01-01' END AS effective_at, CASE WHEN p_size % 2 = 0 THEN 'page' ELSE 'https://own.example' END AS url FROM f"""
)
def row_build(spark, sf_dir):
    rows = build.price_rows(_quotes(spark, sf_dir), "2026-02-10", "page")
    first, last = F.get("overrides", 0), F.try_element_at(c("overrides"), lit(-1))
    return rows.select("model_id", "currency", "provenance.fx_rate", "provenance.fx_rate_date", "rates.input", "rates.output", "rates.cache_read", F.coalesce(F.size("overrides"), lit(0)).alias("n_overrides"), first["rates"]["input"].alias("first_rate"), first["when"]["timezone"].alias("zone"), last["when"]["min_tokens"].alias("bound"), last["quota_multiplier"].alias("multiplier"), c("fees.web_search").alias("fee"), "limits.context", "effective_at", "provenance.url")


@query(
    f"""WITH f AS (SELECT *, {_FACTOR} AS fx, coalesce({_FACTOR}, 1e0) AS m FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS model_id, '2026-03-01' AS observed_at, true AS removed, round(p_retailprice / 1e9 * m * 1e6, 6) AS input, CASE WHEN p_size % 3 = 0 OR (p_size % 3 = 2 AND p_size % 5 = 0) THEN 'UTC' END AS zone, fx AS fx_rate, CASE WHEN p_size % 7 = 0 THEN 0.01e0 END AS fee FROM f"""
)
def removal_build(spark, sf_dir):
    rows = build.price_rows(_quotes(spark, sf_dir), "2026-02-10", "page")
    zoned = F.transform("overrides", lambda o: F.when(o["when"]["timezone"].isNotNull(), o.withField("when", o["when"].withField("timezone", lit("Asia/Singapore")))).otherwise(o))
    gone = build.removal_rows(rows.withColumn("overrides", zoned), "2026-03-01")
    return gone.select("model_id", "observed_at", "removed", "rates.input", F.get("overrides", 0)["when"]["timezone"].alias("zone"), "provenance.fx_rate", c("fees.web_search").alias("fee"))


def contract_rows(spark, sf_dir):
    """The log as rows of the contract; every fourth has a modality, every third a name of its source's."""
    k = c("k")
    o = observations(spark, sf_dir)
    return o.select(
        "pos", lit(4).alias("schema"), "source", "model_id", "observed_at", F.when(c("model_id").cast("int") % 4 == 0, "image").alias("modality"), "effective_at", F.when(c("removed"), True).alias("removed"), F.when(k % 2 == 0, "EUR").alias("currency"), _rates(input=c("rate_input")).alias("rates"),
        lit(None).cast(OVERRIDES).alias("overrides"), lit(None).cast("struct<web_search:double,search:double,fetch:double>").alias("fees"), F.when(k % 3 == 1, F.struct(k.cast("bigint").alias("context"), lit(None).cast("bigint").alias("output"))).alias("limits"), lit(None).cast("string").alias("unmapped"),
        F.when(k % 3 == 0, F.struct(lit("u").alias("url"), F.concat(lit("n"), k.cast("string")).alias("name"), lit(None).cast("double").alias("fx_rate"), lit(None).cast("string").alias("fx_rate_date"))).alias("provenance"),
    )


def catalog_rows(spark, sf_dir):
    u = table(spark, sf_dir, "events").select(c("user_id").alias("u"), c("event_type").alias("source")).where("u % 3 = 0").distinct()
    return u.select(F.concat(lit("m"), (c("u") % 7).cast("string")).alias("canonical"), F.when(c("u") % 2 == 0, F.concat(lit("N"), (c("u") % 7).cast("string"))).alias("name"), F.concat(lit("v"), (c("u") % 7).cast("string")).alias("vendor"), (c("u") % 7 < 3).alias("curated"), "source", c("u").cast("string").alias("model_id"))


_ROWS = """obs AS (SELECT event_type AS source, CAST(user_id AS VARCHAR) AS model_id, user_id AS u, event_id AS pos, strftime(ts, '%Y-%m-%d') AS observed_at, k, k % 10 = 0 AS removed, value AS r,
CASE WHEN k % 3 = 0 THEN 'n' || k END AS quoted FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""
_FLAT = f"""{_ROWS}, g AS (SELECT source, model_id, u, min(observed_at) AS first_seen, count(*) AS items, max(observed_at) AS newest, arg_max(removed, (observed_at, pos)) AS gone,
coalesce(arg_max(pos, (observed_at, pos)) FILTER (NOT removed), arg_max(pos, (observed_at, pos))) AS base FROM obs GROUP BY 1, 2, 3),
flat AS (SELECT g.source, g.model_id, g.u, first_seen, items, newest, CASE WHEN gone THEN newest END AS removed_at, CASE WHEN g.u % 3 = 0 THEN 'v' || g.u % 7 END AS vendor,
coalesce(CASE WHEN g.u % 6 = 0 THEN 'N' || g.u % 7 END, b.quoted, g.model_id) AS name, b.observed_at, b.r AS input, CASE WHEN b.k % 2 = 0 THEN 'EUR' END AS currency, CASE WHEN g.u % 4 = 0 THEN 'image' END AS modality FROM g JOIN obs b ON b.pos = g.base)"""


def _flat(spark, sf_dir):
    return publish.entries(publish.required(contract_rows(spark, sf_dir)), catalog_rows(spark, sf_dir))


@query(f"WITH {_FLAT} SELECT source, model_id, vendor, name, observed_at, input, currency, modality, first_seen, removed_at, items FROM flat")
def published_entries(spark, sf_dir):
    return _flat(spark, sf_dir).select("source", "model_id", "vendor", "name", "observed_at", "rates.input", "currency", "modality", "first_seen", "removed_at", F.size("intervals").cast("bigint").alias("items"))


@query(f"WITH {_FLAT} SELECT source AS scope, 4 AS version, 3 AS flat_version, max(newest) AS updated_at, count(*) AS entries FROM flat GROUP BY GROUPING SETS ((), (source))")
def published_heads(spark, sf_dir):
    return publish.heads(_flat(spark, sf_dir), 4)


@query(f"WITH {_FLAT} SELECT source, model_id, name FROM flat WHERE modality IS NULL")
def second_export(spark, sf_dir):
    made = publish.second_version(_flat(spark, sf_dir))
    assert "modality" not in made.columns
    return made.select("source", "model_id", "name")


@query(f"WITH {_FLAT} SELECT source, model_id, first_seen, input FROM flat")
def index_entries(spark, sf_dir):
    rows = publish.index(_flat(spark, sf_dir))
    return rows.select("source", "model_id", F.get_json_object("entry", "$.first_seen").alias("first_seen"), F.get_json_object("entry", "$.rates.input").cast("double").alias("input"))


@query(f"WITH {_ROWS} SELECT pos, CAST(row_number() OVER (PARTITION BY source ORDER BY model_id, observed_at, pos) AS INT) AS place, source, model_id, observed_at FROM obs")
def merged_history(spark, sf_dir):
    """Places inside a source of the merged history's order; the sink writes the lines in range partitions."""
    rows = contract_rows(spark, sf_dir)
    return places_in(rows.select("pos", "source", "model_id", "observed_at"), ["source"], ["model_id", "observed_at", "pos"])


@query("SELECT DISTINCT event_type AS source, 'rows only' AS side FROM events WHERE event_type NOT IN (SELECT lower(o_orderpriority) FROM orders) UNION ALL SELECT DISTINCT lower(o_orderpriority), 'files only' FROM orders WHERE lower(o_orderpriority) NOT IN (SELECT event_type FROM events)")
def source_agreement(spark, sf_dir):
    return publish.agrees(observations(spark, sf_dir), table(spark, sf_dir, "orders").select(F.lower("o_orderpriority").alias("source")))


@query(f"WITH {_ROWS} SELECT count(DISTINCT source || '/' || model_id) AS models, count(DISTINCT source) AS sources, count(*) AS rows, min(observed_at) AS first_seen, CAST(date_diff('day', min(CAST(observed_at AS DATE)), max(CAST(observed_at AS DATE))) + 1 AS BIGINT) AS days, (SELECT count(DISTINCT u % 7) FROM obs WHERE u % 3 = 0 AND u % 7 < 3) AS mapped FROM obs")
def published_counts(spark, sf_dir):
    return publish.counts(contract_rows(spark, sf_dir), catalog_rows(spark, sf_dir))


@query(f"WITH {_FLAT} SELECT source, model_id, '<tr data-key=\"' || source || '/' || model_id || '\"><td><span class=\"table-name\">' || name || '</span>' || CASE WHEN removed_at IS NOT NULL THEN ' <span class=\"tag tag-danger\">removed ' || removed_at || '</span>' ELSE '' END || CASE WHEN modality IS NOT NULL THEN ' <span class=\"tag tag-info\">image</span>' ELSE '' END || '<div class=\"td-sub\">' || model_id || '</div></td><td>' || coalesce(vendor, '—') || '</td><td>' || source || '</td>' AS head FROM flat")
def static_page(spark, sf_dir):
    rows = publish.static_rows(_flat(spark, sf_dir))
    return rows.select("source", "model_id", F.regexp_extract("row", "^(.*?</td><td>.*?</td><td>.*?</td>)", 1).alias("head"))


# Page and report texts over parts.
_PART = "SELECT p_partkey, CAST(p_size AS INT) AS s, p_retailprice AS p FROM part"


def _conditions():
    s = c("p_size")
    days = F.when(s % 3 == 0, F.array(lit("monday"), lit("friday")))
    window = F.when(s % 2 == 0, F.array((s * 7).cast("int"), (s * 7 + 100).cast("int")))
    return F.struct(days.alias("days"), window.alias("window"), F.when((s % 2 == 0) | (s % 3 == 0), "UTC").alias("timezone"), F.when(s % 5 == 0, s * 1000).cast("bigint").alias("min_tokens"), F.when(s % 7 == 0, "fast").alias("mode"))


@query(
    f"""WITH x AS ({_PART}), t AS (SELECT *, CASE WHEN s % 2 = 0 OR s % 3 = 0 THEN 'UTC' END AS z FROM x)
SELECT p_partkey, coalesce(nullif(concat_ws(', ', CASE WHEN s % 3 = 0 THEN 'monday, friday' END, CASE WHEN s % 2 = 0 THEN printf('%02d:%02d to %02d:%02d UTC', s * 7 // 60, s * 7 % 60, (s * 7 + 100) // 60, (s * 7 + 100) % 60) END, CASE WHEN s % 5 = 0 THEN 'above ' || s * 1000 || ' tokens' END, CASE WHEN s % 7 = 0 THEN 'mode fast' END, 'schedule zone ' || z), ''), 'any request') AS shown,
coalesce(nullif(concat_ws(' ', CASE WHEN s % 3 = 0 THEN 'monday, friday' END, CASE WHEN s % 2 = 0 THEN printf('%02d:%02d-%02d:%02d', s * 7 // 100, s * 7 % 100, (s * 7 + 100) // 100, (s * 7 + 100) % 100) END, CASE WHEN s % 5 = 0 THEN 'over ' || s * 1000 || ' tokens' END, CASE WHEN s % 7 = 0 THEN 'fast mode' END, z), ''), '—') AS reported FROM t"""
)
def condition_texts(spark, sf_dir):
    w = _conditions()
    return table(spark, sf_dir, "part").select("p_partkey", page.when_text(w).alias("shown"), page.report_when(w).alias("reported"))


@query(f"WITH x AS ({_PART}) SELECT p_partkey, coalesce(nullif(concat_ws(' / ', CASE WHEN s % 2 = 0 THEN 'input ' || s END, CASE WHEN s % 3 = 0 THEN 'cache read ' || printf('%g', s / 8.0) END, CASE WHEN s % 2 = 0 THEN 'cache write ' || printf('%g', s / 8.0) END, CASE WHEN s % 5 = 0 THEN 'output ' || printf('%g', p * 1000) END), ''), 'not carried') AS snapshot, printf('%g', p / 1.25) AS quoted, CASE WHEN s % 2 = 0 THEN printf('%g', s / 8.0) ELSE '—' END AS writes, (s * 10 + s % 7) / 1e6 * p AS flat_rate FROM x")
def report_texts(spark, sf_dir):
    s, p = c("p_size"), c("p_retailprice")
    r = _rates(input=F.when(s % 2 == 0, s), cache_read=F.when(s % 3 == 0, s / 8.0), output=F.when(s % 5 == 0, p * 1000), cache_write=F.when(s % 2 == 0, s / 8.0))
    return table(spark, sf_dir, "part").select("p_partkey", page.removal_text(r).alias("snapshot"), page.quoted(p, lit(1.25)).alias("quoted"), page.cache_writes(r).alias("writes"), page.at_rate(p, s * 10, s % 7).alias("flat_rate"))


@query(f"WITH x AS ({_PART}) SELECT p_partkey, CASE WHEN s % 2 = 0 THEN greatest(p, p * 2) ELSE p END AS peak_input, s % 2 = 0 AS moves, CASE WHEN s % 4 < 2 THEN '1.00×' ELSE printf('%.2f×', 3.0) END AS times, CASE WHEN s % 3 = 0 THEN 12 ELSE 7 END AS tokens FROM x")
def page_values(spark, sf_dir):
    s, p = c("p_size"), c("p_retailprice")
    base = _rates(input=p)
    timed = F.struct(_conditions().alias("when"), _rates(input=p * 2).alias("rates"), lit(None).cast("double").alias("quota_multiplier"))
    over = F.array(timed).cast(OVERRIDES)
    total = F.when(s % 4 < 2, s * 1.0).otherwise(s * 3.0)
    text = F.when(s % 3 == 0, "12.9").when(s % 3 == 1, "-4").otherwise("many")
    return table(spark, sf_dir, "part").select("p_partkey", page.peak_rate(base, over, "input").alias("peak_input"), page.peak_moves(base, over).alias("moves"), page.times(total, s * 1.0).alias("times"), page.token_count(text, lit(7)).cast("int").alias("tokens"))


_CHAIN = """started AS (SELECT *, CASE WHEN removed THEN observed_at WHEN k % 3 = 0 THEN strftime(CAST(observed_at AS DATE) + CAST(k % 7 - 3 AS INTEGER), '%Y-%m-%d') ELSE observed_at END AS valid_from FROM obs),
ended AS (SELECT *, min(valid_from) OVER (PARTITION BY source, model_id ORDER BY observed_at, pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS e FROM started),
solid AS (SELECT *, CASE WHEN e IS NOT NULL THEN greatest(e, valid_from) END AS valid_to FROM ended WHERE e IS NULL OR greatest(e, valid_from) > valid_from),
gaps AS (SELECT *, removed OR r IS NULL AS gap FROM solid), runs AS (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY source, model_id ORDER BY valid_from, observed_at, pos ROWS UNBOUNDED PRECEDING) AS run FROM gaps)"""


def _charts(spark, sf_dir):
    return temporal.charts(temporal.interval_chain(observations(spark, sf_dir)), "rate_input")


@query(f"WITH {_ROWS}, {_CHAIN} SELECT source, model_id, count(DISTINCT run) AS runs, count(*) AS points, min(valid_from) AS start, CASE WHEN count(*) FILTER (valid_to IS NULL) > 0 THEN '2024-02-05' ELSE max(valid_to) END AS finish, greatest(max(r), 0) AS top FROM runs WHERE NOT gap GROUP BY 1, 2")
def chart_domains(spark, sf_dir):
    got = _charts(spark, sf_dir)
    return got.select("source", "model_id", F.size("runs").cast("bigint").alias("runs"), F.aggregate("runs", lit(0).cast("bigint"), lambda n, r: n + F.size(r["points"])).alias("points"), "start", F.coalesce("finish", lit("2024-02-05")).alias("finish"), "top")


@query()
def chart_shapes(spark, sf_dir):
    """The first run's line of every chart, and the chart in words; tested by hand."""
    got = _charts(spark, sf_dir)
    finish = F.coalesce("finish", lit("2024-02-05"))
    first = F.get("runs", 0)
    return got.select("source", "model_id", page.polyline(first["points"], first["end"], c("start"), finish, c("top"), c("flat")).alias("line"), page.chart_text(c("model_id"), "input", c("runs"), lit(False)).alias("said"))


# Review over orders: an order is an open request.
_OPEN = "open_ AS (SELECT o_orderkey AS number, CASE WHEN o_custkey % 4 > 0 THEN 'rows/' ELSE 'else/' END || o_orderkey AS head, 'h' || o_orderkey % 9 AS oid, o_orderstatus AS s, o_orderkey % 7 AS n FROM orders), bound AS (SELECT number, CASE WHEN n % 3 = 0 AND s = 'O' THEN 'yes' WHEN n % 3 = 0 AND s = 'F' THEN 'no' END AS verdict FROM open_)"


def _requests(spark, sf_dir):
    k = c("o_orderkey")
    open_ = table(spark, sf_dir, "orders").select(k.alias("number"), F.concat(F.when(c("o_custkey") % 4 > 0, "rows/").otherwise("else/"), k.cast("string")).alias("head"), F.concat(lit("h"), (k % 9).cast("string")).alias("oid"), "o_orderstatus", (k % 7).alias("n"))
    verdict = F.when((c("n") % 3 == 0) & (c("o_orderstatus") == "O"), "yes").when((c("n") % 3 == 0) & (c("o_orderstatus") == "F"), "no")
    return open_, open_.select("number", verdict.alias("verdict"))


@query(f"WITH {_OPEN} SELECT number, head FROM open_ JOIN bound USING (number) WHERE starts_with(head, 'rows/') AND verdict = 'yes'")
def eligible_requests(spark, sf_dir):
    return review.eligible(*_requests(spark, sf_dir), "rows/")


@query(f"WITH {_OPEN} SELECT number, head FROM open_ JOIN bound USING (number) WHERE starts_with(head, 'rows/') AND (verdict IS NULL OR n = 6) ORDER BY number LIMIT 25")
def awaiting_requests(spark, sf_dir):
    open_, bound = _requests(spark, sf_dir)
    return review.awaiting(open_, bound, "rows/", 25, open_.where("n = 6").select("number"))


@query(f"WITH {_OPEN} SELECT head, 'h' || n AS stamp, oid FROM open_ WHERE starts_with(head, 'rows/') AND s = 'O' AND 'h' || n <> oid")
def stale_requests(spark, sf_dir):
    open_, _ = _requests(spark, sf_dir)
    said = open_.select("number", F.when(c("o_orderstatus") == "O", "yes").otherwise("no").alias("said"), F.concat(lit("h"), c("n").cast("string")).alias("stamp"))
    return review.stale_yeses(open_.select("number", "head", "oid"), said, "rows/")


_CHANNELS = """i AS (SELECT page_id AS number, 's' || page_id % 3 AS source, 'u' || page_id % 40 AS url, page_id % 7 AS sha, page_id % 11 AS fetched, page_id % 5 AS n FROM pages),
base AS (SELECT source, url, max(sha) AS sha, max(fetched) AS fetched FROM i WHERE number % 4 = 0 GROUP BY 1, 2), br AS (SELECT * FROM i WHERE number % 4 <> 0),
car AS (SELECT br.* FROM br LEFT JOIN base USING (source, url) WHERE base.sha IS NULL OR (br.sha <> base.sha AND br.fetched > base.fetched)),
newest AS (SELECT source, url, arg_max(number, (CASE WHEN n < 4 THEN 1 ELSE 0 END, CASE WHEN n < 4 THEN n ELSE 0 END, number)) AS number FROM car GROUP BY 1, 2)"""


def _channels(spark, sf_dir):
    i = c("page_id")
    rows = table(spark, sf_dir, "pages").select(i.alias("number"), F.concat(lit("s"), (i % 3).cast("string")).alias("source"), F.concat(lit("u"), (i % 40).cast("string")).alias("url"), (i % 7).alias("sha"), (i % 11).alias("fetched"), (i % 5).alias("n"))
    base = rows.where("number % 4 = 0").groupBy("source", "url").agg(F.max("sha").alias("sha"), F.max("fetched").alias("fetched"))
    branches = rows.where("number % 4 <> 0")
    bound = branches.select("number", F.when(c("n") == 0, "yes").when(c("n") == 1, "no").alias("verdict"))
    times = branches.select("number", F.when(c("n") < 4, c("n").cast("string")).otherwise("").alias("at"))
    return base, branches.drop("n"), bound, times, branches.select("number", lit(False).alias("unread"))


@query(f"WITH {_CHANNELS} SELECT source, url FROM newest WHERE number % 5 <> 0")
def held_by_verdict(spark, sf_dir):
    return review.held(*_channels(spark, sf_dir))


@query(f"WITH {_CHANNELS} SELECT br.number FROM br LEFT JOIN base USING (source, url) LEFT JOIN newest USING (source, url) WHERE br.n = 1 AND (coalesce(br.sha = base.sha OR base.fetched >= br.fetched, false) OR coalesce(newest.number % 5 = 0, false))")
def settled_requests(spark, sf_dir):
    base, branches, bound, times, candidates = _channels(spark, sf_dir)
    return review.settled(base, branches, branches, bound, times, candidates)


@query("WITH l AS (SELECT event_id AS pos, user_id % 5 AS path, CAST(user_id % 50 AS VARCHAR) AS line, event_type AS source, CAST(user_id AS VARCHAR) AS model_id, event_id % 2 = 0 AS landed FROM events) SELECT source, count(*) AS appended, count(*) FILTER (model_id NOT LIKE '%3') AS valid FROM l WHERE NOT landed AND NOT EXISTS (SELECT 1 FROM l h WHERE h.landed AND h.path = l.path AND h.line = l.line AND h.source = 'click') GROUP BY 1")
def pending_lines(spark, sf_dir):
    e, u = table(spark, sf_dir, "events"), c("user_id")
    rows = e.select(c("event_id").alias("pos"), (u % 5).alias("path"), (u % 50).cast("string").alias("line"), c("event_type").alias("source"), u.cast("string").alias("model_id"))
    good, _ = review.pending_rows(rows.where("pos % 2 <> 0"), rows.where("pos % 2 = 0 and source = 'click'"), F.when(c("model_id").endswith("3"), "bad"))
    every, _ = review.pending_rows(rows.where("pos % 2 <> 0"), rows.where("pos % 2 = 0 and source = 'click'"), lit(None).cast("string"))
    return every.groupBy("source").agg(F.count(lit(1)).alias("appended")).join(good.groupBy("source").agg(F.count(lit(1)).alias("valid")), "source")


@query("WITH s AS (SELECT page_id AS n, 'u' || page_id AS url FROM pages) SELECT 's' AS source, url, CASE n % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE 'b' END AS sha, CASE WHEN n % 4 IN (0, 1) THEN 'before' ELSE 'now' END AS fetched, n % 4 = 2 AS change FROM s WHERE n % 5 > 0 OR n % 4 > 0")
def announced_channels(spark, sf_dir):
    n = c("page_id")
    p = table(spark, sf_dir, "pages").select(n, F.concat(lit("u"), n.cast("string")).alias("url"), lit("s").alias("source"))
    before = p.where("page_id % 4 < 3 and (page_id % 5 > 0 or page_id % 4 > 0)").select("source", "url", lit("a").alias("sha"), lit("text").alias("text"), lit("before").alias("fetched"))
    now = p.select("source", "url", F.when(n % 4 == 0, lit(None)).when(n % 4 == 1, "a").otherwise("b").alias("sha"), lit("new").alias("text"))
    return review.channel_update(before, now, "now").select("source", "url", "sha", "fetched", "change")


@query("WITH a AS (SELECT 'x' || o_orderkey AS title, CASE o_orderkey % 3 WHEN 0 THEN 'dead' WHEN 1 THEN 'alive' END AS s, o_custkey % 2 = 0 AS open_ FROM orders) SELECT title, CASE WHEN s = 'dead' THEN 'opened' ELSE 'closed' END AS change FROM a WHERE (s = 'dead' AND NOT open_) OR (s = 'alive' AND open_)")
def alert_changes(spark, sf_dir):
    k = c("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.concat(lit("x"), k.cast("string")).alias("title"), F.when(k % 3 == 0, "dead").when(k % 3 == 1, "alive").alias("state"), (c("o_custkey") % 2 == 0).alias("open"))
    return review.alert_changes(o.select("title", "state"), o.where("open").select("title"))


@query("SELECT 'broken: ' || c_custkey AS title FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 0 AND c_custkey % 5 <> 0")
def recovered_alerts(spark, sf_dir):
    k = c("c_custkey")
    own = table(spark, sf_dir, "customer")
    open_ = own.where(k % 2 == 0).select(F.concat(lit("broken: "), k.cast("string")).alias("title"))
    name = k.cast("string").alias("provider")
    return review.recovered(open_, own.where(k % 3 == 0).select(name), own.where(k % 5 == 0).select(name), "broken: ")


# Pages of sources written from parts: (source, a page's head, a row, its end), the SQL of what stands on them.
_MODEL = "'m' || p_partkey"


def _pages(spark, sf_dir, source, head, row, tail, per=500):
    p = table(spark, sf_dir, "part").withColumn("m", F.concat(lit("m"), c("p_partkey").cast("string"))).withColumn("i", F.format_string("%.2f", c("p_size") / 4.0)).withColumn("o", F.format_string("%.2f", c("p_size") / 2.0))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", row(p).alias("r")))), lambda x: x["r"]), "")
    return p.groupBy(F.floor(c("p_partkey") / per).alias("g")).agg(F.concat(lit(head), lines, lit(tail)).alias("body")).select(lit(source).alias("source"), F.concat(lit("u"), c("g").cast("string")).alias("url"), "body")


def _tr(*cells):
    return F.concat(lit("<tr>"), *[F.concat(lit("<td>"), x, lit("</td>")) for x in cells], lit("</tr>"))


def _th(*cells):
    return "<table><thead><tr>" + "".join(f"<th>{x}</th>" for x in cells) + "</tr></thead><tbody>"


_JSON = lambda p: F.concat(lit('{"id":"'), c("m"), lit('","pricing":{"prompt":"'), (c("p_size") / 4e6).cast("string"), lit('","completion":"'), (c("p_size") / 2e6).cast("string"), lit('"}},'))
_MADE = {
    "ai21": ('<div class="b-cards--type-models">', lambda p: F.concat(lit('<div class="card"><h3 class="card__title">'), c("m"), lit('</h3><div class="card__footer">$'), c("i"), lit(" / 1M input tokens $"), c("o"), lit(" / 1M output tokens</div></div>")), "</div>"),
    "cerebras": ('{"data":[', _JSON, '{"id":"last"}]}'),
    "cloudflare": ('<h2 id="llm-model-pricing">a</h2>' + _th("Model", "Price in Tokens", "Price in Neurons"), lambda p: _tr(F.concat(lit("@"), c("m")), F.concat(lit("$"), c("i"), lit(" per M input tokens<br>$"), c("o"), lit(" per M output tokens")), lit("n")), "</tbody></table>"),
    "deepinfra": (_th("Model", "Context", "$ per 1M input tokens", "$ per 1M output tokens", "Actions"), lambda p: _tr(F.concat(lit('<a href="/x/'), c("m"), lit('">m</a>')), lit("-"), F.concat(lit("$"), c("i")), F.concat(lit("$"), c("o")), lit("")), "</tbody></table>"),
    "fireworks": (_th("Model", "Standard", "Priority"), lambda p: _tr(c("m"), F.concat(lit("$"), c("i"), lit(" $0.01 $"), c("o")), lit("")), "</tbody></table>"),
    "minimax": ("| Model | Input | Output |\n|---|---|---|\n", lambda p: F.concat(lit("| **"), c("m"), lit("** | ~~$9.99~~ $"), c("i"), lit(" | $"), c("o"), lit(" |\n")), ""),
    "sambanova": (_th("Model", "Cached Input Tokens", "Input (per 1M tokens)", "Output (per 1M tokens)"), lambda p: _tr(c("m"), lit("N/A"), F.concat(c("i"), lit(" USD")), F.concat(c("o"), lit(" USD"))), "</tbody></table>"),
    "together": (_th("model", "input", "output"), lambda p: _tr(c("m"), F.concat(lit("$"), c("i")), F.concat(lit("$"), c("o"))), "</tbody></table>"),
    "publicai": (_th("Model ID", "Context Length", "Pricing", "Country of Origin"), lambda p: _tr(c("m"), lit("8K"), F.concat(lit("$"), c("i"), lit(" / $"), c("o"), lit(" per 1M tokens")), lit("x")), "</tbody></table>"),
    "xai": ('<script>__XAI_PUBLIC_MODELS__ = {"clusterConfigs":[{"languageModels":[', lambda p: F.concat(lit('{"name":"'), c("m"), lit('","promptTextTokenPrice":"'), (c("p_size") * 2500).cast("string"), lit('","completionTextTokenPrice":"'), (c("p_size") * 5000).cast("string"), lit('"},')), '{"name":"last"}]}]};</script>'),
    "zai": (_th("Model", "Input", "Cached Input", "Output"), lambda p: _tr(F.concat(lit("glm-"), c("m")), F.concat(lit("$"), c("i")), lit("Free"), F.concat(lit("$"), c("o"))), "</tbody></table>"),
    "watsonx": ("<c4d-pricing-table><c4d-pricing-table-header-row><c4d-pricing-table-header-cell>Model Name</c4d-pricing-table-header-cell><c4d-pricing-table-header-cell>Model Provider</c4d-pricing-table-header-cell><c4d-pricing-table-header-cell>Pay as you go</c4d-pricing-table-header-cell></c4d-pricing-table-header-row>", lambda p: F.concat(lit("<c4d-pricing-table-row><c4d-pricing-table-cell>"), c("m"), lit("</c4d-pricing-table-cell><c4d-pricing-table-cell>p</c4d-pricing-table-cell><c4d-pricing-table-cell>USD "), c("i"), lit(" / USD "), c("o"), lit("</c4d-pricing-table-cell></c4d-pricing-table-row>")), "</c4d-pricing-table>"),
}
_MADE |= {
    "mistral": ("<section>Prices /M Tokens" + _th("Model", "Input", "Cached input", "Output"), lambda p: _tr(F.concat(lit('<a href="/models/'), c("m"), lit('">x</a>')), F.concat(lit("<del>$99</del><ins>Sale: $"), c("i"), lit("</ins>")), lit("-"), F.concat(lit("$"), c("o"))), "</tbody></table></section>"),
    "groq": ("| MODEL ID | SPEED (T/SEC) | PRICE PER 1M TOKENS | RATE LIMITS (DEVELOPER PLAN) | CONTEXT WINDOW (TOKENS) | MAX COMPLETION TOKENS | MAX FILE SIZE |\n|---|---|---|---|---|---|---|\n", lambda p: F.concat(lit("| [M](/docs/model/"), c("m"), lit(")"), c("m"), lit(" | 9 | $"), c("i"), lit(" input$"), c("o"), lit(" output | 1 | 131,072 | - | - |\n")), ""),
    "novita": ("", lambda p: F.concat(lit('<article data-testid="model-section-mobile-card"><a href="/models/model-detail/org-'), c("m"), lit('">m</a><dl><dt>Input</dt><dd><span title="'), c("i"), lit('">a</span></dd><dt>Output</dt><dd><span title="'), c("o"), lit('">b</span></dd></dl></article>')), ""),
    "scaleway": ("<table><caption>Generative API</caption><thead><tr><th>Name</th><th>Tasks</th><th>Input tokens</th><th>Output tokens</th><th>Try</th></tr></thead><tbody>", lambda p: _tr(c("m"), lit("Chat"), F.concat(lit("€"), c("i"), lit(" / million tokens")), F.concat(lit("€"), c("o"), lit(" / million tokens")), lit("")), "</tbody></table>"),
    "cohere": ("<ul>", lambda p: F.concat(lit("<li>"), c("m"), lit(" pricing is $"), c("i"), lit(" / 1M tokens for input and $"), c("o"), lit(" / 1M tokens for output</li>")), "</ul>"),
    "avian": ('<div id="avModelGrid">', lambda p: F.concat(lit('<div class="av-model-card"><div class="av-model-label">'), c("m"), lit('</div><div class="av-mp"><span class="av-mp-label">Input</span><span class="av-mp-val">$'), c("i"), lit('</span></div><div class="av-mp"><span class="av-mp-label">Output</span><span class="av-mp-val">$'), c("o"), lit("</span></div></div>")), "</div>"),
    "moonshot": ('<DocTable columns={[{title: "Model"}, "Input Price", "Output Price",]} rows={[', lambda p: F.concat(lit('["'), c("m"), lit('", <>{"$'), c("i"), lit('"} now</>, "$'), c("o"), lit('"], ')), "]} />"),
    "digitalocean": ("<table><thead><tr><th>Provider</th><th>Model</th><th>Serverless Inference per 1M</th></tr></thead><tbody>", lambda p: _tr(lit("P"), c("m"), F.concat(lit('<span class="gen-ai-pricing-matrix"><span class="gen-ai-pricing-matrix-row"><span>Processing Mode</span><span>Input</span><span>Output</span></span><span class="gen-ai-pricing-matrix-row"><span>Standard</span><span>$'), c("i"), lit("</span><span>$"), c("o"), lit("</span></span></span>"))), "</tbody></table>"),
}
_PREFIX = {"cloudflare": "@", "zai": "glm-", "novita": "org/"}


def _priced_query(name):
    def priced(spark, sf_dir):
        got = registry.all_priced(_pages(spark, sf_dir, name, *_MADE[name]), (name,))
        return got.where("model_id <> 'last'").select("model_id", "rates.input", "rates.output", "fault")

    priced.__name__ = f"priced_{name}"
    cents = lambda x: f"round(round({x} * 100 + 1e-9) / 100, 6)" if name not in ("cerebras", "xai") else f"round({x}, 6)"
    return priced, f"SELECT '{_PREFIX.get(name, '')}' || {_MODEL} AS model_id, {cents('p_size / 4.0')} AS input, {cents('p_size / 2.0')} AS output, CAST(NULL AS VARCHAR) AS fault FROM part"


@query("SELECT 'r' || p_partkey % 7 AS run, 'fireworks' AS source, p_partkey % 7 NOT IN (2, 4, 5) AS settled, CASE p_partkey % 7 WHEN 2 THEN 'no row' WHEN 4 THEN 'page v: markup: AssertionError' WHEN 5 THEN 'skipped m' || min(CASE WHEN p_partkey % 7 = 5 THEN CAST(p_partkey AS VARCHAR) END) || ': unreadable rate' END AS reason FROM part GROUP BY p_partkey % 7")
def run_validity(spark, sf_dir):
    """Runs over pages written from parts: one has another heading, one a page that can't be read, one cells that can't."""
    k = c("p_partkey") % 7
    cells = F.concat(lit("<tr><td>m"), c("p_partkey").cast("string"), lit("</td><td>"), F.when(k == 5, lit("$1-2 $3 $4")).otherwise(lit("$1 $2 $3")), lit("</td><td></td></tr>"))
    rows = table(spark, sf_dir, "part").select(k.alias("k"), c("p_partkey"), cells.alias("r"))
    body = F.concat(F.when(c("k") == 2, _th("Name", "Standard", "Priority")).otherwise(_th("Model", "Standard", "Priority")), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "r"))), lambda x: x["r"]), ""), lit("</tbody></table>"))
    made = rows.groupBy("k").agg(body.alias("body")).select(F.concat(lit("r"), c("k").cast("string")).alias("run"), lit("fireworks").alias("source"), lit("u").alias("url"), "body")
    broken = rows.where("k = 4").select("k").distinct().select(lit("r4").alias("run"), lit("fireworks").alias("source"), lit("v").alias("url"), lit("<![x[<p>").alias("body"))
    found = registry.read(made.unionByName(broken), ("fireworks",))
    return runs.validity(found.fetched, found.faults, registry.all_priced(found, ("fireworks",))).select("run", "source", "settled", "reason")


@query("SELECT o_orderkey, 'm' || o_orderkey % 97 AS title, CAST(o_custkey AS BIGINT) AS held, o_orderkey % 5 = 0 AS broken FROM orders")
def literal_values(spark, sf_dir):
    """Script literals with component calls, brackets inside texts and trailing commas; every fifth has no end."""
    k = c("o_orderkey")
    n = (k % 97).cast("string")
    text = F.concat(lit("[{title: <>{'m"), n, lit("'}</>, note: 'a] {b',}, _jsx(Cell, {n: "), c("o_custkey").cast("string"), lit(", children: ['x', null,]}),"), F.when(k % 5 == 0, "").otherwise("]"))
    got = literals.scan_literals(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", text.alias("t")), "t")
    v = F.try_parse_json("t_json")
    whole = lambda path, kind, other: F.when(c("t_fault").isNull(), F.try_variant_get(v, path, kind)).otherwise(other)
    return got.select("o_orderkey", whole("$[0].title.props.children[0]", "string", F.concat(lit("m"), n)).alias("title"), whole("$[1].props.n", "bigint", c("o_custkey").cast("bigint")).alias("held"), c("t_fault").isNotNull().alias("broken"))


@query("WITH o AS (SELECT o_orderkey, o_orderkey % 500 AS a, o_custkey % 300 AS b FROM orders) SELECT DISTINCT o_orderkey, 'M' || p_partkey AS model_id FROM o JOIN part ON p_partkey = a OR p_partkey = b")
def id_mentions(spark, sf_dir):
    """Ids that a cell names whole; longer tokens that hold one, and link targets, name none."""
    k, a, b = c("o_orderkey"), (c("o_orderkey") % 500).cast("string"), (c("o_custkey") % 300).cast("string")
    text = F.concat(lit("see _m"), a, lit("_, xm1, m2_fast, m3.5 or [m"), b, lit("](m4 m5) <i m6>."))
    ids = table(spark, sf_dir, "part").select(F.concat(lit("M"), c("p_partkey").cast("string")).alias("model_id"))
    return mentions.mentions(table(spark, sf_dir, "orders").select(k, mentions.visible(text).alias("t")), "o_orderkey", "t", ids)


@query(f"WITH {_FLAT} SELECT source, model_id, 'first seen' AS label, first_seen AS value FROM flat UNION ALL SELECT source, model_id, 'rate input', CAST(CAST(input AS DECIMAL(18, 4)) AS VARCHAR) FROM flat WHERE input IS NOT NULL")
def detail_rows(spark, sf_dir):
    """An entry's detail rows, those of its first day and its input rate compared."""
    rows = page.detail_rows(_flat(spark, sf_dir)).where("label in ('first seen', 'rate input')")
    value = F.when(c("label") == "rate input", c("number").cast("decimal(18,4)").cast("string")).otherwise(c("value"))
    return rows.select("source", "model_id", "label", value.alias("value"))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 1 THEN 'row: unknown other' WHEN 2 THEN 'overrides[].when: unknown x' WHEN 3 THEN 'overrides[].rates.input: minimum' WHEN 4 THEN 'row: missing model_id' WHEN 5 THEN 'rates: minProperties' END AS fault FROM part")
def contract_at_depth(spark, sf_dir):
    """Lines against a closed schema: faults at the top, in lists of objects and in what these hold."""
    rates_ = {"type": "object", "additionalProperties": False, "minProperties": 1, "properties": {a: {"type": "number", "minimum": 0} for a in AXES}}
    when = {"type": "object", "additionalProperties": False, "properties": {"window": {"type": "array", "items": {"type": "integer"}}}}
    entry = {"type": "object", "additionalProperties": False, "required": ["when"], "properties": {"when": when, "rates": rates_}}
    schema = {"type": "object", "additionalProperties": False, "required": ["source", "model_id"], "properties": {"source": {"type": "string"}, "model_id": {"type": "string"}, "rates": rates_, "overrides": {"type": "array", "minItems": 1, "items": entry}}}
    k = c("p_partkey") % 6
    line = F.concat(lit('{"source":"s"'), F.when(k == 4, "").otherwise(F.concat(lit(',"model_id":"m'), c("p_partkey").cast("string"), lit('"'))), F.when(k == 1, lit(',"other":1')).otherwise(""), F.when(k == 5, lit(',"rates":{}')).otherwise(F.concat(lit(',"rates":{"input":'), c("p_size").cast("string"), lit("}"))), lit(',"overrides":[{"when":{"window":[1,2]'), F.when(k == 2, lit(',"x":1')).otherwise(""), lit('},"rates":{"input":'), F.when(k == 3, lit("-1")).otherwise(lit("1")), lit("}}]}"))
    return contract.contract_faults(table(spark, sf_dir, "part").select("p_partkey", line.alias("line")), schema).select("p_partkey", "fault")


for _name in _MADE:
    QUERIES[f"priced_{_name}"], SQL[f"priced_{_name}"] = _priced_query(_name)


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '$' || printf('%.2f', p_size / 4.0) WHEN 1 THEN NULL WHEN 2 THEN printf('%.2f', p_size / 4.0) ELSE NULL END IS NOT NULL AS readable, CASE WHEN p_partkey % 4 IN (0, 2) THEN printf('%.2f', p_size / 4.0) END AS amount, p_partkey % 4 = 3 AS malformed FROM part")
def cell_amounts(spark, sf_dir):
    """Cells with an amount behind a dollar or before USD, none, or a range."""
    k = c("p_partkey")
    n = F.format_string("%.2f", c("p_size") / 4.0)
    text = F.when(k % 4 == 0, F.concat(lit("now $"), n, lit(" / M"))).when(k % 4 == 1, "on request").when(k % 4 == 2, F.concat(n, lit(" USD"))).otherwise(F.concat(lit("$"), n, lit(" - $9.99")))
    got = money.scan(table(spark, sf_dir, "part").select("p_partkey", text.alias("t")), d=("t", "$", ""), u=("t", "", " USD"))
    one = F.coalesce(F.get("d_amounts", 0), F.get("u_amounts", 0))
    return got.select("p_partkey", (one.isNotNull() & ~c("d_bad") & ~c("u_bad")).alias("readable"), F.when(~c("d_bad"), one).alias("amount"), (c("d_bad") | c("u_bad")).alias("malformed"))


@query("SELECT CASE WHEN count(*) FILTER (hard) + count(*) FILTER (NOT hard) > 0 THEN '::warning::' || concat_ws('; ', 'hard failures: ' || string_agg(p, ', ' ORDER BY p) FILTER (hard), 'skips: ' || string_agg(p, ', ' ORDER BY p) FILTER (NOT hard)) END AS warning FROM (SELECT CAST(user_id AS VARCHAR) AS p, bool_or(event_type = 'click') AS hard FROM events WHERE event_type IN ('click', 'view') GROUP BY 1)")
def run_warning(spark, sf_dir):
    e, u = table(spark, sf_dir, "events"), c("user_id").cast("string")
    line = F.when(c("event_type") == "click", F.concat(lit("ERROR:x:detector for "), u, lit(" failed: y"))).when(c("event_type") == "view", F.concat(lit("WARNING:x:detect skip for "), u, lit(": y")))
    return ops.warning(ops.issues(e.select(c("event_id").alias("pos"), line.alias("line")).where("line is not null")))


