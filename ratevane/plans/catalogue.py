"""All queries of the rate log by name, and SQL of the same meaning for each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clock as K
from ..functions import text as T
from ..operators import absence, candidates, catalog, log, merge, ops, rates, temporal, validate, views
from ..operators.positions import places_in
from ..schema import AXES, OVERRIDES, PROVENANCE, RATES
from ..sources.listing import listing_rows
from ..sources.observations import observations, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The makers that a word of an id names.
MAKERS = {
    "claude": "anthropic", "command": "cohere", "codestral": "mistral", "deepseek": "deepseek", "ernie": "baidu", "gemini": "google", "gemma": "google", "glm": "zai",
    "gpt": "openai", "granite": "ibm", "grok": "xai", "hy3": "tencent", "inkling": "thinkingmachines", "kimi": "moonshot", "ling": "inclusionai", "llama": "meta",
    "mimo": "xiaomi", "minimax": "minimax", "mistral": "mistral", "muse": "meta", "mythomax": "gryphe", "nemotron": "nvidia", "o1": "openai", "o3": "openai", "o4": "openai",
    "phi": "microsoft", "pixtral": "mistral", "qwen": "alibaba", "sonar": "perplexity", "step": "stepfun", "wizardlm": "microsoft",
}

OBS = """obs AS (
  SELECT event_type AS source, CAST(user_id AS VARCHAR) AS model_id, event_id AS pos, strftime(ts, '%Y-%m-%d') AS observed_at, k,
         CASE WHEN k % 3 = 0 THEN strftime(CAST(ts AS DATE) + CAST(k % 7 - 3 AS INTEGER), '%Y-%m-%d') END AS effective_at,
         k % 10 = 0 AS removed, value AS rate_input
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""
CHAIN = (
    OBS
    + """, started AS (SELECT *, CASE WHEN removed THEN observed_at ELSE coalesce(effective_at, observed_at) END AS valid_from FROM obs),
ended AS (SELECT *, min(valid_from) OVER (PARTITION BY source, model_id ORDER BY observed_at, pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS e FROM started),
chain AS (SELECT * EXCLUDE (e), CASE WHEN e IS NOT NULL THEN greatest(e, valid_from) END AS valid_to FROM ended),
solid AS (SELECT * FROM chain WHERE valid_to IS NULL OR valid_to > valid_from)"""
)


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.interval_chain(observations(spark, sf_dir))


@query(f"WITH {OBS} SELECT source, model_id, pos, observed_at, effective_at, removed, k, rate_input FROM obs")
def observation_rows(spark, sf_dir):
    return observations(spark, sf_dir)


@query(f"WITH {CHAIN} SELECT source, model_id, pos, observed_at, removed, rate_input, valid_from, valid_to FROM chain")
def interval_chain(spark, sf_dir):
    return _chain(spark, sf_dir).select("source", "model_id", "pos", "observed_at", "removed", "rate_input", "valid_from", "valid_to")


@query(f"WITH {CHAIN} SELECT source, count(*) AS items, count(*) FILTER (valid_to <= valid_from) AS empty_items, count(*) FILTER (valid_to IS NULL) AS open_items FROM chain GROUP BY source")
def empty_intervals(spark, sf_dir):
    return _chain(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("empty_items"), F.count_if(F.col("valid_to").isNull()).alias("open_items"))


@query(
    f"""WITH {CHAIN}, probes AS (SELECT source, model_id, pos AS probe, strftime(CAST(observed_at AS DATE) + CAST(k % 11 - 4 AS INTEGER), '%Y-%m-%d') AS day FROM obs)
SELECT p.source, p.model_id, p.probe, p.day, s.pos, CASE WHEN NOT s.removed THEN s.rate_input END AS rate
FROM probes p LEFT JOIN solid s ON p.source = s.source AND p.model_id = s.model_id AND s.valid_from <= p.day AND (s.valid_to IS NULL OR p.day < s.valid_to)"""
)
def price_asof_day(spark, sf_dir):
    obs = observations(spark, sf_dir)
    probes = obs.select("source", "model_id", F.col("pos").alias("probe"), F.date_format(F.date_add(F.to_date("observed_at"), F.col("k") % 11 - 4), "yyyy-MM-dd").alias("day"))
    got = temporal.price_as_of(temporal.interval_chain(obs), probes, ["pos", "removed", "rate_input"])
    return got.select("source", "model_id", "probe", "day", "pos", F.when(~F.col("removed"), F.col("rate_input")).alias("rate"))


@query(
    f"""WITH {CHAIN}, days AS (SELECT source, model_id, removed, rate_input, unnest(generate_series(CAST(valid_from AS DATE), coalesce(CAST(valid_to AS DATE) - 1, DATE '2024-02-05'), INTERVAL 1 DAY)) AS d FROM solid)
SELECT source, strftime(d, '%Y-%m-%d') AS day, count(*) AS items, count(*) FILTER (NOT removed) AS priced, round(max(CASE WHEN NOT removed THEN rate_input END), 6) AS top FROM days GROUP BY 1, 2"""
)
def price_every_day(spark, sf_dir):
    days = temporal.every_day(_chain(spark, sf_dir), "2024-02-05", ["removed", "rate_input"])
    return days.groupBy("source", "day").agg(F.count(F.lit(1)).alias("items"), F.count_if(~F.col("removed")).alias("priced"), F.round(F.max(F.when(~F.col("removed"), F.col("rate_input"))), 6).alias("top"))


@query(
    f"""WITH {OBS} SELECT source, model_id, min(observed_at) AS first_seen, arg_max(rate_input, (observed_at, pos)) FILTER (NOT removed) AS priced, max(observed_at) FILTER (NOT removed) AS priced_at,
max(observed_at) AS newest_at, arg_max(removed, (observed_at, pos)) AS newest_removed, CASE WHEN arg_max(removed, (observed_at, pos)) THEN max(observed_at) END AS removed_at FROM obs GROUP BY 1, 2"""
)
def current_view(spark, sf_dir):
    return log.partition_view(observations(spark, sf_dir), F.col("rate_input"))


@query(f"WITH {OBS} SELECT source, model_id, arg_max(rate_input, pos) FILTER (NOT removed) AS last_rate, arg_max(observed_at, pos) AS newest_at, arg_max(removed, pos) AS newest_removed FROM obs GROUP BY 1, 2")
def last_by_input(spark, sf_dir):
    got = log.last_by_input(observations(spark, sf_dir), ["rate_input", "observed_at", "removed"])
    return got.select("source", "model_id", F.col("last.rate_input").alias("last_rate"), F.col("newest.observed_at").alias("newest_at"), F.col("newest.removed").alias("newest_removed"))


@query(
    f"""WITH {OBS}, l AS (SELECT *, k % 4 AS tier, lag(removed) OVER w AS r, lag(k % 4) OVER w AS t, lag(1) OVER w AS prior FROM obs WINDOW w AS (PARTITION BY source, model_id ORDER BY pos))
SELECT source, model_id, pos, observed_at, tier, coalesce(r, false) AS reappeared FROM l WHERE NOT removed AND (prior IS NULL OR r OR tier IS DISTINCT FROM t)"""
)
def price_changes(spark, sf_dir):
    got = log.changes(observations(spark, sf_dir).withColumn("tier", F.col("k") % 4), ["tier"])
    return got.select("source", "model_id", "pos", "observed_at", "tier", "reappeared")


@query(
    f"""WITH {CHAIN}, g AS (SELECT *, CASE WHEN removed OR rate_input IS NULL THEN 1 ELSE 0 END AS gap FROM solid),
i AS (SELECT *, sum(gap) OVER (PARTITION BY source, model_id ORDER BY valid_from, observed_at, pos ROWS UNBOUNDED PRECEDING) AS isl FROM g),
r AS (SELECT source, model_id, isl, min(valid_from) AS run_start, CASE WHEN count(*) FILTER (valid_to IS NULL) > 0 THEN NULL ELSE max(valid_to) END AS run_end, count(*) AS points, min(rate_input) AS low, max(rate_input) AS high FROM i WHERE gap = 0 GROUP BY 1, 2, 3)
SELECT source, model_id, CAST(row_number() OVER (PARTITION BY source, model_id ORDER BY isl) AS INT) AS run, run_start, run_end, points, low, high FROM r"""
)
def price_runs(spark, sf_dir):
    return temporal.runs(_chain(spark, sf_dir), "rate_input")


@query(f"WITH {CHAIN} SELECT source, model_id, valid_from AS x0, coalesce(valid_to, '2024-02-05') AS x1, round(rate_input, 2) AS y FROM solid WHERE NOT removed AND rate_input IS NOT NULL")
def step_points(spark, sf_dir):
    return temporal.steps(_chain(spark, sf_dir), "rate_input", "2024-02-05")


@query(f"WITH {CHAIN} SELECT source, model_id, arg_max(valid_from, (observed_at, pos)) AS valid_from, arg_max(coalesce(valid_to, 'open'), (observed_at, pos)) AS valid_to, arg_max(rate_input, (observed_at, pos)) AS rate_input FROM solid WHERE NOT removed GROUP BY 1, 2")
def current_era(spark, sf_dir):
    return temporal.current_era(_chain(spark, sf_dir)).withColumn("valid_to", F.coalesce("valid_to", F.lit("open")))


def _halves(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return obs.where("pos % 2 = 0"), obs.where("pos % 2 = 1")


@query(
    f"""WITH {OBS}, b AS (SELECT source, model_id, observed_at, bool_or(removed) AS br FROM obs WHERE pos % 2 = 0 GROUP BY 1, 2, 3),
x AS (SELECT *, row_number() OVER (PARTITION BY source, model_id, observed_at ORDER BY pos) AS a1, row_number() OVER (PARTITION BY source, model_id, observed_at, removed ORDER BY pos) AS a2 FROM obs WHERE pos % 2 = 1)
SELECT x.source, x.model_id, x.observed_at, x.pos, x.removed FROM x LEFT JOIN b USING (source, model_id, observed_at)
WHERE CASE WHEN x.removed THEN NOT coalesce(br, false) AND a2 = 1 ELSE br IS NULL AND a1 = 1 END"""
)
def key_union(spark, sf_dir):
    base, extra = _halves(spark, sf_dir)
    return log.key_union(base, extra).select("source", "model_id", "observed_at", "pos", "removed")


_LINE = "source || '|' || model_id || '|' || observed_at || '|' || CAST(k % 3 AS VARCHAR)"


def _line(df):
    return df.withColumn("line", F.concat_ws("|", "source", "model_id", "observed_at", (F.col("k") % 3).cast("string")))


@query(f"WITH {OBS}, o AS (SELECT *, {_LINE} AS line FROM obs) SELECT line, min(pos) AS pos FROM o WHERE pos % 2 = 1 AND line NOT IN (SELECT line FROM o WHERE pos % 2 = 0) GROUP BY line")
def exact_line_union(spark, sf_dir):
    base, extra = _halves(spark, sf_dir)
    return log.line_union(_line(base), _line(extra))


@query(
    f"""WITH {OBS}, o AS (SELECT *, {_LINE} AS line, CAST(pos % 7 AS INT) AS branch FROM obs), b AS (SELECT * FROM o WHERE pos % 2 = 0), n AS (SELECT * FROM o WHERE pos % 2 = 1 AND line NOT IN (SELECT line FROM b))
SELECT n.branch, count(*) AS appended, count(DISTINCT CASE WHEN k2.source IS NULL THEN n.source || '/' || n.model_id END) AS created, count(*) FILTER (n.removed) AS removed
FROM n LEFT JOIN (SELECT DISTINCT source, model_id FROM b) k2 ON n.source = k2.source AND n.model_id = k2.model_id GROUP BY 1"""
)
def churn_counts(spark, sf_dir):
    base, extra = _halves(spark, sf_dir)
    return log.churn(_line(base), _line(extra).withColumn("branch", (F.col("pos") % 7).cast("int")), "branch")


@query(
    f"""WITH {OBS} SELECT count(DISTINCT source || '/' || model_id) AS models, count(DISTINCT source) AS sources, count(*) AS rows, coalesce(min(observed_at), '-') AS first_seen,
CAST(CASE WHEN count(DISTINCT observed_at) > 1 THEN date_diff('day', min(CAST(observed_at AS DATE)), max(CAST(observed_at AS DATE))) + 1 ELSE 0 END AS BIGINT) AS days, coalesce(max(observed_at), '') AS updated_at FROM obs"""
)
def log_stats(spark, sf_dir):
    return log.stats(observations(spark, sf_dir))


@query(f"WITH {OBS} SELECT source, count(*) AS rows, count(*) FILTER (removed) AS removals, count(DISTINCT model_id) AS models, max(observed_at) AS updated_at FROM obs GROUP BY 1")
def source_counts(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_if("removed").alias("removals"), F.count_distinct("model_id").alias("models"), F.max("observed_at").alias("updated_at"))


# Sessions over line items; the entry of a part has a schedule, a volume tier and two modes.
_N = "CAST(NULL AS {})"


def _null_rates(**axes):
    return F.struct(*[axes.get(a, F.lit(None)).cast("double").alias(a) for a in AXES])


def _override(when: dict, own_rates, multiplier=None):
    kinds = {"days": "array<string>", "window": "array<int>", "timezone": "string", "min_tokens": "bigint", "mode": "string"}
    w = F.struct(*[when.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])
    return F.struct(w.alias("when"), own_rates.alias("rates"), (multiplier if multiplier is not None else F.lit(None)).cast("double").alias("quota_multiplier"))


def entries(spark, sf_dir):
    """(p_partkey, base, overrides) of every part."""
    size, price = F.col("p_size"), F.round(F.col("p_retailprice") / 1000, 6)
    base = _null_rates(input=price, output=size.cast("double"), cache_read=F.when(size % 4 != 0, F.round(size / 10.0, 6)))
    week = F.array(*[F.lit(d) for d in ("monday", "tuesday", "wednesday", "thursday", "friday")])
    overrides = F.array(
        _override({"days": week, "window": F.array(F.lit(100), F.lit(1430))}, _null_rates(input=price * 2)),
        _override({"min_tokens": F.lit(500_000)}, _null_rates(input=price / 2)),
        _override({"mode": F.lit("fast")}, _null_rates(input=price * 3, output=size * 2.0)),
        _override({"mode": F.lit("quota")}, F.lit(None).cast(RATES), F.lit(0.4)),
    ).cast(OVERRIDES)
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", base.alias("base"), overrides.alias("overrides"))


def sessions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    minute = F.col("l_orderkey") % 1440
    mode = F.when(F.col("l_returnflag") == "A", "fast").when(F.col("l_returnflag") == "R", "quota").otherwise("")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") * 20_000).cast("bigint").alias("tokens_in"), (F.col("l_linenumber") * 10_000).cast("bigint").alias("cached"), (F.col("l_partkey") % 50 * 1000).alias("tokens_out"), (F.col("l_orderkey") % 1440).alias("minute"), F.to_date("l_shipdate").alias("day"), mode.alias("mode"), T.weekday(F.to_date("l_shipdate")).alias("weekday"), (F.floor(minute / 60) * 100 + minute % 60).alias("clock"))


_SESSION = """s AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity * 20000 AS BIGINT) AS tokens_in, CAST(l_linenumber * 10000 AS BIGINT) AS cached, l_partkey % 50 * 1000 AS tokens_out, l_orderkey % 1440 AS minute,
  CAST(l_shipdate AS DATE) AS day, CASE l_returnflag WHEN 'A' THEN 'fast' WHEN 'R' THEN 'quota' ELSE '' END AS mode FROM lineitem),
j AS (SELECT s.*, p_brand, round(p_retailprice / 1000, 6) AS bi, CAST(p_size AS DOUBLE) AS bo, CASE WHEN p_size % 4 <> 0 THEN round(p_size / 10.0, 6) END AS bc, minute // 60 * 100 + minute % 60 AS hhmm FROM s JOIN part ON l_partkey = p_partkey),
m AS (SELECT *, CASE WHEN mode = 'quota' THEN 4 WHEN mode = 'fast' THEN 3 WHEN tokens_in + cached > 500000 THEN 2 WHEN isodow(day) <= 5 AND hhmm >= 100 AND hhmm < 1430 THEN 1 ELSE 0 END AS hit FROM j),
e AS (SELECT *, CASE hit WHEN 1 THEN bi * 2 WHEN 2 THEN bi / 2 WHEN 3 THEN bi * 3 ELSE bi END AS ri, CASE hit WHEN 3 THEN bo * 2 ELSE bo END AS ro FROM m),
c AS (SELECT *, CASE WHEN tokens_in = 0 THEN 0.0 ELSE tokens_in / 1e6 * ri END + CASE WHEN cached = 0 THEN 0.0 ELSE cached / 1e6 * coalesce(bc, ri) END + CASE WHEN tokens_out = 0 THEN 0.0 ELSE tokens_out / 1e6 * ro END AS total FROM e)"""


def _costed(spark, sf_dir):
    s, p = sessions(spark, sf_dir), entries(spark, sf_dir)
    c = F.col
    joined = s.join(p, s.l_partkey == p.p_partkey)
    own = rates.effective(c("base"), c("overrides"), lambda o: rates.met(o, c("weekday"), c("clock"), c("tokens_in") + c("cached"), c("mode")))
    priced = joined.withColumn("rates", own)
    return priced.withColumn("total", rates.session_total(c("rates"), c("tokens_in"), c("cached"), c("tokens_out")))


@query(f"WITH {_SESSION} SELECT l_orderkey, l_linenumber, round(ri, 6) AS rate_in, round(ro, 6) AS rate_out FROM e")
def effective_rates(spark, sf_dir):
    return _costed(spark, sf_dir).select("l_orderkey", "l_linenumber", F.round("rates.input", 6).alias("rate_in"), F.round("rates.output", 6).alias("rate_out"))


@query(f"WITH {_SESSION} SELECT p_brand, mode, count(*) AS sessions, round(sum(total), 2) AS cost, round(max(total), 6) AS top FROM c GROUP BY 1, 2")
def session_cost(spark, sf_dir):
    return _costed(spark, sf_dir).groupBy("p_brand", "mode").agg(F.count(F.lit(1)).alias("sessions"), F.round(F.sum("total"), 2).alias("cost"), F.round(F.max("total"), 6).alias("top"))


@query(
    f"""WITH {_SESSION}, r AS (SELECT l_orderkey, l_linenumber, total, min(total) OVER (PARTITION BY l_orderkey) AS low, rank() OVER (PARTITION BY l_orderkey ORDER BY total ASC NULLS LAST) AS place FROM c)
SELECT l_orderkey, place, count(*) AS n, round(max(CASE WHEN low > 0 THEN total / low WHEN low = 0 AND total = 0 THEN 1.0 END), 6) AS multiple FROM r GROUP BY 1, 2"""
)
def cheapest_first(spark, sf_dir):
    r = rates.ranked(_costed(spark, sf_dir).select("l_orderkey", "l_linenumber", "total"), ["l_orderkey"])
    return r.groupBy("l_orderkey", "place").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("multiple"), 6).alias("multiple"))


@query("SELECT p_partkey, round(p_retailprice / 1000, 6) * 2 AS peak_input, CAST(p_size AS DOUBLE) AS peak_output, CASE WHEN p_size % 4 <> 0 THEN round(p_size / 10.0, 6) END AS peak_cache FROM part")
def peak_rates(spark, sf_dir):
    p = rates.peak(F.col("base"), F.col("overrides"))
    return entries(spark, sf_dir).select("p_partkey", p["input"].alias("peak_input"), p["output"].alias("peak_output"), p["cache_read"].alias("peak_cache"))


_FX = "fx AS (SELECT upper(substr(event_type, 1, 3)) AS currency, strftime(ts, '%Y-%m-%d') AS day, round(0.5 + min(value) / 100, 6) AS rate FROM events GROUP BY 1, 2)"


def _fx(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.upper(F.substring("event_type", 1, 3)).alias("currency"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.round(0.5 + F.min("value") / 100, 6).alias("rate"))


@query(f"WITH {OBS}, {_FX}, q AS (SELECT pos, upper(substr(source, 1, 3)) AS currency, observed_at, rate_input FROM obs) SELECT q.pos, q.currency, q.observed_at, fx.rate AS fx_rate, round(q.rate_input * fx.rate, 6) AS usd FROM q ASOF LEFT JOIN fx ON q.currency = fx.currency AND q.observed_at >= fx.day")
def fx_asof(spark, sf_dir):
    q = observations(spark, sf_dir).select("pos", F.upper(F.substring("source", 1, 3)).alias("currency"), "observed_at", "rate_input")
    fx = _fx(spark, sf_dir)
    got = temporal.as_of(q, fx, ("currency",), "observed_at", "day", ["rate"], "day")
    return got.select("pos", "currency", "observed_at", F.col("rate").alias("fx_rate"), F.round(F.col("rate_input") * F.col("rate"), 6).alias("usd"))


@query(
    """SELECT p_partkey, round(p_retailprice / 1e9 * 1.1 * 1e6, 6) AS input, round(p_size / 1e7 * 1.1 * 1e6, 6) AS output, CAST(CASE WHEN p_size % 3 = 0 THEN 2 WHEN p_size % 3 = 1 THEN 1 END AS INT) AS n_overrides,
CASE WHEN p_size % 3 < 2 THEN round(p_retailprice / 5e8 * 1.1 * 1e6, 6) END AS peak_input, CASE WHEN p_size % 3 = 0 THEN 'UTC' END AS zone FROM part"""
)
def built_rows(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size, factor = F.col("p_size"), F.lit(1.1)
    windows = F.when(size % 3 == 0, F.array(F.array(F.lit(100), F.lit(400)), F.array(F.lit(600), F.lit(1000))))
    own = rates.built_rates({"input": F.col("p_retailprice") / 1e9, "output": size / 1e7}, factor)
    over = rates.built_overrides(windows, {"input": F.when(size % 3 < 2, F.col("p_retailprice") / 5e8)}, factor)
    made = p.select("p_partkey", own.alias("r"), over.alias("o"))
    first = F.get(F.col("o"), 0)
    return made.select("p_partkey", F.col("r.input").alias("input"), F.col("r.output").alias("output"), F.when(F.col("o").isNotNull(), F.size("o")).alias("n_overrides"), first["rates"]["input"].alias("peak_input"), first["when"]["timezone"].alias("zone"))


@query(f"WITH {OBS} SELECT source, model_id, '2024-02-01' AS observed_at, true AS removed, arg_max(rate_input, pos) FILTER (NOT removed) AS rate_input FROM obs GROUP BY 1, 2 HAVING count(*) FILTER (NOT removed) > 0")
def removal_rows(spark, sf_dir):
    last = log.last_by_input(observations(spark, sf_dir), ["observed_at", "removed", "rate_input"]).where("last is not null")
    return last.select("source", "model_id", rates.removal_row(F.col("last"), F.lit("2024-02-01")).alias("r")).select("source", "model_id", "r.*")


def _candidates(spark, sf_dir):
    o, k = observations(spark, sf_dir), F.col("k")
    none = lambda t: F.lit(None).cast(t)
    fx = F.when(k % 7 == 1, F.when(k % 2 == 0, 1.1)).when(k % 19 == 3, 1.2)
    bad = F.array(_override({"window": F.array(F.lit(400), F.lit(100))}, _null_rates(input=F.lit(1.0))))
    good = F.array(_override({"mode": F.lit("fast")}, _null_rates(input=F.lit(1.0))))
    bare = F.array(_override({}, _null_rates(input=F.lit(1.0))))
    return o.select(
        "pos",
        F.when(k % 17 == 0, 3).otherwise(4).alias("schema"),
        "source",
        F.when(k % 13 == 0, "").otherwise(F.col("model_id")).alias("model_id"),
        F.when(k % 23 == 5, "chat").when(k % 23 == 6, "image").alias("modality"),
        F.when(k % 11 == 0, F.replace("observed_at", F.lit("-"), F.lit("/"))).otherwise(F.col("observed_at")).alias("observed_at"),
        "effective_at",
        F.when(F.col("removed"), True).when(k % 29 == 1, False).alias("removed"),
        F.when(k % 7 == 0, "usd").when(k % 7 == 1, "EUR").alias("currency"),
        F.when(k % 5 < 3, _null_rates(input=F.when(k % 5 == 0, -1.0).otherwise(F.col("rate_input")))).alias("rates"),
        F.when(k % 31 == 2, bad).when(k % 31 == 3, good).when(k % 31 == 4, bare).cast(OVERRIDES).alias("overrides"),
        none("struct<web_search:double,search:double,fetch:double>").alias("fees"),
        F.when(k % 37 == 8, F.struct(F.lit(0).cast("bigint").alias("context"), none("bigint").alias("output"))).alias("limits"),
        none("string").alias("unmapped"),
        F.when(fx.isNotNull(), F.struct(none("string").alias("url"), none("string").alias("name"), fx.alias("fx_rate"), none("string").alias("fx_rate_date"))).cast(PROVENANCE).alias("provenance"),
    )


@query(
    f"""WITH {OBS}, f AS (SELECT CASE WHEN k % 17 = 0 THEN 'schema' WHEN k % 13 = 0 THEN 'model_id' WHEN k % 23 = 5 THEN 'modality' WHEN k % 11 = 0 THEN 'observed_at' WHEN NOT removed AND k % 29 = 1 THEN 'removed' WHEN k % 7 = 0 THEN 'currency'
WHEN k % 5 < 3 AND CASE WHEN k % 5 = 0 THEN -1.0 ELSE rate_input END IS NULL THEN 'rates' WHEN k % 5 = 0 OR (k % 5 < 3 AND rate_input < 0) THEN 'rates' WHEN k % 37 = 8 THEN 'limits'
WHEN k % 7 = 1 AND k % 2 <> 0 THEN 'fx_rate' WHEN k % 7 <> 1 AND k % 19 = 3 THEN 'fx_pair' WHEN k % 31 IN (2, 4) THEN 'overrides' ELSE 'valid' END AS fault FROM obs)
SELECT fault, count(*) AS n FROM f GROUP BY 1"""
)
def validation_report(spark, sf_dir):
    return _candidates(spark, sf_dir).select(F.coalesce(validate.fault(), F.lit("valid")).alias("fault")).groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


def _bridge(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)  # nation has 25 rows at any scale
    return j.select(F.lower("n_name").alias("source"), (F.col("s_suppkey") * 2).cast("string").alias("model_id"), F.concat(F.lit("c"), (F.col("s_suppkey") % 40).cast("string")).alias("canonical"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 5 != 0, F.lower("n_name")).alias("vendor"))


def _keys(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return j.select(F.lower("n_name").alias("source"), F.col("c_custkey").cast("string").alias("model_id"))


_CAT = """b AS (SELECT lower(n_name) AS source, CAST(s_suppkey * 2 AS VARCHAR) AS model_id, 'c' || CAST(s_suppkey % 40 AS VARCHAR) AS canonical, s_name AS name, CASE WHEN s_suppkey % 5 <> 0 THEN lower(n_name) END AS vendor FROM supplier JOIN nation ON s_nationkey = n_nationkey),
k AS (SELECT lower(n_name) AS source, CAST(c_custkey AS VARCHAR) AS model_id FROM customer JOIN nation ON c_nationkey = n_nationkey),
one AS (SELECT source, model_id, arg_max(canonical, (canonical, name)) AS canonical, arg_max(name, (canonical, name)) AS name, arg_max(coalesce(vendor, ''), (canonical, name)) AS vendor FROM b GROUP BY 1, 2)"""


@query(f"WITH {_CAT} SELECT k.source, k.model_id, one.canonical, coalesce(nullif(one.name, ''), k.model_id) AS name, nullif(one.vendor, '') AS vendor FROM k LEFT JOIN one USING (source, model_id)")
def catalog_join(spark, sf_dir):
    got = catalog.with_catalog(_keys(spark, sf_dir), _bridge(spark, sf_dir))
    return got.withColumn("name", views.display_name(F.col("name"), F.lit(None).cast("string"), F.col("model_id")))


@query(f"WITH {_CAT} SELECT DISTINCT k.source, k.model_id, k.source || '/' || k.model_id AS canonical FROM k WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.source = k.source AND b.model_id = k.model_id)")
def seeds_anti(spark, sf_dir):
    return catalog.unclaimed(_keys(spark, sf_dir), _bridge(spark, sf_dir))


@query(f"WITH {_CAT} SELECT source, count(*) AS claims, count(*) FILTER (source < 'g' OR vendor IS DISTINCT FROM source) AS resold FROM b GROUP BY 1")
def resold_counts(spark, sf_dir):
    b = _bridge(spark, sf_dir).withColumn("own", F.when(F.col("source") >= "g", F.col("source")))
    return b.groupBy("source").agg(F.count(F.lit(1)).alias("claims"), F.count_if(catalog.resold(F.col("own"), F.col("vendor"))).alias("resold"))


_ID = "CASE p_partkey % 6 WHEN 0 THEN '@cf/' || p_brand || '/' || p_name WHEN 1 THEN p_brand || '/' || p_name WHEN 2 THEN 'gpt-' || p_size WHEN 3 THEN 'llama-gpt-' || p_size WHEN 4 THEN p_name ELSE 'a/b/' || p_name END"


@query(
    f"""WITH i AS (SELECT p_partkey, {_ID} AS model_id, CASE WHEN p_size % 2 = 0 THEN 'first_party' ELSE 'reseller' END AS kind, CASE WHEN p_size % 2 = 0 THEN p_type END AS pv FROM part)
SELECT p_partkey, model_id, CASE p_partkey % 6 WHEN 0 THEN lower(split_part(model_id, '/', 2)) WHEN 1 THEN lower(split_part(model_id, '/', 1)) WHEN 2 THEN 'openai' WHEN 3 THEN CASE WHEN kind = 'first_party' THEN lower(pv) END WHEN 4 THEN CASE WHEN kind = 'first_party' THEN lower(pv) END END AS vendor FROM i"""
)
def vendor_derive(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n, brand, name, size = F.col("p_partkey") % 6, F.col("p_brand"), F.col("p_name"), F.col("p_size").cast("string")
    model = F.when(n == 0, F.concat(F.lit("@cf/"), brand, F.lit("/"), name)).when(n == 1, F.concat(brand, F.lit("/"), name)).when(n == 2, F.concat(F.lit("gpt-"), size)).when(n == 3, F.concat(F.lit("llama-gpt-"), size)).when(n == 4, name).otherwise(F.concat(F.lit("a/b/"), name))
    first = F.col("p_size") % 2 == 0
    rows = p.select("p_partkey", model.alias("model_id"), F.when(first, F.col("p_type")).alias("pv"), F.when(first, "first_party").otherwise("reseller").alias("kind"))
    return rows.select("p_partkey", "model_id", catalog.vendor_of(F.col("model_id"), F.col("pv"), F.col("kind"), MAKERS).alias("vendor"))


@query(
    """WITH a AS (SELECT 'brand' || CAST(p_partkey // 4 AS VARCHAR) AS alias, CASE WHEN p_partkey % 4 > 0 THEN strftime(DATE '1992-01-01' + CAST(p_partkey % 4 * 600 AS INTEGER), '%Y-%m-%d') END AS f,
CASE WHEN p_partkey % 4 < 3 THEN strftime(DATE '1992-01-01' + CAST(p_partkey % 4 * 600 + 600 - p_partkey % 90 AS INTEGER), '%Y-%m-%d') END AS t, CAST(p_partkey AS VARCHAR) AS canonical FROM part),
p AS (SELECT o_orderkey, 'brand' || CAST(o_custkey // 3 AS VARCHAR) AS alias, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
SELECT p.o_orderkey, p.alias, p.day, a.canonical FROM p LEFT JOIN a ON p.alias = a.alias AND (f IS NULL OR f <= day) AND (t IS NULL OR day < t)"""
)
def alias_lookup(spark, sf_dir):
    return _alias_lookup(spark, sf_dir)


def _alias_lookup(spark, sf_dir):
    base, n = F.to_date(F.lit("1992-01-01")), F.col("p_partkey")
    at = (n % 4 * 600).cast("int")
    day = lambda d: F.date_format(F.date_add(base, d.cast("int")), "yyyy-MM-dd")
    a = table(spark, sf_dir, "part").select(F.concat(F.lit("brand"), F.floor(n / 4).cast("string")).alias("alias"), F.when(n % 4 > 0, day(at)).alias("valid_from"), F.when(n % 4 < 3, day(at + 600 - n % 90)).alias("valid_to"), n.cast("string").alias("canonical"))
    p = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("brand"), F.floor(F.col("o_custkey") / 3).cast("string")).alias("alias"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return catalog.alias_on(p, a)


@query(
    r"""WITH d AS (SELECT page_id, url, split_part(split_part(url, '://', 2), '/', 1) AS source, list_last(list_filter(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '/'), lambda x: x <> '')) AS last FROM pages),
e AS (SELECT *, coalesce(nullif(regexp_replace(regexp_replace(lower(last), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'index') AS slug FROM d)
SELECT page_id, slug, count(*) OVER (PARTITION BY source, slug) > 1 AS collides, 'state/announce/' || source || '/' || slug || CASE WHEN count(*) OVER (PARTITION BY source, slug) > 1 THEN '-' || substr(sha256(url), 1, 8) ELSE '' END || '.md' AS path FROM e"""
)
def channel_paths(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)).alias("source"), T.slug(F.col("url")).alias("slug"))
    return catalog.slug_collisions(rows, "source", "slug").select("page_id", "slug", "collides", "path")


_RUNS = f"""{OBS}, g AS (SELECT source, model_id, observed_at AS run, bool_or(k % 2 = 0) AS present FROM obs WHERE CAST(model_id AS INT) % 3 = 0 OR true GROUP BY 1, 2, 3),
r AS (SELECT *, day(CAST(run AS DATE)) % 6 <> 0 AS settled, CAST(model_id AS INT) % 9 = 0 AND day(CAST(run AS DATE)) % 4 = 1 AS held FROM g)"""


def _seen(spark, sf_dir):
    g = observations(spark, sf_dir).groupBy("source", "model_id", F.col("observed_at").alias("run")).agg(F.max(F.col("k") % 2 == 0).alias("present"))
    day = F.dayofmonth(F.to_date("run"))
    return g.withColumn("settled", day % 6 != 0).withColumn("held", (F.col("model_id").cast("int") % 9 == 0) & (day % 4 == 1))


@query(
    f"""WITH {_RUNS}, s AS (SELECT *, sum(CASE WHEN settled AND present THEN 1 ELSE 0 END) OVER (PARTITION BY source, model_id ORDER BY run) AS st, CASE WHEN settled AND NOT held AND NOT present THEN 1 ELSE 0 END AS ab FROM r),
n AS (SELECT *, sum(ab) OVER w AS n, min(CASE WHEN ab = 1 THEN run END) OVER w AS f FROM s WINDOW w AS (PARTITION BY source, model_id, st ORDER BY run ROWS UNBOUNDED PRECEDING))
SELECT source, model_id, run, CAST(least(n, 2) AS INT) AS absent_runs, CASE WHEN n > 0 THEN f END AS since, n = 2 AND ab = 1 AS removes FROM n"""
)
def absence_two_strikes(spark, sf_dir):
    return absence.two_strikes(_seen(spark, sf_dir)).select("source", "model_id", "run", "absent_runs", "since", "removes")


@query(
    f"""WITH {OBS}, h AS (SELECT source AS provider, model_id, observed_at AS run, bool_or(k % 3 = 1) AS hard FROM obs GROUP BY 1, 2, 3), p AS (SELECT provider || model_id AS provider, run, hard FROM h)
SELECT provider, run, hard AND coalesce(lag(hard) OVER w, false) AS alert, NOT hard AND coalesce(lag(hard) OVER w, false) AS recovered FROM p WINDOW w AS (PARTITION BY provider ORDER BY run)"""
)
def consecutive_failures(spark, sf_dir):
    g = observations(spark, sf_dir).groupBy(F.concat("source", "model_id").alias("provider"), F.col("observed_at").alias("run")).agg(F.max(F.col("k") % 3 == 1).alias("hard"))
    return absence.failing_twice(g)


_LOGS = """lines AS (SELECT event_id AS pos, CASE event_id % 3 WHEN 0 THEN 'job' || chr(9) || 'step' || chr(9) || '2024-01-01T00:00:00Z ' ELSE '' END || CASE WHEN event_id % 17 = 0 THEN '  File "x.py", line 3' ELSE 'ERROR:pkg.run:' || CASE event_type
WHEN 'click' THEN 'detector for ' || user_id || ' failed: x' WHEN 'view' THEN 'detect skip for ' || user_id || ': y' WHEN 'error' THEN 'refresh scrape failed for m (' || user_id || ')' WHEN 'signup' THEN 'openrouter fetch failed' ELSE 'all fine' END END AS line FROM events),
said AS (SELECT pos, line, CASE WHEN regexp_matches(line, '^(?:[^\\t\\n]*\\t[^\\t\\n]*\\t\\S+ )?[A-Z]+:[\\w.]+:') THEN regexp_replace(line, '^(?:[^\\t\\n]*\\t[^\\t\\n]*\\t\\S+ )?[A-Z]+:[\\w.]+:', '') END AS m FROM lines),
found AS (SELECT pos, CASE WHEN starts_with(m, 'detector for') THEN regexp_extract(m, '^detector for (\\S+) failed', 1) WHEN starts_with(m, 'refresh') THEN regexp_extract(m, '\\((\\S+)\\)', 1) WHEN starts_with(m, 'openrouter') THEN 'openrouter' WHEN starts_with(m, 'detect skip') THEN regexp_extract(m, '^detect skip for (\\S+):', 1) END AS provider, CASE WHEN starts_with(m, 'detect skip') THEN 'soft' ELSE 'hard' END AS class FROM said WHERE m IS NOT NULL AND m <> 'all fine')"""


def _logs(spark, sf_dir):
    user, kind, i = F.col("user_id").cast("string"), F.col("event_type"), F.col("event_id")
    said = F.when(kind == "click", F.concat(F.lit("detector for "), user, F.lit(" failed: x"))).when(kind == "view", F.concat(F.lit("detect skip for "), user, F.lit(": y"))).when(kind == "error", F.concat(F.lit("refresh scrape failed for m ("), user, F.lit(")"))).when(kind == "signup", "openrouter fetch failed").otherwise("all fine")
    prefix = F.when(i % 3 == 0, "job\tstep\t2024-01-01T00:00:00Z ").otherwise("")
    line = F.concat(prefix, F.when(i % 17 == 0, '  File "x.py", line 3').otherwise(F.concat(F.lit("ERROR:pkg.run:"), said)))
    return table(spark, sf_dir, "events").select(i.alias("pos"), line.alias("line"))


@query(f"WITH {_LOGS} SELECT pos, provider, class FROM found")
def log_issues(spark, sf_dir):
    return ops.issues(_logs(spark, sf_dir)).select("pos", "provider", "class")


@query(f"WITH {_LOGS} SELECT provider, count(*) FILTER (class = 'hard') AS hard, count(*) FILTER (class = 'soft') AS soft, CASE WHEN count(*) FILTER (class = 'hard') > 0 THEN 'hard' ELSE 'soft' END AS level FROM found GROUP BY 1")
def issue_summary(spark, sf_dir):
    return ops.issue_summary(ops.issues(_logs(spark, sf_dir)))


@query(f"WITH {_LOGS}, t AS (SELECT provider, pos, CAST(row_number() OVER (PARTITION BY provider ORDER BY pos DESC) AS INT) AS back FROM found WHERE class = 'hard') SELECT * FROM t WHERE back <= 6")
def last_errors(spark, sf_dir):
    return ops.last_errors(ops.issues(_logs(spark, sf_dir))).select("provider", "pos", "back")


@query(
    """WITH c AS (SELECT user_id AS number, event_id AS pos, CASE WHEN user_id % 2 = 0 THEN 'abc1234' ELSE 'def567890' END AS head, CASE event_type WHEN 'click' THEN 'yes' WHEN 'view' THEN 'no' END AS said,
CASE event_id % 4 WHEN 0 THEN 'abc1234' WHEN 1 THEN 'def567890' END AS stamp FROM events WHERE event_id % 5 > 0 AND event_id % 4 < 3),
l AS (SELECT number, head, arg_max(said, pos) AS said, arg_max(coalesce(stamp, ''), pos) AS stamp FROM c WHERE said IS NOT NULL GROUP BY 1, 2)
SELECT number, CASE WHEN stamp = head THEN said END AS verdict, nullif(stamp, '') AS stamp, stamp = head AS bound FROM l"""
)
def verdict_fold(spark, sf_dir):
    """The bot's verdict lines stand anywhere in a comment, the last one counts; every fifth comment is a reader's, every fourth has a stamp too short to be one."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    said = F.when(F.col("event_type") == "click", "yes").when(F.col("event_type") == "view", "no")
    stamp = F.when(i % 4 == 0, " abc1234").when(i % 4 == 1, " def567890").when(i % 4 == 3, " abc12").otherwise("")
    body = F.when(said.isNotNull(), F.concat(F.lit("automerge: yes 0000000\nlooks fine\n  automerge: "), said, stamp, F.lit("  \nthanks"))).otherwise("automerge: maybe")
    body = F.when(said.isNotNull() & (i % 4 == 3), F.concat(F.lit("automerge: "), said, stamp)).otherwise(body)
    rows = e.select(F.col("user_id").alias("number"), i.alias("pos"), F.when(i % 5 > 0, "bot").otherwise("reader").alias("author"), F.when(F.col("user_id") % 2 == 0, "abc1234").otherwise("def567890").alias("head"), body.alias("body"))
    return ops.verdicts(rows, "bot")


def _snapshots(spark, sf_dir):
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    row = p.select(i, F.concat(F.lit("s"), (i % 7).cast("string")).alias("source"), F.concat(F.lit("u"), i.cast("string")).alias("url"))
    before = row.where("page_id % 5 <> 0").withColumn("sha", F.sha2(F.col("url"), 256))
    after = row.where("page_id % 6 <> 0").withColumn("sha", F.when(i % 4 == 0, F.sha2(F.lit("x"), 256)).otherwise(F.sha2(F.col("url"), 256)))
    return before, after


@query("SELECT 's' || page_id % 7 AS source, 'u' || page_id AS url, CASE WHEN page_id % 5 = 0 THEN 'added' WHEN page_id % 6 = 0 THEN 'removed' ELSE 'changed' END AS change FROM pages WHERE NOT (page_id % 5 = 0 AND page_id % 6 = 0) AND (page_id % 5 = 0 OR page_id % 6 = 0 OR page_id % 4 = 0)")
def channel_changes(spark, sf_dir):
    return ops.channel_changes(*_snapshots(spark, sf_dir))


@query(
    """WITH r AS (SELECT 's' || page_id % 3 AS source, 'u' || page_id % 50 AS url, sha256(CAST(page_id AS VARCHAR)) AS sha, CAST(page_id % 4 AS VARCHAR) AS fetched, CASE WHEN page_id % 9 = 0 THEN 1 << 30 ELSE page_id END AS number FROM pages)
SELECT source, url, arg_max(sha, (fetched, number, CASE WHEN number = 1 << 30 THEN sha ELSE '' END)) AS sha, max(fetched) AS fetched, arg_max(number, (fetched, number)) = 1 << 30 AS from_base FROM r GROUP BY 1, 2"""
)
def resolved_channels(spark, sf_dir):
    i = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("s"), (i % 3).cast("string")).alias("source"), F.concat(F.lit("u"), (i % 50).cast("string")).alias("url"), F.sha2(i.cast("string"), 256).alias("sha"), (i % 4).cast("string").alias("fetched"), i.alias("number"))
    base = rows.where("number % 9 = 0").groupBy("source", "url").agg(F.max_by(F.struct("sha", "fetched"), F.struct("fetched", "sha")).alias("x")).select("source", "url", "x.*")
    return ops.resolved_channels(base, rows.where("number % 9 <> 0"))


@query(f"WITH {CHAIN}, v AS (SELECT source, model_id, min(observed_at) AS first_seen FROM obs GROUP BY 1, 2), c AS (SELECT source, model_id, count(*) AS items, string_agg(valid_from, ',' ORDER BY valid_from, observed_at, pos) AS starts FROM chain GROUP BY 1, 2) SELECT * FROM v JOIN c USING (source, model_id)")
def flat_view(spark, sf_dir):
    obs = observations(spark, sf_dir)
    rows = views.flat(log.partition_view(obs, F.col("rate_input")), temporal.interval_chain(obs))
    return rows.select("source", "model_id", "first_seen", F.size("intervals").cast("bigint").alias("items"), F.array_join("intervals.valid_from", ",").alias("starts"))


@query(f"WITH {OBS} SELECT source, count(DISTINCT model_id) AS models FROM obs GROUP BY 1")
def nested_index(spark, sf_dir):
    rows = log.partition_view(observations(spark, sf_dir), F.col("rate_input"))
    made = views.index(rows)
    return made.select("source", F.size(F.json_object_keys("entries")).cast("bigint").alias("models"))


@query(f"WITH {OBS}, v AS (SELECT source, model_id, arg_max(rate_input, (observed_at, pos)) FILTER (NOT removed) AS r FROM obs GROUP BY 1, 2) SELECT source, model_id, CAST(row_number() OVER (PARTITION BY source ORDER BY r DESC NULLS LAST, model_id) AS INT) AS place FROM v")
def null_last_order(spark, sf_dir):
    rows = log.partition_view(observations(spark, sf_dir), F.col("rate_input"))
    return places_in(rows.select("source", "model_id", "priced"), ["source"], [F.col("priced").desc_nulls_last(), "model_id"]).drop("priced")


@query(f"WITH {OBS}, v AS (SELECT source, model_id, arg_max(rate_input, (observed_at, pos)) FILTER (NOT removed) AS r FROM obs GROUP BY 1, 2) SELECT source, model_id, CAST(row_number() OVER (PARTITION BY source ORDER BY r ASC NULLS LAST, model_id) AS INT) AS place FROM v")
def null_last_rising(spark, sf_dir):
    rows = log.partition_view(observations(spark, sf_dir), F.col("rate_input"))
    return places_in(rows.select("source", "model_id", "priced"), ["source"], [F.col("priced").asc_nulls_last(), "model_id"]).drop("priced")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 20")
def oldest_waiting(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").orderBy("o_orderkey").limit(20).select("o_orderkey", "o_orderpriority")


@query(f"WITH {OBS}, f AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY pos) AS n FROM obs) SELECT model_id, pos, source FROM f WHERE n = 1")
def first_of_each(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.groupBy("model_id").agg(F.min("pos").alias("pos"), F.min_by("source", "pos").alias("source"))


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring')")
def search(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.contains(F.lower("p_name"), F.lit("ring")) | F.contains(F.lower("p_brand"), F.lit("ring"))).select("p_partkey", "p_name", "p_brand")


@query(
    """SELECT p_partkey, printf('%02d:%02d', CAST(p_partkey % 24 AS INT), CAST(p_size AS INT)) AS clock, printf('%02d:%02d', CAST(p_partkey * 7 % 1440 // 60 AS INT), CAST(p_partkey * 7 % 60 AS INT)) AS at,
trim(regexp_replace(replace(lower(p_name || ' & ' || p_type), '&', ' and '), '\\s+', ' ', 'g')) AS heading, replace(replace(replace(p_name || '<&>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS html, regexp_replace(CAST(p_size AS VARCHAR), '\\.0$', '') AS rate, strftime(DATE '2024-01-01' + CAST(p_size AS INTEGER), '%A') AS weekday FROM part"""
)
def text_scalars(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    return p.select(
        "p_partkey",
        T.clock(k % 24 * 100 + F.col("p_size")).alias("clock"),
        T.clock_of_minutes(k * 7).alias("at"),
        T.fold_heading(F.concat("p_name", F.lit(" & "), "p_type")).alias("heading"),
        T.html(F.concat("p_name", F.lit("<&>"))).alias("html"),
        T.rate(F.col("p_size").cast("double")).alias("rate"),
        F.initcap(T.weekday(F.date_add(F.to_date(F.lit("2024-01-01")), F.col("p_size")))).alias("weekday"),
    )


@query("SELECT doc_id, sha256(text) AS sha, length(text) AS chars FROM documents")
def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.length("text").cast("bigint").alias("chars"))


@query("SELECT page_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(html, '<(script|style|noscript)\\b.*?</(script|style|noscript)\\s*>', ' ', 'gis'), '<[^>]*>', ' ', 'gs'), '\\s+', ' ', 'g'))) AS sha FROM pages")
def page_prose(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(T.prose(F.col("html")), 256).alias("sha"))


@query(
    """WITH p AS (SELECT p_partkey, CAST(p_partkey * 37 % 1440 AS INT) AS s, CAST(p_partkey * 53 % 1440 AS INT) AS e, CAST((p_partkey % 25 - 12) * 60 AS INT) AS o FROM part),
w AS (SELECT p_partkey, s - o AS a, CASE WHEN e <= s THEN 1440 ELSE e END - o AS b FROM p), f AS (SELECT p_partkey, CAST(floor(a / 1440.0) AS INT) AS d, a, b FROM w),
u AS (SELECT p_partkey, d, a - d * 1440 AS a, b - d * 1440 AS b FROM f)
SELECT p_partkey, CAST(0 AS INT) AS part, a AS "start", least(b, 1440) AS "end", d AS shift FROM u UNION ALL SELECT p_partkey, 1, 0, b - 1440, d + 1 FROM u WHERE b > 1440"""
)
def utc_windows(spark, sf_dir):
    k = F.col("p_partkey")
    start, end = (k * 37 % 1440).cast("int"), (k * 53 % 1440).cast("int")
    windows = K.utc(start, F.when(end <= start, 1440).otherwise(end), ((k % 25 - 12) * 60).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(windows).alias("part", "w")).select("p_partkey", "part", "w.start", "w.end", "w.shift")


@query(
    """WITH d AS (SELECT p_partkey, unnest(['monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'saturday', 'sunday']) AS name, unnest([0, 1, 2, 3, 4, 5, 6]) AS i, CAST(p_partkey % 7 AS INT) AS a, CAST(p_size % 7 AS INT) AS b FROM part)
SELECT p_partkey, string_agg(name, ',' ORDER BY i) FILTER ((i - a + 7) % 7 <= (b - a + 7) % 7) AS days, string_agg(name, ',' ORDER BY i) FILTER ((i + 1 - a + 7) % 7 <= (b - a + 7) % 7) AS before FROM d GROUP BY 1"""
)
def weekday_sets(spark, sf_dir):
    from ..schema import DAYS

    name = lambda i: F.get(F.array(*[F.lit(d) for d in DAYS]), i.cast("int"))
    days = K.day_range(name(F.col("p_partkey") % 7), name(F.col("p_size") % 7))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(days, ",").alias("days"), F.array_join(K.shifted(days, F.lit(-1)), ",").alias("before"))


@query(
    """SELECT 'p' || p_partkey AS model_id, CASE WHEN p_size % 5 = 0 THEN 'image' END AS modality, round(p_retailprice / 1e9 * 1e6, 6) AS input, CASE WHEN p_size % 3 > 0 THEN round(p_size / 1e8 * 1e6, 6) END AS output, CASE WHEN p_size % 2 = 0 THEN 0.01 END AS fee, p_size * 1000 AS context FROM part WHERE p_partkey % 10 <> 0"""
)
def listing(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    quote = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    pricing = F.concat(F.lit('{"prompt":'), quote(F.col("p_retailprice") / 1e9), F.lit(',"completion":'), quote(F.when(size % 3 > 0, size / 1e8).otherwise(-1.0)), F.when(size % 2 == 0, F.lit(',"web_search":"0.01"')).otherwise(""), F.lit("}"))
    entry = F.concat(F.lit('{"id":"p'), k.cast("string"), F.lit('","name":"V: N","context_length":'), (size * 1000).cast("string"), F.when(k % 10 == 0, F.lit(',"alias_target":"x"')).otherwise(""), F.when(size % 5 == 0, F.lit(',"architecture":{"output_modalities":["image"]}')).otherwise(""), F.lit(',"pricing":'), pricing, F.lit("}"))
    bodies = table(spark, sf_dir, "part").groupBy((k % 8).alias("page")).agg(F.concat(F.lit('{"data":['), F.array_join(F.collect_list(entry), ","), F.lit("]}")).alias("body"))
    rows = listing_rows(bodies, "api", "2024-01-01")
    return rows.select("model_id", "modality", F.col("rates.input").alias("input"), F.col("rates.output").alias("output"), F.col("fees.web_search").alias("fee"), F.col("limits.context").alias("context"))


@query("SELECT p_partkey, p_size % 4 <> 0 AND p_size / 10.0 > round(p_retailprice / 1000, 6) AS implausible FROM part")
def implausible_pairs(spark, sf_dir):
    return entries(spark, sf_dir).select("p_partkey", merge.implausible(F.col("base"), F.col("overrides")).alias("implausible"))


@query(
    f"""WITH {OBS}, o AS (SELECT *, {_LINE} AS line, CAST(pos % 7 AS INT) AS branch FROM obs), b AS (SELECT * FROM o WHERE pos % 2 = 0), n AS (SELECT * FROM o WHERE pos % 2 = 1 AND line NOT IN (SELECT line FROM b)),
c AS (SELECT n.branch, count(*) AS appended, count(DISTINCT CASE WHEN k2.source IS NULL THEN n.source || '/' || n.model_id END) AS created, count(*) FILTER (n.removed) AS removed FROM n LEFT JOIN (SELECT DISTINCT source, model_id FROM b) k2 ON n.source = k2.source AND n.model_id = k2.model_id GROUP BY 1)
SELECT branch, CASE WHEN created > 50 THEN 'created' WHEN removed > 50 THEN 'removed' WHEN appended > 500 THEN 'appended' END AS exceeds FROM c"""
)
def churn_bounds(spark, sf_dir):
    return merge.within_bounds(churn_counts(spark, sf_dir)).select("branch", "exceeds")


@query(
    """WITH b AS (SELECT page_id % 40 AS id, min('h' || page_id) AS text FROM pages WHERE page_id % 2 = 0 GROUP BY 1), x AS (SELECT page_id % 60 AS id, 'b' || page_id AS text, page_id AS branch FROM pages WHERE page_id % 2 = 1)
SELECT id, text FROM b UNION ALL SELECT id, arg_min(text, branch) AS text FROM x WHERE id NOT IN (SELECT id FROM b) GROUP BY id"""
)
def rule_union(spark, sf_dir):
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    head = p.where(i % 2 == 0).groupBy((i % 40).alias("id")).agg(F.min(F.concat(F.lit("h"), i.cast("string"))).alias("text"))
    return merge.rule_union(head, p.where(i % 2 == 1).select((i % 60).alias("id"), F.concat(F.lit("b"), i.cast("string")).alias("text"), i.alias("branch")))


@query(
    """WITH t AS (SELECT l_partkey AS sku, CASE l_returnflag WHEN 'A' THEN 'input' ELSE 'output' END AS axis, min(l_extendedprice) AS rate, max(strftime(l_shipdate, '%Y-%m-%d')) AS day FROM lineitem GROUP BY 1, 2)
SELECT p_partkey AS sku, max(CASE WHEN axis = 'input' THEN rate END) AS rate_in, max(CASE WHEN axis = 'output' THEN rate END) AS rate_out, max(day) AS effective FROM part JOIN t ON p_partkey = sku GROUP BY 1"""
)
def product_terms(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    terms = li.groupBy(F.col("l_partkey").alias("sku"), F.when(F.col("l_returnflag") == "A", "input").otherwise("output").alias("axis")).agg(F.min("l_extendedprice").alias("rate"), F.max(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("day"))
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku"), F.col("p_partkey").cast("string").alias("product"))
    got = merge.effective_terms(products, terms)
    return got.select(F.col("product").cast("bigint").alias("sku"), F.try_element_at("rates", F.lit("input")).alias("rate_in"), F.try_element_at("rates", F.lit("output")).alias("rate_out"), "effective")


@query(f"WITH {OBS}, c AS (SELECT DISTINCT source, model_id FROM obs WHERE k % 5 = 0) SELECT o.pos FROM obs o WHERE NOT removed AND k % 5 <> 0 AND NOT EXISTS (SELECT 1 FROM c WHERE c.source = o.source AND c.model_id = o.model_id)")
def uncovered_rows(spark, sf_dir):
    o = observations(spark, sf_dir)
    return merge.uncovered(o.where("k % 5 <> 0"), o.where("k % 5 = 0")).select("pos")


@query(
    """WITH b AS (SELECT page_id % 30 AS url, max(page_id % 7) AS sha, max(page_id % 5) AS fetched FROM pages WHERE page_id % 3 = 0 GROUP BY 1), x AS (SELECT page_id AS number, page_id % 45 AS url, page_id % 7 AS sha, page_id % 5 AS fetched FROM pages WHERE page_id % 3 <> 0)
SELECT x.number, x.url FROM x LEFT JOIN b USING (url) WHERE b.sha IS NULL OR (x.sha <> b.sha AND x.fetched > b.fetched)"""
)
def channel_carriers(spark, sf_dir):
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    base = p.where(i % 3 == 0).groupBy((i % 30).alias("url")).agg(F.max(i % 7).alias("sha"), F.max(i % 5).alias("fetched")).withColumn("source", F.lit("s"))
    rows = p.where(i % 3 != 0).select(i.alias("number"), F.lit("s").alias("source"), (i % 45).alias("url"), (i % 7).alias("sha"), (i % 5).alias("fetched"))
    return merge.carriers(base, rows).select("number", "url")


@query(f"WITH {OBS}, d AS (SELECT DISTINCT source, model_id FROM obs WHERE pos % 3 = 0) SELECT source, model_id, NOT EXISTS (SELECT 1 FROM obs h WHERE h.source = d.source AND h.model_id = d.model_id AND h.pos % 3 = 2) AS emits FROM d WHERE NOT EXISTS (SELECT 1 FROM obs s WHERE s.source = d.source AND s.model_id = d.model_id AND s.pos % 3 = 1)")
def scrape_candidates(spark, sf_dir):
    o = observations(spark, sf_dir)
    return candidates.to_scrape(o.where("pos % 3 = 0"), o.where("pos % 3 = 1"), o.where("pos % 3 = 2"))


@query(f"WITH {OBS} SELECT source || model_id AS provider, count(*) AS attempts FROM obs GROUP BY 1 HAVING count(*) FILTER (k % 4 = 1) = 0")
def priced_none(spark, sf_dir):
    o = observations(spark, sf_dir)
    return candidates.priced_none(o.select(F.concat("source", "model_id").alias("provider"), (F.col("k") % 4 == 1).alias("priced")))


@query("SELECT p_partkey AS model, CAST(p_size * 1000 AS BIGINT) AS bound, CASE WHEN p_size % 3 < 2 THEN p_retailprice END AS base, CASE WHEN p_size % 3 > 0 THEN p_retailprice * 2 END AS over FROM part")
def tier_pairs(spark, sf_dir):
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    row = lambda kind, rate: p.select(F.col("p_partkey").alias("model"), (size * 1000).cast("bigint").alias("bound"), F.lit(kind).alias("kind"), rate.alias("rate"))
    return candidates.tiers(row("up to", F.col("p_retailprice")).where("bound / 1000 % 3 < 2").unionByName(row("over", F.col("p_retailprice") * 2).where("bound / 1000 % 3 > 0")))


@query("WITH c AS (SELECT 's' || page_id % 3 AS source, 'u' || page_id % 40 AS url, page_id AS number, CASE WHEN page_id % 4 > 0 THEN CAST(page_id % 4 AS VARCHAR) END AS fetched, CASE page_id % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE '' END AS verdict FROM pages), n AS (SELECT source, url, arg_max(verdict, (coalesce(fetched, ''), number)) AS v FROM c GROUP BY 1, 2) SELECT source, url FROM n WHERE v <> 'yes'")
def held_channels(spark, sf_dir):
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    rows = p.select(F.concat(F.lit("s"), (i % 3).cast("string")).alias("source"), F.concat(F.lit("u"), (i % 40).cast("string")).alias("url"), i.alias("number"), F.when(i % 4 > 0, (i % 4).cast("string")).alias("fetched"), F.when(i % 5 == 0, "yes").when(i % 5 == 1, "no").alias("verdict"))
    return candidates.held_channels(rows)


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN round(p_retailprice * (100 - p_size) / 100, 6) WHEN 1 THEN 7.25 ELSE p_retailprice END AS price FROM part")
def promotions(spark, sf_dir):
    size, price = F.col("p_size"), F.col("p_retailprice")
    text = F.when(size % 3 == 0, F.concat(F.lit("now "), F.lpad(size.cast("string"), 2, "0"), F.lit("% off"))).when(size % 3 == 1, "limited: $7.25").otherwise("list")
    return table(spark, sf_dir, "part").select("p_partkey", candidates.promoted(text, price).alias("price"))


@query("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - CAST(isodow(o_orderdate) - 1 AS INTEGER), '%Y-%m-%d') AS week, CAST(isodow(o_orderdate) - 1 AS INT) AS place, 'rows/' || regexp_replace(o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR), '[^A-Za-z0-9._-]', '-', 'g') || '-' || substr(sha256(o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS branch FROM orders")
def calendar_and_branches(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(K.week_row(day), "yyyy-MM-dd").alias("week"), F.weekday(day).alias("place"), candidates.branch_name(F.concat_ws("/", "o_orderpriority", F.col("o_orderkey").cast("string"))).alias("branch"))


_PATHS = (("data/history/a.ndjson", "shard"), ("data/history/a/b.ndjson", "other"), ("data/catalog/models.json", "exact"), ("data/catalog/aliases.json", "other"), ("state/announce/index.json", "announce"), ("state/announce/s/p.md", "announce"), ("state/announce/p.md", "other"), ("state/announce/s/t/p.md", "other"), ("state/absence/s.json", "absence"), ("state/absence/s/t.json", "other"), ("README.md", "other"))


@query("WITH p AS (SELECT page_id, CAST(page_id % 11 AS INT) AS n FROM pages), v AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(_PATHS)) + ") t(n, path, kind)) SELECT page_id, path, kind FROM p JOIN v USING (n)")
def path_kinds(spark, sf_dir):
    path = F.get(F.array(*[F.lit(a) for a, _ in _PATHS]), (F.col("page_id") % 11).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), candidates.path_kind(path).alias("kind"))


@query("SELECT p_partkey, '#m=' || replace(p_name, ' ', '+') || '&s=' || CAST(p_size AS VARCHAR) AS fragment, p_name AS name FROM part")
def fragments(spark, sf_dir):
    state = F.create_map(F.lit("s"), F.col("p_size").cast("string"), F.lit("m"), F.col("p_name"))
    made = table(spark, sf_dir, "part").select("p_partkey", candidates.encoded(state).alias("fragment"))
    return made.withColumn("name", F.try_element_at(candidates.decoded(F.col("fragment")), F.lit("m")))


_USD = "CASE WHEN {x} >= 1 THEN CASE WHEN {x} * 8 = floor({x} * 8) AND CAST({x} * 8 AS BIGINT) % 2 = 1 THEN printf('$%.2f', {x} + 0.001) ELSE printf('$%.2f', {x}) END WHEN {x} >= 0.01 THEN CASE WHEN {x} * 32 = floor({x} * 32) AND CAST({x} * 32 AS BIGINT) % 2 = 1 THEN printf('$%.4f', {x} + 0.00001) ELSE printf('$%.4f', {x}) END ELSE '$0.00' END"


@query(f"WITH x AS (SELECT p_partkey, p_retailprice / p_size AS a, p_retailprice / p_size / 1000 AS b FROM part) SELECT p_partkey, {_USD.format(x='a')} AS usd, {_USD.format(x='b')} AS small, {_USD.format(x='(a - a)')} AS nothing FROM x")
def usd_texts(spark, sf_dir):
    """Of two texts as close the larger one; SQL prints exactly too, but ties to even, so it lifts the ties, which only eighths and thirty-seconds are."""
    x = F.col("p_retailprice") / F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", T.usd(x).alias("usd"), T.usd(x / 1000).alias("small"), T.usd(x - x).alias("nothing"))


def amount_scan(spark, sf_dir):
    """Readable dollar amounts of every document; tested against cases by hand, as SQL has no such grammar."""
    from ..functions.money import scan_amounts

    return scan_amounts(table(spark, sf_dir, "documents"), "doc_id", "text", before="$")


def page_tables(spark, sf_dir):
    """Rows of all HTML tables of all pages; tested by hand."""
    from ..functions.tables import tables_of

    return tables_of(table(spark, sf_dir, "pages"), "page_id", "html")


#: Slices of time of an alias with many records.
ALIAS_SLICES = 32


def alias_lookup_all(spark, sf_dir):
    """Aliases whose records overlap, so that a day may have several; tested by brute force."""
    base, n = F.to_date(F.lit("1995-01-01")), F.col("p_partkey")
    at = (n % 40 * 30).cast("int")
    a = table(spark, sf_dir, "part").select(F.concat(F.lit("brand"), F.col("p_size").cast("string")).alias("alias"), F.when(n % 3 > 0, F.date_format(F.date_add(base, at), "yyyy-MM-dd")).alias("valid_from"), F.when(n % 5 > 0, F.date_format(F.date_add(base, at + 60), "yyyy-MM-dd")).alias("valid_to"), n.cast("string").alias("canonical"))
    p = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("brand"), (F.col("o_custkey") % 50).cast("string")).alias("alias"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return catalog.alias_on(p, a, cuts=temporal.cuts_of(p, "day", ALIAS_SLICES))


QUERIES |= {"amount_scan": amount_scan, "page_tables": page_tables, "alias_lookup_all": alias_lookup_all}

from . import details as _details  # noqa: E402  the queries below use the tables above
from . import more as _more  # noqa: E402
from . import priced_pages as _priced_pages  # noqa: E402

QUERIES |= _more.QUERIES | _priced_pages.QUERIES | _details.QUERIES
SQL |= _more.SQL | _priced_pages.SQL | _details.SQL
