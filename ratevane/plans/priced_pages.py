"""Ten more sources over pages written from parts, each with the forms that its pages take: tiers, modes, promotions, windows, faults.

A part is one model of a page, or, where a source names few fixed models, a page of a run of its own. The SQL tells from the part alone what
must stand on the page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import registry
from ..sources.observations import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
c, lit = F.col, F.lit
#: Models on a page.
PER_PAGE = 500
#: Columns of every query and, in SQL, what stands there where a source says nothing of it.
COLUMNS = {"run": "VARCHAR", "model_id": "VARCHAR", "currency": "VARCHAR", "input": "DOUBLE", "output": "DOUBLE", "cache_read": "DOUBLE", "cache_write": "DOUBLE", "cache_write_1h": "DOUBLE", "context": "BIGINT", "effective_at": "VARCHAR", "fee": "DOUBLE", "entries": "VARCHAR", "fault": "VARCHAR"}


def text(*parts: Column | str) -> Column:
    return F.concat(*[lit(x) if isinstance(x, str) else x for x in parts])


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part's name m, its kind k (0 to 3) and prices as texts: input i, output o, cached r, twice those (ii, oo)."""
    size = c("p_size")
    money = lambda x, places=2: F.format_string(f"%.{places}f", x)
    return table(spark, sf_dir, "part").select("p_partkey", c("p_partkey").cast("string").alias("n"), text("m", c("p_partkey").cast("string")).alias("m"), (c("p_partkey") % 4).alias("k"), money(size / 4.0).alias("i"), money(size / 2.0).alias("o"), money(size / 8.0, 3).alias("r"), money(size / 2.0).alias("ii"), money(size * 1.0).alias("oo"))


def _by(*kinds: Column | str) -> Column:
    """One of four texts by the part's kind."""
    out = lit(None).cast("string")
    for k, x in reversed(list(enumerate(kinds))):
        out = F.when(c("k") == k, text(x)).otherwise(out)
    return out


def _shared(parts: DataFrame, source: str, *pieces: Column | str) -> DataFrame:
    """Pages of PER_PAGE models: texts stand once, columns once for each model, in the order of the parts."""
    own = [(f"x{j}", x) for j, x in enumerate(pieces) if isinstance(x, Column)]
    lists = parts.select("p_partkey", F.floor(c("p_partkey") / PER_PAGE).alias("g"), *[x.alias(n) for n, x in own]).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("p_partkey", *[n for n, _ in own]))).alias("rows"))
    joined = [F.array_join(c(f"rows.x{j}"), "") if isinstance(x, Column) else lit(x) for j, x in enumerate(pieces)]
    return lists.select(lit(source).alias("source"), text("u", c("g").cast("string")).alias("url"), F.concat(*joined).alias("body"))


def _alone(parts: DataFrame, source: str, body: Column, url: str = "u") -> DataFrame:
    """A page of each part in a run of its own; parts are dealt out first, as a short row makes a long page."""
    dealt = parts.repartition(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return dealt.select(lit(source).alias("source"), lit(url).alias("url"), body.alias("body"), text("r", c("n")).alias("run"))


def cells(*x: Column | str) -> Column:
    return text("<tr>", *[text("<td>", v, "</td>") for v in x], "</tr>")


def pipe(*x: Column | str) -> Column:
    return text("|", *[text(" ", v, " |") for v in x], "\n")


def _head(*labels: str) -> str:
    return "<table><thead><tr>" + "".join(f"<th>{x}</th>" for x in labels) + "</tr></thead><tbody>"


def _pipes(*labels: str) -> str:
    return "| " + " | ".join(labels) + " |\n|" + "---|" * len(labels) + "\n"


def _shown(priced: DataFrame) -> DataFrame:
    """COLUMNS of PRICED rows; an override is written as its bound, mode, days, window and rates."""
    part = lambda x: F.coalesce(x.cast("string"), lit("-"))
    price = lambda x: F.coalesce(F.round(x * 1000).cast("bigint").cast("string"), lit("-"))
    entry = lambda o: F.concat_ws(" ", part(o["when"]["min_tokens"]), part(o["when"]["mode"]), part(F.size(o["when"]["days"])), F.coalesce(F.array_join(o["when"]["window"], "-"), lit("-")), price(o["rates"]["input"]), price(o["rates"]["output"]))
    fee = F.coalesce("fees.web_search", "fees.search")
    return priced.select("run", "model_id", "currency", *[c(f"rates.{a}").alias(a) for a in ("input", "output", "cache_read", "cache_write", "cache_write_1h")], "limits.context", "effective_at", fee.alias("fee"), F.array_join(F.transform("overrides", entry), "; ").alias("entries"), "fault")


def _sql(rows: str, **known: str) -> str:
    """SQL of COLUMNS over `rows`, a FROM clause on p (k, n and the prices i, o, r); what isn't known is null, the currency dollars."""
    known = {"currency": "'USD'"} | known
    own = ", ".join(f"CAST({known.get(x, 'NULL')} AS {kind}) AS {x}" for x, kind in COLUMNS.items())
    return f"WITH p AS (SELECT p_partkey % 4 AS k, CAST(p_partkey AS VARCHAR) AS n, p_size / 4.0 AS i, p_size / 2.0 AS o, p_size / 8.0 AS r, p_size AS s FROM part) SELECT {own} FROM {rows}"


def _when(**kinds: str) -> str:
    return "CASE k " + " ".join(f"WHEN {k[1:]} THEN {x}" for k, x in kinds.items()) + " END"


def source(sql: str):
    """A query of the priced rows of one source's pages, with its SQL."""

    def put(f):
        name = f.__name__

        def priced(spark, sf_dir):
            return _shown(registry.all_priced(f(_parts(spark, sf_dir)), (name,)))

        priced.__name__, priced.__doc__ = f"priced_{name}", f.__doc__
        QUERIES[priced.__name__], SQL[priced.__name__] = priced, sql
        return f

    return put


@source(_sql("p", run="'r' || n", model_id="'amazon.nova-lite-v1:0'", input=_when(_0="i", _1="i", _2="i"), output=_when(_0="o", _1="o", _2="o"), cache_read=_when(_1="r"), effective_at=_when(_0="'2026-03-01'", _1="'2026-04-01'", _2="'2026-03-01'"), fault=_when(_3="'terms of a product'")))
def amazon(p):
    """Price lists of products and terms; one has a cached rate from a later day, one a product of another model, one a unit that isn't tokens."""
    product = lambda sku, model, kind: f'"{sku}":{{"attributes":{{"model":"{model}","feature":"On-demand Inference","inferenceType":"{kind}"}}}}'
    term = lambda sku, usd, day, unit="1K tokens": text(f'"{sku}":{{"o":{{"effectiveDate":"{day}T00:00:00Z","priceDimensions":{{"d":{{"unit":"', unit, '","pricePerUnit":{"USD":"', usd, '"}}}}}')
    thousand = lambda x: F.format_string("%.9f", x.cast("double") / 1000)
    more, terms = _by("", "," + product("x", "Nova Lite", "Prompt cache read input tokens"), "," + product("y", "Other", "Input tokens"), ""), _by("", text(",", term("x", thousand(c("r")), "2026-04-01")), text(",", term("y", "9", "2026-09-01")), "")
    return _alone(p, "amazon", text('{"products":{' + product("a", "Nova Lite", "Input tokens") + "," + product("b", "Nova Lite", "Output tokens"), more, '},"terms":{"OnDemand":{', term("a", thousand(c("i")), "2026-01-02", _by(*["1K tokens"] * 3, "hours")), ",", term("b", thousand(c("o")), "2026-03-01"), terms, "}}}"))


_FIVE = dict(cache_write="CASE WHEN k < 3 THEN o END", cache_write_1h="CASE WHEN k < 3 THEN s END", cache_read="CASE WHEN k < 3 THEN r END")


@source(_sql("p", model_id="'claude-part-' || n", input="CASE WHEN k < 3 THEN i END", output="CASE WHEN k < 3 THEN o END", **_FIVE, entries=_when(_1="'200000 - - - ' || CAST(round(2000 * i) AS BIGINT) || ' ' || CAST(round(2000 * o) AS BIGINT)", _2="'- fast - - ' || CAST(round(2000 * i) AS BIGINT) || ' ' || CAST(round(2000 * o) AS BIGINT)"), fault=_when(_3="'unreadable rate'")))
def anthropic(p):
    """A table of five rates: plain rows, pairs for prompts up to and over a bound, models of the fast mode's table, a rate that is a range."""
    d = lambda x: text("$", x, " / MTok")
    name = text("[Claude Part ", c("n"), "](u)")
    five = lambda x, base, w, h, r, o: pipe(x, base, d(w), d(h), d(r), d(o))
    plain = five(name, d(c("i")), c("o"), c("oo"), c("r"), c("o"))
    pair = text(five(text(name, " (for prompts up to 200K tokens)"), d(c("i")), c("o"), c("oo"), c("r"), c("o")), five(text(name, " (for prompts over 200K input tokens)"), d(c("ii")), c("oo"), c("oo"), c("r"), c("oo")))
    odd = five(name, text("$", c("i"), "-", c("oo")), c("o"), c("oo"), c("r"), c("o"))
    fast = _by("", "", pipe(text("Claude Part ", c("n"), " / Claude Gone 1"), d(c("ii")), d(c("oo"))), "")
    return _shared(p, "anthropic", _pipes("Model", "Base Input Tokens", "5m Cache Writes", "1h Cache Writes", "Cache Hits & Refreshes", "Output Tokens"), _by(plain, pair, text(plain), odd), "\n\n" + _pipes("Model", "Input", "Output"), fast)


@source(_sql("p", model_id="'m' || n", input=_when(_0="i", _1="i"), output=_when(_0="o", _1="0"), cache_read=_when(_0="r"), fault=_when(_3="'amounts'")))
def baseten(p):
    """A grid rendered twice: whole rows, rows without output (an embedding), rows of dashes, cells of two amounts."""
    twice = lambda x: text('<div><div class="md:hidden">', x, '</div><div class="hidden md:flex">', x, "</div></div>")
    row = lambda i, r, o: text('<div class="grid">', twice(text('<a href="/library/', c("m"), '/">', c("m"), "</a>")), twice(i), twice(r), twice(o), "</div>")
    i, o, r = (text("$", c(x)) for x in "ior")
    return _shared(p, "baseten", '<div class="grid"><div>Model</div><div>Input</div><div>Cache Input</div><div>Output</div></div>', row(_by(i, i, "-", text(i, " $2")), _by(r, "-", "-", "-"), _by(text(o, " <a>Try</a>"), "-", "-", o)))


@source(_sql("p WHERE k < 3", model_id="'m' || n", input=_when(_0="i", _1="i / 2", _2="i"), output=_when(_0="o", _1="o / 2", _2="o"), entries=_when(_2="'- - - 0-1400 ' || CAST(round(2000 * i) AS BIGINT) || ' ' || CAST(round(2000 * o) AS BIGINT)")))
def dashscope(p):
    """Tables by region: plain rows, promotions of half a list price, rates off peak and at peak by the note's hours; rows of another region don't count."""
    i, o, ii, oo = (text("$", c(x)) for x in ("i", "o", "ii", "oo"))
    half = lambda x: text("50% off Original ", x)
    timed = lambda off, peak: text("Off-peak ", off, " Peak ", peak)
    row = cells(c("m"), _by("International", "International", "International", "Mainland"), "No tiered pricing", _by(i, half(i), timed(i, ii), i), _by(o, half(o), timed(o, oo), o))
    return _shared(p, "dashscope", "<p>Note: off-peak hours are from 22:00 to 08:00 the next day (UTC+8).</p>" + _head("Model ID", "Scope", "Input token range", "Input price", "Output price"), row, "</tbody></table>")


@source(_sql("p CROSS JOIN (VALUES ('glm-5.2'), ('glm-5.3'), ('gte'), ('kimi-k3-priority'), ('Unknown name')) v(id) WHERE id <> 'Unknown name' OR k = 1", run="'r' || n", model_id="id", currency="'DBU'", input="CASE id WHEN 'glm-5.2' THEN i WHEN 'glm-5.3' THEN i WHEN 'gte' THEN CASE WHEN k <> 2 THEN r END WHEN 'kimi-k3-priority' THEN o END", output="CASE id WHEN 'glm-5.2' THEN o WHEN 'glm-5.3' THEN o WHEN 'gte' THEN CASE WHEN k <> 2 THEN 0 END WHEN 'kimi-k3-priority' THEN s END", cache_read="CASE id WHEN 'kimi-k3-priority' THEN r END", fault="CASE WHEN id = 'Unknown name' THEN 'unmapped name' WHEN id = 'gte' AND k = 2 THEN 'unreadable rate' END"))
def databricks(p):
    """Tables of two tiers: a name of two models, an embedding, a name that none has, a cell that isn't a number."""
    top = lambda tier: f"<table><thead><tr><th>Model</th><th colspan=3>{tier} Pay Per Token (DBU Per 1M Tokens)</th></tr><tr><th></th><th>Input</th><th>Output</th><th>Cache read</th></tr></thead><tbody>"
    unknown = _by("", cells("Unknown name", "1", "2", "3"), "", "")
    return _alone(p, "databricks", text(top("Standard"), cells("GLM-5.2, 5.3 ⌖", c("i"), c("o"), "-"), cells("GTE", _by(c("r"), c("r"), "1,5", c("r")), "-", "-"), unknown, "</tbody></table>" + top("Priority"), cells("Kimi K3", c("o"), c("oo"), c("r")), "</tbody></table>"))


_PEAK = "CAST(round(2000 * i) AS BIGINT) || ' ' || CAST(round(2000 * o) AS BIGINT)"


@source(_sql("p CROSS JOIN (VALUES ('chat'), ('plain')) v(id)", run="'r' || n", model_id="id", input="CASE WHEN k < 3 THEN i END", output="CASE WHEN k < 3 THEN o END", cache_read="CASE WHEN k < 3 THEN r END", context="1048576 * CASE WHEN k < 3 THEN 1 END", fee="CASE WHEN k < 3 THEN 0.005 END", effective_at="CASE WHEN k = 1 AND id = 'chat' THEN '2026-08-23' END", entries=f"CASE WHEN id = 'chat' AND k < 3 THEN '- - ' || CASE k WHEN 1 THEN '5' ELSE '-' END || ' 100-400 ' || {_PEAK} || '; - - ' || CASE k WHEN 1 THEN '5' ELSE '-' END || ' 630-1000 ' || {_PEAK} END", fault="CASE WHEN k = 3 THEN 'fees' END"))
def deepseek(p):
    """Ids across and labels down: one model with peak rates on two windows, on weekdays only on some pages, one without; a guide's fees, which some runs lack."""
    d = lambda x: text("$", c(x))
    both = lambda label, off, peak: text(f"<tr><td>{label}</td><td>OFF-PEAK</td><td>", d(off), "</td><td>", d(off), "</td></tr><tr><td>PEAK</td><td>", d(peak), "</td><td>-</td></tr>")
    page = text("<table><tr><td>MODEL</td><td>chat (1)</td><td>plain</td></tr><tr><td>CONTEXT LENGTH</td><td colspan=2>1M</td></tr>", both("1M INPUT TOKENS (CACHE HIT)", "r", "i"), both("1M INPUT TOKENS (CACHE MISS)", "i", "ii"), both("1M OUTPUT TOKENS", "o", "oo"), "</table><p>(1) Peak hours are 01:00 - 04:00 and 06:30 - 10:00 UTC", _by("", ", Monday through Friday", "", ""), ".</p>")
    guide = lit(_head("API", "Unit", "Price") + "<tr><td>Search API</td><td>Per 1,000 successful requests</td><td>$5</td></tr><tr><td>Fetch</td><td>Per 1,000 successful requests</td><td>$1</td></tr></tbody></table>")
    return _alone(p, "deepseek", page).unionByName(_alone(p.where("k < 3"), "deepseek", guide, "guide"))


@source(_sql("p", model_id="'m' || n", input="CASE WHEN k < 3 THEN i END", output=_when(_0="o", _1="o", _2="0"), cache_read=_when(_0="r", _1="r"), context=_when(_0="1000000", _1="1000000", _2="1000000"), entries=_when(_1="'200000 - - - ' || CAST(round(2000 * i) AS BIGINT) || ' ' || CAST(round(2000 * o) AS BIGINT)"), fault=_when(_3="'unreadable rate'")))
def google(p):
    """Sections with tabs: plain rates, rates by the prompt's length, input alone (an embedding), a range; another tab's rates don't count."""
    grid = lambda *rows: text("{% table %}\n* \n* Free Tier\n* Paid Tier, per 1M tokens in USD\n", *[text("---\n* ", name, "\n* no\n* ", x, "\n") for name, x in rows], "{% /table %}\n")
    i, o, r, ii, oo = (text("$", c(x)) for x in ("i", "o", "r", "ii", "oo"))
    by_length = lambda low, high: text(low, ", prompts <= 200k tokens ", high, ", prompts > 200k\n  tokens")
    cached = ("Context caching price", text(r, " (text) $4.50 / 1,000,000 tokens per hour"))
    plain, longer = grid(("Input price", i), ("Output price (with thoughts)", o), cached), grid(("Input price", by_length(i, ii)), ("Output price", by_length(o, oo)), cached)
    return _shared(p, "google", "# Pricing\n", text("\n## M ", c("n"), ' {% id="', c("m"), '" %}\n\n[`', c("m"), '`](/docs/models/x) with a 1M token context window\n\n{% tabs %}\n{% tab title="Standard" %}\n', _by(plain, longer, grid(("Text input price", i)), grid(("Input price", text(i, " - $9.99")), ("Output price", o))), '{% /tab %}\n{% tab title="Batch" %}\n', grid(("Input price", "$9"), ("Output price", "$9")), "{% /tab %}\n{% /tabs %}\n"))


@source(_sql("p", model_id="'m' || n", input=_when(_0="i", _1="i"), output=_when(_0="o", _1="o"), cache_read=_when(_0="r"), cache_write=_when(_1="o"), fault=_when(_3="'unreadable rate'")))
def openai(p):
    """Islands of rows: four cells, five with a write's rate, a model without rates, a cell that isn't a number; another tier's rows don't count."""
    row = lambda *x: text("[1,[[0,\"", c("m"), "\"]", *[text(",[0,", v, "]") for v in x], "]],")
    island = lambda tier: f"<astro-island component-export=\"TextTokenPricingTables\" props='{{\"tier\":[0,\"{tier}\"],\"rows\":[1,["
    end = "[1,[[0,\"End\"],[0,1],[0,1],[0,1]]]]]}'></astro-island>"
    own = _by(row(c("i"), c("r"), c("o")), row(c("i"), '"-"', c("o"), c("o")), row("null", "null", c("o")), row('"free"', "null", c("o")))
    return _shared(p, "openai", island("standard"), own, end + island("batch"), row("1", "1", "1"), end)


@source(_sql("p WHERE k < 3", model_id="'part-' || n", input=_when(_0="i", _1="i"), output=_when(_0="o", _1="o"), cache_read=_when(_0="r"), fee=_when(_0="0.005", _1="0.005"), fault=_when(_2="'unreadable rate'")))
def perplexity(p):
    """Rows of own models, with and without a dollar sign and a cached rate, one with a comma that may mean two things; rows of others don't count."""
    row = cells(text(_by("perplexity", "perplexity", "perplexity", "other"), "/Part ", c("n")), _by(c("i"), text("$", c("i")), text(F.replace(c("i"), lit("."), lit(",")), " x"), c("i")), _by(c("o"), text("$", c("o")), c("o"), c("o")), _by(text("$", c("r")), "-", "-", "-"))
    return _shared(p, "perplexity", _head("Model", "Input ($/1M)", "Output ($/1M)", "Cache read ($/1M)"), row, "</tbody></table><p>Fast search costs $1.00, instead of $5.00 per 1,000 invocations.</p>")


@source(_sql("p WHERE k < 3", model_id="'doubao-seed-m' || n", input=_when(_0="round(i / 7.2, 6)", _1="round(i / 7.2, 6)"), output=_when(_0="round(o / 7.2, 6)", _1="round(o / 7.2, 6)"), context=_when(_0="262144", _1="262144")))
def volcengine(p):
    """Cards of running text in yuan: whole rates, the lower bound of a range, a card without an input; cards of other kinds of models don't count."""
    name = text(_by("doubao-seed-", "doubao-seed-", "doubao-seed-", "doubao-seedream-"), c("m"))
    return _shared(p, "volcengine", text("<div>", name, " 复制 上下文窗口 256k 最大输出 32k 输入价格 ", _by(text(c("i"), "元/百万"), text(c("i"), " - 99 元/百万"), "", text(c("i"), "元/百万")), " 输出价格 ", c("o"), "元/百万 复制 more</div>"))
