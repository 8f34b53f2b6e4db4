"""Each source's pages as priced ids: what stands where on its pages, as queries over their elements, table rows, lines or JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.markup import Pages, Sel, column, inner_of, plain, records
from ..functions.money import scan
from ..functions.text import fold_heading
from .priced import COUNT_DIGITS, SOURCES, amount, c, cell, data_rows, faults, headed, lit, override, priced, rates, sized, slug, source, thousand, word_before


@source(wanted={"list": Sel("div", ("b-cards--type-models",)), "card": Sel("div", ("card",)), "title": Sel("h3", ("card__title",)), "footer": Sel("div", ("card__footer",))})
def ai21(pages: Pages) -> DataFrame:
    """Cards: a title, and a footer of one input and one output amount."""
    cards = records(pages.elements.where("path.list is not null"), "card", ("title", "footer"))
    # the footer between its two units: what stands before each is an amount
    part = F.split("footer", "/ 1M")
    units = F.transform(F.slice(part, 2, 9), lambda x: F.array_join(F.slice(F.split(F.trim(x), r"\s+"), 1, 2), " "))
    cards = cards.withColumn("model_id", F.coalesce(slug(c("title")), lit(""))).withColumn("units", units)
    got = scan(cards, p=("footer", "$", ""))
    fault = faults((c("footer").isNull(), "no footer"), (c("p_bad"), "unreadable rate"), (c("units") != F.array(lit("input tokens"), lit("output tokens")), "price lines"), (F.size("p_amounts") != 2, "unreadable rate"))
    return priced(got, "ai21", fault, {"input": amount("p"), "output": amount("p", 1)})


@source()
def amazon(pages: Pages) -> DataFrame:
    """A price list as JSON: products join their on-demand terms by sku and axis; rates of a thousand tokens; the latest date of an axis counts."""
    # The names of models and what an axis is called.
    ids = {"Nova Lite": "amazon.nova-lite-v1:0", "Nova Micro": "amazon.nova-micro-v1:0", "Nova Pro": "amazon.nova-pro-v1:0", "Nova Premier": "amazon.nova-premier-v1:0", "Nova 2.0 Lite": "amazon.nova-2-lite-v1:0", "Nova 2.0 Omni": "amazon.nova-2-omni-v1:0", "Nova 2.0 Pro": "amazon.nova-2-pro-v1:0"}
    axes = {"Input tokens": "input", "Text Input Token": "input", "Output tokens": "output", "Text output token": "output", "Prompt cache read input tokens": "cache_read", "Input Image Token Count": "image", "Input Audio Token Count": "audio", "Output Image Token Count": "image_output"}
    attributes = "struct<model:string,feature:string,inferenceType:string>"
    term = "struct<effectiveDate:string,priceDimensions:map<string,struct<unit:string,pricePerUnit:map<string,string>>>>"
    file = F.from_json("body", f"struct<products:map<string,struct<attributes:{attributes}>>,terms:struct<OnDemand:map<string,map<string,{term}>>>>")
    read = pages.bodies.select("url", file.alias("f"))
    key, axis = F.create_map(*[lit(x) for kv in ids.items() for x in kv]), F.create_map(*[lit(x) for kv in axes.items() for x in kv])
    product = read.select("url", F.explode("f.products").alias("sku", "p")).select("url", "sku", F.try_element_at(key, c("p.attributes.model")).alias("model_id"), F.try_element_at(axis, c("p.attributes.inferenceType")).alias("axis")).where("axis is not null and model_id is not null and p.attributes.feature = 'On-demand Inference'")
    offer = read.select("url", F.explode("f.terms.OnDemand").alias("sku", "offers")).select("url", "sku", F.map_values("offers").alias("offers"))
    dimension = F.map_values(F.get(c("offers"), 0)["priceDimensions"])
    got = product.join(offer, ["url", "sku"], "left").withColumn("dim", F.get(dimension, 0)).withColumn("n_dim", F.size(dimension)).withColumn("date", F.get(c("offers"), 0)["effectiveDate"])
    usd = F.try_element_at(c("dim.pricePerUnit"), lit("USD")).try_cast("double")
    bad = faults((c("offers").isNull() | (F.size("offers") != 1), "terms"), (c("n_dim") != 1, "price dimensions"), (~c("dim.unit").eqNullSafe("1K tokens"), "unit"), (usd.isNull() | (usd < 0), "unreadable rate"), (~F.coalesce(c("date").rlike(r"^\d{4}-\d{2}-\d{2}T"), lit(False)), "effective date"))
    row = got.withColumn("usd", usd).withColumn("bad", bad).groupBy("url", "model_id").agg(*[F.max(F.when(c("axis") == a, c("usd") * 1000)).alias(a) for a in sorted(set(axes.values()))], F.max("bad").alias("bad"), F.max(F.substring("date", 1, 10)).alias("date"), (F.count("axis") != F.count_distinct("axis")).alias("twice"), F.lit(0).alias("ord"))
    named = row.where("input is not null and output is not null or bad is not null or twice")
    return priced(named, "amazon", faults((c("twice"), "two products of an axis"), (c("bad").isNotNull(), "terms of a product")), {a: c(a) for a in sorted(set(axes.values()))}, effective=c("date"))


@source(wanted={"grid": Sel(attrs={"id": "avModelGrid"}), "card": Sel(cls=("av-model-card",)), "label": Sel(cls=("av-model-label",)), "meta": Sel(cls=("av-model-meta",)), "block": Sel(cls=("av-mp",)), "key": Sel(cls=("av-mp-label",)), "rate": Sel(cls=("av-mp-val",))})
def avian(pages: Pages) -> DataFrame:
    """Cards in a grid: labelled price blocks; a context of K or M tokens in thousands."""
    rows = pages.elements.where("path.grid is not null")
    cards = records(rows, "card", ("label", "meta"))
    block = rows.where("name in ('key', 'rate') and path.block is not null").groupBy("url", c("path.card").alias("ord"), c("path.block").alias("block")).agg(F.max(F.when(c("name") == "key", c("value"))).alias("k"), F.max(F.when(c("name") == "rate", c("value"))).alias("v"))
    block = block.groupBy("url", "ord").agg(*[F.max(F.when(c("k") == k, c("v"))).alias(k) for k in ("Input", "Output", "Cache")])
    got = scan(cards.join(block, ["url", "ord"], "left"), i=("Input", "$", ""), o=("Output", "$", ""), r=("Cache", "$", ""))
    tokens = sized(word_before(c("meta"), "context"))
    fault = faults((c("i_bad") | c("o_bad") | c("r_bad"), "unreadable rate"))
    return priced(got.withColumn("model_id", slug(c("label"))).where(r"model_id rlike '^[a-z0-9][a-z0-9.-]*$'"), "avian", fault, {"input": amount("i"), "output": amount("o"), "cache_read": amount("r")}, limits={"context": tokens})


@source(wanted={"row": Sel("div", ("grid",)), "desk": Sel("div", ("hidden", "md:flex"), skip=("a",)), "link": Sel("a", value="href"), "label": Sel("div", parent="row")})
def baseten(pages: Pages) -> DataFrame:
    """A grid whose cells are rendered twice: only the desktop one counts; a dash for output beside an input is no charge; a page of dashes alone is broken."""
    rows = pages.elements
    grid = records(rows, "row", (), ("desk", "label")).join(records(rows.where("path.desk is not null"), "row", ("link",)), ["url", "ord"], "left")
    heading = F.transform("label", fold_heading) == F.array(*map(lit, ("model", "input", "cache input", "output")))
    start = grid.where(heading).groupBy("url").agg(F.min("ord").alias("start"))
    model = F.lower(F.regexp_extract("link", "^/library/([^/]+)/?$", 1))
    body = grid.join(start, "url").where("ord > start").select("url", "ord", model.alias("model_id"), F.size("desk").alias("n"), *[F.get("desk", i).alias(n) for i, n in ((1, "i"), (2, "r"), (3, "o"))])
    got = scan(body, i=("i", "$", ""), r=("r", "$", ""), o=("o", "$", ""))
    for n in "iro":
        got = got.withColumn(f"{n}_dash", (c(n) == "-") & (F.size(f"{n}_amounts") == 0))
    got = got.withColumn("alive", F.max((F.size("i_amounts") + F.size("r_amounts") + F.size("o_amounts") > 0) | c("i_bad") | c("r_bad") | c("o_bad")).over(Window.partitionBy("url")))
    blank = c("i_dash") & c("r_dash") & c("o_dash")
    odd = lambda n: ~c(f"{n}_dash") & (F.size(f"{n}_amounts") != 1)
    fault = faults((~c("alive"), "no priced row"), (c("n") != 4, "cells"), (~blank & (c("i_bad") | c("r_bad") | c("o_bad")), "unreadable rate"), (~blank & (c("i_dash") | odd("i") | odd("o") | odd("r")), "amounts"))
    rows = got.where("model_id rlike '^[a-z0-9][a-z0-9-]*$'")
    return priced(rows, "baseten", fault, {"input": amount("i"), "output": F.when(c("o_dash") & ~blank, 0.0).otherwise(amount("o")), "cache_read": amount("r")})


@source()
def cerebras(pages: Pages) -> DataFrame:
    """JSON: prices of a token as texts; a negative one is no price."""
    flat = pages.bodies.select("url", F.posexplode(F.from_json("body", "struct<data:array<struct<id:string,pricing:struct<prompt:string,completion:string>>>>")["data"]).alias("ord", "m")).select("url", "ord", c("m.id").alias("model_id"), "m.pricing.*")
    rate = lambda x: F.when(c(x).try_cast("double") >= 0, c(x).try_cast("double") * 1e6)
    bad = [(c(x).isNotNull() & c(x).try_cast("double").isNull(), f"unreadable {x} rate") for x in ("prompt", "completion")]
    return priced(flat.where("model_id is not null"), "cerebras", faults(*bad), {"input": rate("prompt"), "output": rate("completion")})


#: The anchors of the two sections.
CLOUDFLARE = ("llm-model-pricing", "other-model-pricing")


@source(tables=True, sep="\n", wanted={f"section{i}": Sel(attrs={"id": x}) for i, x in enumerate(CLOUDFLARE)} | {"h2": Sel("h2"), "table": Sel("table")})
def cloudflare(pages: Pages) -> DataFrame:
    """Two sections: lines of a token cell name their rates. Of the first section every row counts, of the other only clean pairs of input and output."""
    ids = CLOUDFLARE
    marks = pages.elements.where((c("name") != "h2") | ~F.coalesce(F.col("attrs")["id"], lit("")).isin(*ids))
    before = F.max_by(F.when(c("name") != "table", c("name")), F.when(c("name") != "table", c("no"))).over(Window.partitionBy("url").orderBy("no", F.desc("name")).rowsBetween(Window.unboundedPreceding, 0))
    tables = marks.withColumn("section", before).where("name = 'table' and section like 'section%'").select("url", c("no").alias("table"), "section")
    rows = data_rows(pages, headed("Model", "Price in Tokens", "Price in Neurons")).join(tables, ["url", "table"])
    once = Window.partitionBy("url", "section")
    rows = rows.withColumn("least", F.min("table").over(once)).where("table = least")
    lines = F.split(cell(1), "\n")
    rate_of, kind_of = lambda x: F.substring_index(x, " per M ", 1), lambda x: F.when(x.contains(" per M ") & x.endswith(" tokens"), F.replace(F.substring_index(x, " per M ", -1), lit(" tokens"), lit(""))).otherwise("")
    kinds = F.transform(lines, lambda x: F.when(kind_of(x).isin("input", "output", "cached input"), kind_of(x)).otherwise(""))
    pick = lambda k: F.coalesce(rate_of(F.get(F.filter(lines, lambda x: kind_of(x) == k), 0)), lit(""))
    flat = rows.select("url", "ord", "section", F.lower(F.replace(cell(0), lit("\n"), lit(" "))).alias("model_id"), kinds.alias("kinds"), pick("input").alias("i"), pick("output").alias("o"), pick("cached input").alias("r"))
    got = scan(flat.where("model_id rlike '^@[a-z0-9][a-z0-9._/-]*$'"), i=("i", "$", ""), o=("o", "$", ""), r=("r", "$", ""))
    odd = F.array_contains("kinds", "") | (F.size("kinds") != F.size(F.array_distinct("kinds"))) | ~F.array_contains("kinds", "input") | ~F.array_contains("kinds", "output")
    cached = F.array_contains("kinds", "cached input")
    unreadable = c("i_bad") | c("o_bad") | c("r_bad") | (F.size("i_amounts") != 1) | (F.size("o_amounts") != 1) | (cached & (F.size("r_amounts") != 1))
    return priced(got.where((c("section") == "section0") | ~odd), "cloudflare", faults((odd, "token cell"), (unreadable, "unreadable rate")), {"input": amount("i"), "output": amount("o"), "cache_read": amount("r")}, order=("section",))


@source(wanted={"block": Sel(("li", "p"))}, objects='{"_type":"model"')
def cohere(pages: Pages) -> DataFrame:
    """Cards inside script state, then sentences that name both rates; output that isn't of tokens costs nothing."""
    named = lambda x: slug(F.replace(x, lit("+"), lit(" plus ")))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    state = pages.objects.select("url", c("no").cast("bigint").alias("ord"), F.try_parse_json("value").alias("v"))
    costs = state.select("url", "ord", get("$.modelName", "string").alias("name"), F.explode(get("$.pricings", "array<variant>")).alias("v"))
    out = F.when(get("$.outputLabel", "string") == "Output", get("$.outputPrice", "double")).otherwise(0.0)
    card = costs.where(get("$.outputLabel", "string").isNotNull()).select("url", "ord", named(c("name")).alias("model_id"), get("$.inputPrice", "double").alias("in"), out.alias("out"), lit(0).alias("kind"), lit(False).alias("bad")).where("in >= 0 and out >= 0")
    sides = lambda i: F.trim(F.get(F.split(c("value"), r"/\s*1M tokens for (input and|output)"), i))
    lines = pages.elements.where((c("name") == "block") & c("value").contains(" pricing is ") & (F.size(F.split("value", "1M tokens for")) == 3) & c("value").endswith(" for output"))
    said = lines.select("url", c("no").cast("bigint").alias("ord"), named(F.substring_index("value", " pricing is ", 1)).alias("model_id"), F.substring_index(sides(0), " pricing is ", -1).alias("a"), sides(1).alias("b"))
    said = scan(said, a=("a", "$", ""), b=("b", "$", ""))
    whole = lambda n: ~c(f"{n}_bad") & (F.size(f"{n}_amounts") == 1) & (c(n) == F.concat(lit("$"), F.get(f"{n}_amounts", 0)))
    said = said.select("url", "ord", "model_id", amount("a").alias("in"), amount("b").alias("out"), lit(1).alias("kind"), (~whole("a") | ~whole("b")).alias("bad"))
    return priced(card.unionByName(said), "cohere", faults((c("bad"), "prose rate")), {"input": c("in"), "output": c("out")}, order=("kind",))


@source(tables=True)
def databricks(pages: Pages) -> DataFrame:
    """Tables of a standard and a priority tier in DBU; a display name may stand for several ids."""
    # The ids that a display name stands for.
    names = {
        "Kimi K3": ["kimi-k3"], "Kimi K2.7": ["kimi-k2.7"], "GLM-5.2, 5.3": ["glm-5.2", "glm-5.3"], "GLM-5.3 Flash": ["glm-5.3-flash"], "Inkling": ["inkling"], "DeepSeek V4 Pro": ["deepseek-v4-pro"], "DeepSeek V4.1 Flash": ["deepseek-v4.1-flash"],
        "DeepSeek V4 Flash": ["deepseek-v4-flash"], "Qwen 3.5 122B": ["qwen3.5-122b-a10b"], "Qwen 3 80B Instruct": ["qwen3-next-80b-a3b-instruct"], "GPT-OSS-120B": ["gpt-oss-120b"], "GPT-OSS-20B": ["gpt-oss-20b"], "Llama 4 Maverick": ["llama-4-maverick"],
        "Llama 3.3 70B": ["llama-3.3-70b-instruct"], "Gemma 3 12B": ["gemma-3-12b-it"], "Llama 3.1 8B": ["llama-3.1-8b-instruct"], "Qwen 3 0.6B Embedding": ["qwen3-embedding-0.6b"], "GTE": ["gte"], "BGE Large": ["bge-large"],
    }
    tier = F.get(F.filter("cells", lambda x: fold_heading(x).rlike(r"pay per token \(dbu per 1m tokens\)")), 0)
    # a window over the table's rows: a join would broadcast what the headings say, a row for each table, by the size of its files
    top, own = c("in_head") | c("first"), Window.partitionBy("url", "table")
    rows = pages.rows.select("url", "table", "ord", "cells", top.alias("is_top"), F.when(top, fold_heading(tier)).alias("t"), F.when(top, F.array_contains(F.transform("cells", fold_heading), "cache read")).alias("s"))
    body = rows.withColumn("tier", F.max("t").over(own)).withColumn("sub", F.max("s").over(own)).where("not is_top and sub and tier is not null and size(cells) = 4 and not lower(cells[1]) = 'input'")
    priority = c("tier").startswith("priority")
    display = F.trim(F.replace(cell(0), lit("⌖"), lit("")))
    known = F.create_map(*[x for k, v in names.items() for x in (lit(k), F.array(*map(lit, v)))])
    ids = F.transform(F.try_element_at(known, display), lambda x: F.when(priority, F.concat(x, lit("-priority"))).otherwise(x))
    value = lambda i: F.when(cell(i).rlike(r"^\d+(\.\d+)?$"), cell(i).cast("double"))
    odd = lambda i: value(i).isNull() & (cell(i) != "-")
    flat = body.select("url", "ord", priority.cast("int").alias("late"), F.explode(F.coalesce(ids, F.array(display))).alias("model_id"), ids.isNull().alias("unknown"), *[value(i).alias(n) for i, n in ((1, "i"), (2, "o"), (3, "r"))], (odd(1) | odd(2) | odd(3)).alias("bad"))
    return priced(flat.where(~c("unknown") | c("i").isNotNull()), "databricks", faults((c("unknown"), "unmapped name"), (c("bad"), "unreadable rate")), {"input": c("i"), "output": F.coalesce("o", F.when(c("i").isNotNull(), 0.0)), "cache_read": c("r")}, currency="DBU", order=("late",))


@source(tables=True, inner={"link": Sel("a", value="href"), "list": Sel("span", attrs={"aria-label": "List price"})})
def deepinfra(pages: Pages) -> DataFrame:
    """Tables rendered twice; a model's link names its id; of a discounted cell the run behind the list price is charged; k is 1024."""
    rows = data_rows(pages, headed("Model", "Context", "$ per 1M input tokens", "$ per 1M output tokens", "Actions"))
    flat = rows.select("url", "ord", F.lower(F.element_at(F.split(inner_of("link", 0), "/"), -1)).alias("model_id"), cell(1).alias("context"), cell(2).alias("i"), cell(3).alias("o"), inner_of("list", 2).isNotNull().alias("li"), inner_of("list", 3).isNotNull().alias("lo"))
    got = scan(flat.where("model_id rlike '^[a-z0-9][a-z0-9._/-]*$'"), i=("i", "$", ""), o=("o", "$", ""))
    sale = c("li") | c("lo")
    got = got.withColumn("n_i", F.size("i_amounts")).withColumn("n_o", F.size("o_amounts"))
    got = got.withColumn("i_amounts", F.when(sale, F.slice("i_amounts", 3, 2)).otherwise(c("i_amounts"))).withColumn("o_amounts", F.when(sale, F.slice("o_amounts", 2, 1)).otherwise(c("o_amounts")))
    said = F.lower(F.concat("i", "o")).contains("list")
    fault = faults((c("i_bad") | c("o_bad"), "unreadable rate"), (sale & ~(c("li") & c("lo") & (c("n_i") == 4) & (c("n_o") == 2)) | (~sale & said), "discounted cell"), (~F.size("i_amounts").isin(1, 2) | (F.size("o_amounts") != 1), "amounts"), ((c("context") != "-") & thousand(c("context")).isNull(), "unreadable context"))
    return priced(got, "deepinfra", fault, {"input": amount("i"), "output": amount("o"), "cache_read": amount("i", 1)}, limits={"context": thousand(c("context"))})


@source(tables=True)
def fireworks(pages: Pages) -> DataFrame:
    """Three amounts in the standard tier's cell: input, cached, output."""
    rows = data_rows(pages, F.slice("head", 1, 3) == F.array(*map(lit, ("model", "standard", "priority"))))
    flat = rows.select("url", "ord", F.regexp_replace(F.regexp_replace(F.lower(cell(0)), r"[\s()]+", "-"), "^-+|-+$", "").alias("model_id"), cell(1).alias("p"))
    got = scan(flat, p=("p", "$", ""))
    return priced(got, "fireworks", faults((c("p_bad"), "unreadable rate"), (F.size("p_amounts") != 3, "amounts")), {"input": amount("p"), "cache_read": amount("p", 1), "output": amount("p", 2)})


@source(pipes=True)
def groq(pages: Pages) -> DataFrame:
    """A markdown table; the link's path is the id; prices by the hour or character, or on request, are none."""
    head = headed("MODEL ID", "SPEED (T/SEC)", "PRICE PER 1M TOKENS", "RATE LIMITS (DEVELOPER PLAN)", "CONTEXT WINDOW (TOKENS)", "MAX COMPLETION TOKENS", "MAX FILE SIZE")
    rows = pages.pipes.where(head & (F.size("cells") == 7))
    link = r"^.*\]\(([^)]*)\)(.*)$"
    path, tail = F.regexp_extract(cell(0), link, 1), F.regexp_extract(cell(0), link, 2)
    own = F.regexp_extract(path, r"^/docs/model/(.*)$", 1)
    halves = F.split(cell(2), "input")
    both = (F.size(halves) == 2) & F.get(halves, 1).endswith("output")
    before = F.when(both, F.trim(F.get(halves, 0))).otherwise("")
    behind = F.when(both, F.trim(F.replace(F.get(halves, 1), lit("output"), lit("")))).otherwise("")
    other = F.when(F.substring_index(cell(2), " per ", -1).isin("hour", "1M characters"), F.substring_index(cell(2), " per ", 1)).otherwise("")
    flat = rows.select("url", "ord", F.when(tail.endswith(own), own).alias("model_id"), cell(2).alias("p"), before.alias("i"), behind.alias("o"), other.alias("other"), cell(4).alias("context"), cell(5).alias("most"))
    got = scan(flat.where("model_id rlike '^[a-z0-9][a-z0-9._/-]*$'"), i=("i", "$", ""), o=("o", "$", ""), f=("other", "$", ""))
    none = c("p").isin("ContactSales", "-", "\\-") | (~c("f_bad") & (F.size("f_amounts") == 1))
    count = lambda x: F.when(c(x).isin("-", "\\-"), 0).otherwise(F.when(c(x).rlike(rf"^[\d,]{{1,{COUNT_DIGITS}}}$"), F.replace(c(x), lit(","), lit("")).try_cast("bigint")))
    fault = faults((~none & (c("i_bad") | c("o_bad") | (F.size("i_amounts") != 1) | (F.size("o_amounts") != 1)), "unreadable price"), (~none & (count("context").isNull() | count("most").isNull()), "unreadable token count"))
    return priced(got, "groq", fault, {"input": amount("i"), "output": amount("o")}, limits={"context": count("context"), "output": count("most")})


@source(pipes=True)
def minimax(pages: Pages) -> DataFrame:
    """Markdown tables; the last amount of a cell counts, as struck-through ones stand before it; headings may carry a unit."""
    unit = lambda h: F.regexp_replace(F.regexp_replace(h, r"\s*\\?\$\s*/\s*m tokens$", ""), r"^\*\*(.*)\*\*$", "$1")
    rows = pages.pipes.withColumn("head", F.transform("head", unit)).where(F.array_contains("head", "model") & F.array_contains("head", "input") & F.array_contains("head", "output"))
    flat = rows.select("url", "ord", F.regexp_extract(cell(0), r"\*\*(.+?)\*\*", 1).alias("model_id"), column("input").alias("i"), column("output").alias("o"), column("prompt caching read").alias("r"), F.exists("head", lambda h: h.contains("cach")).alias("caches"), F.array_contains("head", "prompt caching read").alias("known"))
    got = scan(flat, i=("i", "$", ""), o=("o", "$", ""), r=("r", "$", ""))
    fault = faults((c("caches") & ~c("known"), "caching column"), (c("i").isNull() | c("o").isNull(), "cells"), (c("i_bad") | c("o_bad") | c("r_bad"), "unreadable rate"))
    return priced(got, "minimax", fault, {"input": amount("i", -1), "output": amount("o", -1), "cache_read": amount("r", -1)})


@source(tables=True, inner={"link": Sel("a", value="href"), "ins": Sel("ins"), "del": Sel("del")}, wanted={"section": Sel("section"), "table": Sel("table")})
def mistral(pages: Pages) -> DataFrame:
    """Tables in sections of token prices; of a sale the inserted amount counts; Free is zero; the link names the id."""
    rows = data_rows(pages, headed("Model", "Input", "Cached input", "Output"))
    inside = pages.elements
    near = inside.where("name = 'section' and value like '%Prices /M Tokens%'").select("url", c("no").alias("section"))
    near = inside.where("name = 'table'").select("url", c("no").alias("table"), c("path.section").alias("section")).join(near, ["url", "section"]).select("url", "table")
    sale = lambda i: F.coalesce(inner_of("ins", i).isNotNull() & inner_of("del", i).isNotNull(), lit(False))
    text = lambda i: F.when(sale(i), F.trim(F.element_at(F.split(inner_of("ins", i), "[​:]+"), -1))).otherwise(cell(i))
    flat = rows.join(near, ["url", "table"]).select("url", "ord", F.regexp_extract(F.coalesce(inner_of("link", 0), lit("")), "^/models/([a-z0-9-]+)$", 1).alias("model_id"), *[text(i).alias(n) for i, n in ((1, "i"), (2, "r"), (3, "o"))], *[sale(i).alias(f"{n}_sale") for i, n in ((1, "i"), (2, "r"), (3, "o"))])
    got = scan(flat, i=("i", "$", ""), r=("r", "$", ""), o=("o", "$", ""))
    own = lambda n: F.when((c(n) == "Free") & (F.size(f"{n}_amounts") == 0), 0.0).when((F.size(f"{n}_amounts") == 1) & (c(n) == F.concat(lit("$"), F.get(f"{n}_amounts", 0))), amount(n))
    odd = lambda n: c(f"{n}_bad") | (c(f"{n}_sale") & (F.size(f"{n}_amounts") > 1))
    return priced(got, "mistral", faults((odd("i") | odd("r") | odd("o"), "unreadable rate")), {"input": own("i"), "output": own("o"), "cache_read": own("r")})


@source(wanted={"card": Sel("article", attrs={"data-testid": "model-section-mobile-card"}), "href": Sel("a", value="href"), "dt": Sel("dt"), "dd": Sel("dd"), "amount": Sel("span", value="title"), "cached": Sel(attrs={"data-pricing-key": "cache-read"}), "script": Sel("script")})
def novita(pages: Pages) -> DataFrame:
    """Cards of terms and definitions, exact amounts in titles; script state maps a card's dashed name to the id."""
    rows = pages.elements
    ids = rows.where("name = 'script' and value like '%__next_f%'").select("url", F.explode(F.array_distinct(F.regexp_extract_all("value", lit(r'\\"id\\":\\"([^"\\]+)\\"'), lit(1)))).alias("id")).select("url", F.replace(c("id"), lit("/"), lit("-")).alias("dashed"), "id").groupBy("url", "dashed").agg(F.max("id").alias("id"))
    card = rows.where("path.card is not null").withColumn("term", F.last(F.when(c("name") == "dt", c("value")), ignorenulls=True).over(Window.partitionBy("url", c("path.card")).orderBy("no")))
    value = lambda term, where=lit(True): F.min_by(F.when((c("name") == "amount") & (c("term") == term) & where, c("value")), F.when((c("name") == "amount") & (c("term") == term) & where, c("no")))
    link = F.min_by(F.when((c("name") == "href") & c("value").rlike("^/models/model-detail/"), c("value")), F.when((c("name") == "href") & c("value").rlike("^/models/model-detail/"), c("no")))
    cached = F.sort_array(F.collect_list(F.when((c("name") == "amount") & c("path.cached").isNotNull() & (c("term") == "Input"), F.struct("no", "value"))))
    flat = card.groupBy("url", c("path.card").alias("ord")).agg(F.regexp_extract(link, "^/models/model-detail/([^/?]+)", 1).alias("dashed"), value("Input").alias("i"), value("Output").alias("o"), F.get(F.transform(cached, lambda x: x["value"]), 1).alias("r"), value("Context").alias("n"))
    rate = lambda x: F.when((F.trim(x).try_cast("double") >= 0) & (F.trim(x).try_cast("double") < float("inf")), F.trim(x).try_cast("double"))
    named = flat.where("dashed <> ''").join(ids, ["url", "dashed"], "left").withColumn("model_id", F.coalesce("id", F.regexp_replace("dashed", "^([^-]*)-", "$1/")))
    return priced(named, "novita", lit(None).cast("string"), {"input": rate(c("i")), "output": rate(c("o")), "cache_read": rate(c("r"))}, limits={"context": F.trim("n").try_cast("bigint")})


@source(tables=True)
def perplexity(pages: Pages) -> DataFrame:
    """Tables of own models; resold ones are left out; the fee of a search is the one named after `instead of`, by its number of calls."""
    resold = ("deepseek-v4-pro-0813", "glm-5.3", "glm-5.3-flash", "kimi-k3", "nemotron-3-ultra-550b-a55b")  # fixed values
    labels = ("input ($/1m)", "output ($/1m)", "cache read ($/1m)")
    rows = data_rows(pages, F.array_contains("head", labels[0]) & F.array_contains("head", labels[1]) & F.array_contains("head", labels[2]))
    name = F.lower(F.regexp_replace(F.trim(cell(0)), r"\s+", "-"))
    flat = rows.select("url", "ord", F.regexp_extract(name, "^perplexity/([a-z0-9][a-z0-9.-]*)$", 1).alias("model_id"), *[F.trim(column(x)).alias(n) for x, n in zip(labels, "ior", strict=True)], (F.size("cells") < F.size("head")).alias("short")).where(~c("model_id").isin(list(resold)))
    got = scan(flat, i=("i", "", ""), o=("o", "", ""), r=("r", "", ""))
    own = lambda n: F.when((F.size(f"{n}_amounts") == 1) & ((c(n) == F.get(f"{n}_amounts", 0)) | (c(n) == F.concat(lit("$"), F.get(f"{n}_amounts", 0)))), amount(n))
    # the sentence with `instead of`: the amount behind it is the fee, of as many calls as it says, else as the page says elsewhere
    sentences = F.split(plain(c("body")), r"\.(?=\s|$)")
    calls = lambda x: word_before(F.lower(x), "invocations")
    said = F.get(F.filter(sentences, lambda x: F.lower(x).contains("instead of")), 0)
    clause = pages.bodies.select("url", F.substring_index(F.lower(said), "instead of", -1).alias("fee"), F.coalesce(calls(said), calls(F.get(F.filter(sentences, lambda x: F.lower(x).contains(" invocations")), 0))).alias("n")).where("fee <> ''")
    clause = scan(clause, f=("fee", "$", ""), k=("n", "", ""))
    fee = clause.where(~c("f_bad") & ~c("k_bad") & (F.size("k_amounts") == 1) & (F.size("f_amounts") > 0)).groupBy("url.run").agg(F.max(amount("f") / amount("k")).alias("fee"))
    got = got.withColumn("run", c("url.run")).join(fee, "run", "left")
    fault = faults((c("short"), "cells"), (c("i_bad") | c("o_bad") | c("r_bad"), "unreadable rate"), (c("fee").isNull(), "fee of a search"))
    return priced(got, "perplexity", fault, {"input": own("i"), "output": own("o"), "cache_read": own("r")}, fees=F.struct(c("fee").alias("web_search"), lit(None).cast("double").alias("search"), lit(None).cast("double").alias("fetch")))


@source(tables=True, inner={"link": Sel("a")})
def publicai(pages: Pages) -> DataFrame:
    """A table: both amounts in one cell, a context in thousands."""
    rows = data_rows(pages, headed("model id", "context length", "pricing", "country of origin"))
    flat = rows.select("url", "ord", F.lower(F.trim(F.coalesce(inner_of("link", 0), cell(0)))).alias("model_id"), cell(1).alias("context"), F.when(F.lower(cell(2)).contains("per 1m tokens"), cell(2)).alias("p"))
    got = scan(flat.where("model_id rlike '^[a-z0-9][a-z0-9._/-]*$'"), p=("p", "$", ""))
    fault = faults((c("p_bad"), "unreadable rate"), (c("p").isNotNull() & (F.size("p_amounts") != 2), "amounts"), (c("p").isNotNull() & thousand(c("context"), 1000).isNull(), "context"))
    return priced(got, "publicai", fault, {"input": amount("p"), "output": amount("p", 1)}, limits={"context": thousand(c("context"), 1000)})


@source(tables=True)
def sambanova(pages: Pages) -> DataFrame:
    """A table of amounts before USD; N/A is no cached rate."""
    rows = data_rows(pages, headed("Model", "Cached Input Tokens", "Input (per 1M tokens)", "Output (per 1M tokens)"))
    flat = rows.select("url", "ord", slug(cell(0)).alias("model_id"), cell(1).alias("r"), cell(2).alias("i"), cell(3).alias("o"))
    got = scan(flat.where("model_id rlike '^[a-z0-9][a-z0-9._/-]*$'"), r=("r", "", " USD"), i=("i", "", " USD"), o=("o", "", " USD"))
    fault = faults((c("o").isNull(), "cells"), (c("i_bad") | c("o_bad") | c("r_bad"), "unreadable rate"), (amount("i").isNull() | amount("o").isNull(), "no amount"), ((c("r") != "N/A") & amount("r").isNull(), "cached input"))
    return priced(got, "sambanova", fault, {"input": amount("i"), "output": amount("o"), "cache_read": amount("r")})


@source(tables=True, inner={"link": Sel("a", value="href")})
def scaleway(pages: Pages) -> DataFrame:
    """A captioned table in euros; Free is zero; prices by the audio minute are none; a link that names the model must agree."""
    start = F.array(*map(lit, ("name", "tasks", "input tokens", "output tokens")))
    rows = data_rows(pages, F.forall(F.arrays_zip(F.slice("head", 1, 4).alias("h"), start.alias("s")), lambda x: x["h"].startswith(x["s"])) & (F.size("head") == 5)).where("caption = 'Generative API'")
    euro = lambda x: F.when(F.trim(x).rlike("^€[0-9][0-9.]*$"), F.ltrim(F.trim(x), lit("€")).try_cast("double"))
    parts = lambda i: F.split(cell(i), " / million tokens")
    alone = lambda i: F.when(F.get(parts(i), 1) == "", euro(F.get(parts(i), 0)))
    cached = (F.size(parts(2)) == 3) & (F.trim(F.get(parts(2), 2)) == "cached")
    i = F.when(cell(2) == "Free", 0.0).otherwise(F.when(cached, euro(F.get(parts(2), 0))).otherwise(alone(2)))
    o = F.when(cell(3) == "Free", 0.0).otherwise(alone(3))
    audio = cell(2).endswith(" / Audio minute") & euro(F.substring_index(cell(2), " / ", 1)).isNotNull()
    named = F.regexp_extract(F.coalesce(inner_of("link", 4), lit("")), "[?&]modelName=([^&]+)", 1)
    flat = rows.select("url", "ord", cell(0).alias("model_id"), i.alias("i"), o.alias("o"), F.when(cached, euro(F.get(parts(2), 1))).alias("r"), audio.alias("audio"), (inner_of("link", 4).isNotNull() & (named != cell(0))).alias("other"), (F.size("cells") != 5).alias("short"))
    fault = faults((c("short"), "cells"), (c("other"), "link of another model"), (~c("model_id").rlike("^[a-z0-9][a-z0-9._/-]*$"), "id"), (~c("audio") & c("i").isNull(), "input price"), (~c("audio") & c("o").isNull(), "output price"))
    return priced(flat, "scaleway", fault, {"input": c("i"), "output": c("o"), "cache_read": c("r")}, currency="EUR")


@source(tables=True, inner={"model": Sel("a", ("pricing_model-link",)), "any": Sel("a")})
def together(pages: Pages) -> DataFrame:
    """Tables of three columns; a second amount in the input cell is the cached rate; cells of other links are promotions."""
    rows = data_rows(pages, headed("model", "input", "output"))
    name = F.when(inner_of("model", 0).isNotNull(), inner_of("model", 0)).when(inner_of("any", 0).isNull(), cell(0)).otherwise("")
    flat = rows.select("url", "ord", F.lower(F.regexp_replace(F.trim(name), r"\s+", "-")).alias("model_id"), cell(1).alias("i"), cell(2).alias("o"), (F.size("cells") != 3).alias("short"))
    got = scan(flat.where("model_id rlike '^[a-z0-9][a-z0-9._/-]*$'"), i=("i", "$", ""), o=("o", "$", ""))
    return priced(got, "together", faults((c("short"), "cells"), (c("i_bad") | c("o_bad"), "unreadable rate")), {"input": amount("i"), "output": amount("o"), "cache_read": F.when(amount("i", 1) > 0, amount("i", 1))})


@source()
def volcengine(pages: Pages) -> DataFrame:
    """Cards of running text in yuan at a pinned rate; of a range the lower bound counts; a card ends at the next one, or behind its copy button."""
    # The rate, labels and signs of a card.
    per_usd, window, copy = 7.2, 400, "复制"
    ins, outs, sizes = "输入价格|推理输入", "输出价格|推理输出", "最大输出|上下文窗口"
    id_ = r"doubao-seed(?!ream|ance)[a-z0-9.-]+"
    text = plain(c("body"))
    card = pages.bodies.select("url", F.posexplode(F.regexp_extract_all(text, lit(f"({id_}(?:(?!{id_}).){{0,{window}}})"), lit(1))).alias("ord", "t"))
    card = card.select("url", "ord", F.regexp_extract("t", f"^({id_})", 1).alias("model_id"), F.regexp_replace("t", f"^{id_}", "").alias("t"))
    card = card.withColumn("t", F.regexp_extract("t", f"(?s)^((?:(?!{copy}).)*(?:{copy}(?:(?!{copy}).)*)?)", 1))
    after = lambda labels: F.regexp_extract("t", f"(?s)(?:{labels})((?:(?!{ins}|{outs}|{sizes}).)*)", 1)
    tight = lambda labels: F.regexp_replace(after(labels), r"\s", "")
    ends = lambda x: F.when(x.contains("元/百万"), F.regexp_extract(F.substring_index(x, "元/百万", 1), "[0-9.-]+$", 0))
    value = lambda labels: F.substring_index(ends(tight(labels)), "-", 1).try_cast("double") / per_usd
    size = lambda label: sized(F.get(F.filter(F.split(F.trim(after(label)), r"\s+"), lambda x: F.lower(x).endswith("k")), 0), 1024)
    return priced(card, "volcengine", lit(None).cast("string"), {"input": value(ins), "output": value(outs)}, limits={"context": size("上下文窗口"), "output": size("最大输出")})


@source(wanted={"comp": Sel("c4d-pricing-table"), "top": Sel("c4d-pricing-table-header-row"), "row": Sel("c4d-pricing-table-row"), "cell": Sel(("c4d-pricing-table-cell", "c4d-pricing-table-header-cell"))})
def watsonx(pages: Pages) -> DataFrame:
    """Tables of custom elements; one amount bills both directions."""
    rows = pages.elements
    head = records(rows, "top", (), ("cell",)).select("url", c("ord").alias("h"), c("cell").alias("head")).where(F.exists("head", lambda x: x.startswith("Model Name")) & F.exists("head", lambda x: x.startswith("Model Provider")))
    body = records(rows.where("path.row is not null"), "row", (), ("cell",))
    where_ = rows.where("name in ('row', 'top')").select("url", c("no").alias("ord"), c("path.comp").alias("comp"))
    body = body.join(where_, ["url", "ord"]).join(head.join(where_.withColumnRenamed("ord", "h"), ["url", "h"]), ["url", "comp"])
    at = F.array_position(F.transform("head", lambda x: x.startswith("Pay as you go")), lit(True)) - 1
    flat = body.select("url", "ord", slug(F.regexp_replace(F.get("cell", 0), r"\s+New$", ""), "a-z0-9").alias("model_id"), F.get("cell", at.cast("int")).alias("p"), (F.size("cell") < F.size("head")).alias("short"), (at < 0).alias("none"))
    got = scan(flat.where("model_id rlike '^[a-z0-9][a-z0-9._/-]*$'"), p=("p", "USD ", ""))
    return priced(got, "watsonx", faults((c("none"), "no price column"), (c("short"), "cells"), (c("p_bad"), "unreadable rate"), (F.size("p_amounts") > 2, "amounts")), {"input": amount("p"), "output": amount("p", -1)})


@source()
def xai(pages: Pages) -> DataFrame:
    """A JSON object assigned in a script: rates in ten-thousandths; a longer context's rates become an override."""
    entry = "struct<name:string,promptTextTokenPrice:string,completionTextTokenPrice:string,cachedPromptTokenPrice:string,maxPromptLength:string,longContextThreshold:string,promptTextTokenPriceLongContext:string,completionTokenPriceLongContext:string,cachedPromptTokenPriceLongContext:string>"
    blob = F.regexp_extract("body", r"(?s)__XAI_PUBLIC_MODELS__[^=]*=\s*(\{.*?\})\s*;?\s*</script>", 1)
    flat = pages.bodies.select("url", F.posexplode(F.from_json(blob, f"struct<clusterConfigs:array<struct<languageModels:array<{entry}>>>>")["clusterConfigs"]).alias("i", "k")).select("url", "i", F.posexplode("k.languageModels").alias("j", "e"))
    flat = flat.select("url", (c("i") * 100_000 + c("j")).alias("ord"), c("e.name").alias("model_id"), "e.*")
    rate = lambda x: c(x).try_cast("double") * 0.0001
    long = ("promptTextTokenPriceLongContext", "completionTokenPriceLongContext", "cachedPromptTokenPriceLongContext")
    any_long = F.coalesce(c("longContextThreshold"), *map(c, long)).isNotNull()
    bound = c("longContextThreshold").try_cast("bigint")
    fault = faults((any_long & ~F.coalesce(bound > 0, lit(False)), "long-context threshold"), (any_long & (rate(long[0]).isNull() | rate(long[1]).isNull()), "long-context rates"), (any_long & c(long[2]).isNotNull() & rate(long[2]).isNull(), "long-context cache rate"))
    over = F.when(any_long, F.array(override(rates(input=F.round(rate(long[0]), 6), output=F.round(rate(long[1]), 6), cache_read=F.round(rate(long[2]), 6)), min_tokens=bound)))
    return priced(flat, "xai", fault, {"input": rate("promptTextTokenPrice"), "output": rate("completionTextTokenPrice"), "cache_read": rate("cachedPromptTokenPrice")}, overrides=over, limits={"context": c("maxPromptLength").try_cast("bigint")})


def price_list_urls(pages: DataFrame, region: str = "us-east-1") -> DataFrame:
    """(url, file): of each region index (JSON) the pinned file of a region, as an absolute url; an index without it has a null."""
    at = F.try_variant_get(F.try_parse_json("body"), f"$.regions['{region}'].currentVersionUrl", "string")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", 0)
    folder = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"/[^/]*$", "/")
    return pages.select("url", F.when(at.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), at).when(at.startswith("/"), F.concat(host, at)).otherwise(F.concat(folder, at)).alias("file"))
