"""Sources whose prices depend on a clock, a mode or a prompt's length, or whose tables are states of scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import clock, day_range, shifted, utc
from ..functions.literals import unfenced
from ..functions.markup import Pages, Sel, column, plain
from ..functions.money import scan
from ..functions.text import fold_heading
from ..schema import DAYS, RATES
from .priced import amount, c, cell, data_rows, faults, headed, lit, override, priced, rates, sized, slug, some, source, word_before


def hhmm(text: Column) -> Column:
    """01:30 as 130."""
    return F.replace(text, lit(":"), lit("")).try_cast("int")


@source(pipes=True)
def anthropic(pages: Pages) -> DataFrame:
    """A markdown table of five rates; rows for prompts up to and over a bound become one entry; a table of a fast mode gives overrides."""
    rows = pages.pipes
    clean = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"(?s)<sup>.*?</sup>", ""), r"!?\[([^\]]*)\]\([^)]*\)", "$1"), r"<[^>]*>|[*`_​‌‍]", " "), r"\s+", " "))
    name = clean(cell(0))
    # a name, then notes in brackets: the last of them may be a bound of prompts, others tell of the model's state
    notes = F.transform(F.slice(F.split(name, r"\("), 2, 9), lambda x: F.trim(F.replace(F.lower(x), lit(")"), lit(""))))
    bound_ = F.get(F.filter(notes, lambda x: x.startswith("for prompts ") & x.endswith("tokens")), 0)
    words = F.split(F.replace(bound_, lit("for prompts "), lit("")), " ")
    over = F.coalesce(F.get(words, 0) == "over", lit(False))
    size = F.coalesce(F.get(words, F.when(over, 1).otherwise(2)), lit(""))
    threshold = sized(size).cast("bigint")
    state = F.array(*map(lit, ("deprecated", "retired", "legacy", "new", "beta", "preview")))  # fixed values
    left_out = lambda x: x.startswith("for prompts ") | F.array_contains(state, F.get(F.split(x, " "), 0))
    stem = F.trim(F.concat(F.substring_index(name, "(", 1), F.array_join(F.transform(F.filter(notes, lambda x: ~left_out(x)), lambda x: F.concat(lit("("), x, lit(")"))), " ")))
    shape = stem.rlike(r"(?i)^Claude(\s+[a-z]+)+\s+\d+(\.\d+)*(\s*\(Fast\))?$")
    main = rows.where(headed("Model", "Base Input Tokens", "5m Cache Writes", "1h Cache Writes", "Cache Hits & Refreshes", "Output Tokens"))
    flat = main.select("url", "ord", slug(stem, "a-z0-9").alias("model_id"), (size != "").alias("tiered"), threshold.alias("threshold"), over.alias("over"), (~shape).alias("odd"), (F.size("cells") != 6).alias("short"), *[cell(i).alias(n) for i, n in ((1, "i"), (2, "w"), (3, "h"), (4, "r"), (5, "o"))])
    got = scan(flat.where("not odd"), **{n: (n, "$", "") for n in "iwhro"})
    axes = {"input": "i", "cache_write": "w", "cache_write_1h": "h", "cache_read": "r", "output": "o"}
    bad = F.greatest(*[c(f"{n}_bad") | (F.size(f"{n}_amounts") != 1) for n in axes.values()]) | c("short")
    own = rates(**{a: F.round(amount(n), 6) for a, n in axes.items()})
    read = got.select("url", "ord", "model_id", "tiered", "threshold", "over", bad.alias("bad"), own.alias("own"))
    each = read.groupBy("url", "model_id").agg(
        F.min("ord").alias("ord"), F.max("bad").alias("bad"), F.count_if(~c("tiered")).alias("plain"), F.count_if(c("tiered") & ~c("over")).alias("low"), F.count_if(c("tiered") & c("over")).alias("high"),
        F.count_distinct(F.when(c("tiered"), c("threshold"))).alias("bounds"), F.max("threshold").alias("threshold"), F.min_by("own", F.when(~c("over") | ~c("tiered"), c("ord"))).alias("base"), F.min_by("own", F.when(c("over") & c("tiered"), c("ord"))).alias("more"),
    )
    fast = rows.where(headed("Model", "Input", "Output")).select("url", c("ord").alias("at"), F.explode(F.split(cell(0), " / ")).alias("n"), cell(1).alias("i"), cell(2).alias("o"))
    fast = scan(fast.select("url", "at", slug(clean(c("n")), "a-z0-9").alias("model_id"), "i", "o"), fi=("i", "$", ""), fo=("o", "$", ""))
    fast = fast.groupBy("url", "model_id").agg(F.count(lit(1)).alias("fast"), F.max(c("fi_bad") | c("fo_bad") | (F.size("fi_amounts") != 1) | (F.size("fo_amounts") != 1)).alias("fast_bad"), F.min_by(F.struct(amount("fi").alias("i"), amount("fo").alias("o")), "at").alias("f"))
    joined = each.join(fast, ["url", "model_id"], "left")
    pair = (c("low") == 1) & (c("high") == 1) & (c("bounds") == 1) & (c("plain") == 0)
    fault = faults((c("bad"), "unreadable rate"), ((c("low") + c("high") > 0) & ~pair, "prompt-length rows aren't one pair"), (c("plain") > 1, "two rows"), (c("fast") > 1, "two fast-mode rows"), (F.coalesce("fast_bad", lit(False)), "fast-mode rate"))
    longer = F.when(pair, override(c("more"), min_tokens=c("threshold")))
    quick = F.when(c("f").isNotNull(), override(rates(input=c("f.i"), output=c("f.o")), mode="fast"))
    base = {a: c(f"base.{a}") for a in axes}
    return priced(joined, "anthropic", fault, base, overrides=some(F.array_compact(F.array(longer, quick))))


@source(tables=True)
def dashscope(pages: Pages) -> DataFrame:
    """International rows of tables: promotions, and peak rates over the complement of the off-peak hours, in UTC."""
    resold = ("deepseek-v3.2", "deepseek-v4-flash", "deepseek-v4-pro", "glm-5.1", "glm-5.2", "kimi-k2.7-code")  # fixed values
    rows = pages.rows.where(~c("first") & F.get("top", 0).startswith("Model ID") & F.contains(cell(1), lit("International")))
    at = lambda *labels: F.array_position(F.transform("top", lambda x: x.rlike("^(" + "|".join(labels) + ")")), lit(True)) - 1
    i, o, span = at("Input price", "Input unit price"), at("Output price", "Output unit price"), at("Input token")
    ranged = F.array_position(F.transform(F.slice("cells", 3, 1000), lambda x: x.rlike(r"Token\s*[<≤]|^No tiered pricing$|^flat-rate pricing$")), lit(True)) + 1
    shift = F.when((span >= 0) & (ranged > 1), ranged - span).otherwise(0)
    rows = rows.where((i >= 0) & (o >= 0) & (i + shift >= 2) & (o + shift >= 2) & (F.size("cells") > F.greatest(i, o) + shift))
    flat = rows.select("url", "ord", F.get(F.split(F.trim(cell(0)), r"\s+"), 0).alias("model_id"), F.get("cells", (i + shift).cast("int")).alias("i"), F.get("cells", (o + shift).cast("int")).alias("o"))
    got = scan(flat.where(c("model_id").rlike("(?i)^[a-z0-9][a-z0-9.-]*$") & ~c("model_id").isin(list(resold))), **{f"{n}{k}": (n, b, a) for n in "io" for k, b, a in (("d", "$", ""), ("u", "", " USD"))})
    for n in "io":
        got = got.withColumn(f"{n}_amounts", F.concat(f"{n}d_amounts", f"{n}u_amounts")).withColumn(f"{n}_bad", c(f"{n}d_bad") | c(f"{n}u_bad"))
    number = r"\$([0-9][0-9,]*(?:\.[0-9]+)?)"
    dec = lambda x: F.replace(x, lit(","), lit("")).try_cast("decimal(30,12)")

    def charged(n: str) -> tuple[Column, Column]:
        """(the rate in force, whether it can't be told): `NN% off` of a list price, or the amount beside it."""
        text, every = c(n), c(f"{n}_amounts")
        lists = F.regexp_extract_all(text, lit(f"(?i)(?:Original|List price)\\s*{number}"), lit(1))
        labelled = text.rlike("(?i)Original|List price")
        off = F.regexp_extract_all(F.regexp_replace(text, r"\s+", " "), lit(r"(?i)(?<![\d.,$])(?<![\d.,]\s)(\d[\d,]*(?:\.\d+)?)\s*%\s*off"), lit(1))
        marks = F.length(text) - F.length(F.replace(text, lit("%"), lit("")))
        others = F.filter(every, lambda x: dec(x) != dec(F.get(lists, 0)))
        percent = dec(F.get(off, 0))
        one = F.size(every) == 1
        value = F.when(F.size(off) == 0, dec(F.get(every, 0))).when(F.size(every) == 2, dec(F.element_at(F.when(F.size(others) > 0, others), -1))).otherwise(dec(F.get(every, 0)) * (100 - percent) / 100)
        odd = F.when(F.size(off) == 0, labelled | (marks > 0)).otherwise(
            (marks != F.size(off))
            | (F.size(F.array_distinct(off)) > 1)
            | F.when(F.size(every) == 2, (F.size(F.array_distinct(lists)) != 1) | (F.size(others) == 0) | (F.size(others) == 2) | text.rlike(r"(?i)\bCached?\b")).otherwise(~one | (F.size(lists) != 1) | (percent > 100))
        )
        return value.cast("double"), (F.size(every) > 0) & odd

    def split(n: str) -> tuple[Column, Column, Column]:
        """(off-peak, peak, whether a cell that names a peak can't be told)."""
        peak = F.regexp_extract_all(c(n), lit(rf"(?i)(?<![-\w])Peak\s*{number}"), lit(1))
        off = F.regexp_extract_all(c(n), lit(rf"(?i)\bOff-peak\s*{number}"), lit(1))
        return dec(F.get(off, 0)).cast("double"), dec(F.get(peak, 0)).cast("double"), (F.size(peak) != 1) | (F.size(off) != 1) | (F.size(f"{n}_amounts") != 2) | c(n).contains("%")

    timed = {n: c(n).rlike("(?i)peak") for n in "io"}
    note = r"(?i)(?:(?<![-\w])peak hours are from (\d{1,2}):(\d{2}) to (\d{1,2}):(\d{2}) \(UTC\+(\d{1,2})\), and )?off-peak hours are from (\d{1,2}):(\d{2}) to (\d{1,2}):(\d{2})(?: the next day)? \(UTC\+(\d{1,2})\)"
    said = pages.bodies.select("url", F.explode(F.regexp_extract_all(plain(c("body")), lit(note), lit(0))).alias("t"))
    part = lambda k: F.regexp_extract("t", note, k).try_cast("int")
    minute = lambda k, zone: F.pmod(part(k) * 60 + part(k + 1) - part(zone) * 60, lit(1440))
    start, end = minute(8, 10), minute(6, 10)  # the peak hours are what the off-peak ones leave
    odd_note = (part(10) > 14) | (part(6) > 23) | (part(8) > 23) | (part(7) > 59) | (part(9) > 59) | (start == end) | (part(1).isNotNull() & ((minute(1, 5) != start) | (minute(3, 5) != end)))
    clock_of = lambda m: F.floor(m / 60).cast("int") * 100 + (m % 60).cast("int")
    windows = F.when(start < end, F.array(F.array(clock_of(start), clock_of(end)))).when(end == 0, F.array(F.array(clock_of(start), lit(2400)))).otherwise(F.array(F.array(clock_of(start), lit(2400)), F.array(lit(0), clock_of(end))))
    plan = said.groupBy("url").agg(F.max(odd_note).alias("odd_note"), F.count_distinct(windows).alias("plans"), F.max(windows).alias("windows"))
    (iv, ib), (ov, ob), (ioff, ipeak, isplit), (ooff, opeak, osplit) = charged("i"), charged("o"), split("i"), split("o")
    both = timed["i"] & timed["o"]
    fault = faults((c("i_bad") | c("o_bad"), "unreadable rate"), (timed["i"] != timed["o"], "one of two cells names a peak"), (both & (isplit | osplit), "peak cells"), (both & (F.coalesce("plans", lit(0)) != 1), "peak hours"), (both & c("odd_note"), "peak hours"), (~both & (ib | ob), "promotion"))
    over = F.when(both, F.transform("windows", lambda w: override(rates(input=ipeak, output=opeak), window=w)))
    rows = got.join(plan, "url", "left").where(both | (F.size("i_amounts") > 0) & (F.size("o_amounts") > 0) | c("i_bad") | c("o_bad") | timed["i"] | timed["o"])
    return priced(rows, "dashscope", fault, {"input": F.when(both, ioff).otherwise(iv), "output": F.when(both, ooff).otherwise(ov)}, overrides=over)


@source(tables=True, wanted={"p": Sel(("p", "li", "div"))})
def deepseek(pages: Pages) -> DataFrame:
    """A table of ids across and labelled rows down, off-peak and peak; a footnote's windows and weekdays; fees of a guide."""
    rows = pages.rows
    main = rows.where(F.get("head", 0) == "model")
    label = F.get(F.filter("cells", lambda x: x.startswith("1M ")), 0)
    marked = main.where(~c("first")).withColumn("label", F.last(label, ignorenulls=True).over(Window.partitionBy("url", "table").orderBy("ord")))
    mark = F.when(F.array_contains("cells", "OFF-PEAK"), "OFF-PEAK").when(F.array_contains("cells", "PEAK"), "PEAK")
    values = marked.withColumn("mark", mark).where("mark is not null and label is not null").select("url", "label", "mark", F.slice("cells", F.array_position("cells", c("mark")).cast("int") + 1, 1000).alias("v"))
    ids = main.where("first").select("url", "table", F.posexplode(F.slice("cells", 2, 1000)).alias("at", "id")).select("url", "table", "at", F.regexp_replace(F.trim("id"), r"\s*\(\d+\)$", "").alias("model_id")).where("model_id rlike '^[a-z0-9][a-z0-9.-]*$'")
    # The labels of the rows.
    axes = {"1M INPUT TOKENS (CACHE MISS)": "i", "1M OUTPUT TOKENS": "o", "1M INPUT TOKENS (CACHE HIT)": "r"}
    wide = ids.join(values, "url").groupBy("url", "table", "at", "model_id").agg(*[F.max(F.when((c("label") == k) & (c("mark") == m), F.get("v", c("at")))).alias(f"{p}{n}") for k, n in axes.items() for m, p in (("OFF-PEAK", ""), ("PEAK", "p"))])
    got = scan(wide.withColumn("ord", c("at")), **{n: (n, "$", "") for n in ("i", "o", "r", "pi", "po", "pr")})

    def size(label: str, pattern: str, scale: int) -> DataFrame:
        row = main.where(cell(0) == label).select("url", F.slice("cells", 2, 1000).alias("v"), F.size("top").alias("n"))
        own = ids.join(row, "url").select("url", "model_id", F.when(F.size("v") == c("n") - 1, F.get("v", c("at"))).otherwise(F.get(F.filter("v", lambda x: x.rlike(pattern)), 0)).alias("t"))
        return own.groupBy("url", "model_id").agg(F.max(F.floor(F.regexp_extract("t", pattern, 1).try_cast("double")).cast("bigint") * scale).alias("n" + str(scale)))

    got = got.join(size("CONTEXT LENGTH", r"(?i)(\d+(?:\.\d+)?)\s*M\b", 1024 * 1024), ["url", "model_id"], "left").join(size("MAX OUTPUT", r"(?i)(\d+(?:\.\d+)?)\s*K\b", 1024), ["url", "model_id"], "left")
    # a note says from when to when, twice, in UTC; what follows may name weekdays
    said = lambda x: F.substring_index(x, "Peak hours are ", -1)
    hours = lambda x: F.flatten(F.transform(F.split(F.substring_index(said(x), " UTC", 1), " and "), lambda span: F.split(span, " - ")))
    whole = c("value").contains("Peak hours are ") & said(c("value")).contains(" UTC") & (F.size(hours(c("value"))) == 4) & F.forall(hours(c("value")), lambda x: x.rlike("^[0-9]{2}:[0-9]{2}$"))
    note = pages.elements.where(whole).groupBy("url").agg(F.min_by("value", F.length("value")).alias("note"))
    clocks = [hhmm(F.get(hours(c("note")), k)) for k in range(4)]
    behind = said(c("note"))
    tail = F.lower(F.substring(behind, F.length(F.substring_index(behind, " UTC", 1)) + 5, F.length(behind)))
    weekly = F.contains(tail, lit("monday through friday"))
    other = ~weekly & tail.rlike(r"\b(mon|tue|wed|thu|fri|sat|sun|weekdays?|mondays?|tuesdays?|wednesdays?|thursdays?|fridays?|saturdays?|sundays?)\b")
    late = weekly & (F.greatest(clocks[1], clocks[3]) > 1600)
    fees = rows.where((c("head") == F.array(lit("api"), lit("unit"), lit("price"))) & ~c("first")).select("url", F.regexp_replace(fold_heading(cell(0)), " api$", "").alias("k"), cell(2).alias("p"), F.regexp_extract(cell(1), r"(?i)^per\s+([\d,.]*)\s+successful requests$", 1).alias("n")).where("k in ('search', 'fetch')")
    fees = scan(fees, p=("p", "$", ""), n=("n", "", ""))
    fee = fees.groupBy("url.run").agg(*[F.max(F.when((c("k") == k) & ~c("p_bad") & (F.size("p_amounts") == 1) & ~c("n_bad") & (F.size("n_amounts") == 1), amount("p") / amount("n"))).alias(k) for k in ("search", "fetch")], F.count(lit(1)).alias("fee_rows"))
    got = got.withColumn("run", c("url.run")).join(fee, "run", "left").join(note, "url", "left")
    peak = amount("pi").isNotNull() | amount("po").isNotNull() | amount("pr").isNotNull()
    half = peak & (amount("pi").isNull() | amount("po").isNull())
    fault = faults((F.greatest(*[c(f"{n}_bad") for n in ("i", "o", "r", "pi", "po", "pr")]), "unreadable rate"), (peak & ~half & c("note").isNull(), "peak hours"), (peak & F.coalesce(other | late, lit(False)), "peak weekdays"), (c("search").isNull() | c("fetch").isNull() | (c("fee_rows") != 2), "fees"))
    days = F.when(weekly, F.array(*map(lit, DAYS[:5])))
    over = F.when(peak & ~half, F.array(*[override(rates(input=amount("pi"), output=amount("po"), cache_read=amount("pr")), days=days, window=F.array(clocks[k], clocks[k + 1])) for k in (0, 2)]))
    return priced(got, "deepseek", fault, {"input": F.when(~half, amount("i")), "output": amount("o"), "cache_read": amount("r")}, overrides=over, fees=F.struct(lit(None).cast("double").alias("web_search"), "search", "fetch"), limits={"context": c("n1048576"), "output": c("n1024")}, effective=F.when(peak & weekly, lit("2026-08-23")))


@source(tables=True, inner={"link": Sel("a"), "matrix": Sel("span", ("gen-ai-pricing-matrix",)), "line": Sel("span", ("gen-ai-pricing-matrix-row",)), "field": Sel("span", parent="line")})
def digitalocean(pages: Pages) -> DataFrame:
    """A matrix of spans in a table's cell: modes become ids, longer prompts overrides; a model without an output rate costs nothing for it."""
    rows = data_rows(pages, F.exists(F.array(lit(0)), lambda _: F.get("head", F.size("head") - 1).startswith("serverless inference") & F.get("head", F.size("head") - 2).startswith("model") & F.size("head").isin(2, 3)))
    last = F.size("cells") - 1
    link = F.get(F.transform(F.filter("inner", lambda x: (x["name"] == "link") & (x["cell"] == last - 1)), lambda x: x["value"]), 0)
    lines = F.filter("inner", lambda x: x["name"] == "line")
    fields = F.filter("inner", lambda x: x["name"] == "field")
    flat = rows.where(F.exists("inner", lambda x: x["name"] == "matrix")).select("url", c("ord").alias("tr"), F.coalesce(link, F.get("cells", (last - 1).cast("int"))).alias("name"), lines.alias("lines"), fields.alias("fields")).where(~c("name").rlike(r"(?i)\bimage\b"))
    line = flat.select("url", "tr", "name", "fields", F.posexplode("lines").alias("k", "line"), F.transform("lines", lambda x: x["no"]).alias("nos"))
    until = F.coalesce(F.get("nos", c("k") + 1), lit(2**31 - 1))
    line = line.select("url", "tr", slug(c("name")).alias("name"), "k", F.transform(F.filter("fields", lambda f: (f["no"] > c("line.no")) & (f["no"] < until)), lambda f: f["value"]).alias("v"))
    w = Window.partitionBy("url", "tr").orderBy("k")
    line = line.withColumn("labels", F.first(F.transform("v", fold_heading)).over(w)).where("k > 0")
    under = lambda x: F.get("v", (F.array_position("labels", x) - 1).cast("int"))
    value = lambda x: F.regexp_extract(F.coalesce(under(x), lit("")), r"^\$(\d+(?:\.\d+)?)$", 1).try_cast("double")
    odd = lambda x: under(x).isNotNull() & ~F.lower(under(x)).isin("n/a", "-", "") & value(x).isNull()
    mode = slug(under("processing mode"))
    longer = lambda x: F.when(F.trim(x).startswith(">"), sized(F.replace(F.replace(F.lower(F.trim(x)), lit(">"), lit("")), lit("tokens"), lit(""))).cast("bigint"))
    each = line.select("url", (c("tr") * 1000 + c("k")).alias("ord"), F.when(mode == "standard", c("name")).otherwise(F.concat_ws("-", "name", mode)).alias("model_id"), (mode == "standard").alias("standard"), value("input").alias("i"), value("output").alias("o"), value("cache read").alias("r"), longer(under("prompt length")).alias("min_tokens"), (odd("input") | odd("output") | odd("cache read")).alias("bad"), (F.size("v") != F.size("labels")).alias("short"), F.array_contains("labels", "output").alias("has"))
    full = c("i").isNotNull() & c("o").isNotNull()
    tiers = F.sort_array(F.collect_list(F.when(full & c("standard"), F.struct("ord", "min_tokens", "i", "o", "r"))))
    one = each.where("model_id rlike '^[a-z0-9][a-z0-9._/-]*$'").groupBy("url", "model_id").agg(F.min("ord").alias("ord"), F.min_by(F.struct("i", "o", "r"), F.when(full, c("ord"))).alias("base"), F.min_by(F.struct("i", "r"), F.when(c("i").isNotNull() & c("o").isNull() & c("standard"), c("ord"))).alias("half"), tiers.alias("tiers"), F.max("bad").alias("bad"), F.max("short").alias("short"), F.min("has").alias("has"))
    more = F.filter(F.slice("tiers", 2, 1000), lambda t: t["min_tokens"].isNotNull())
    over = some(F.transform(more, lambda t: override(rates(input=t["i"], output=t["o"], cache_read=t["r"]), min_tokens=t["min_tokens"])))
    fault = faults((c("short"), "matrix row"), (~c("has"), "no output column"), (c("bad"), "unreadable rate"), (c("base").isNull() & c("half").isNull(), "no rates"))
    return priced(one, "digitalocean", fault, {"input": F.coalesce("base.i", "half.i"), "output": F.when(c("base").isNotNull(), c("base.o")).otherwise(F.when(c("half").isNotNull(), 0.0)), "cache_read": F.when(c("base").isNotNull(), c("base.r")).otherwise(c("half.r"))}, overrides=over)


@source()
def google(pages: Pages) -> DataFrame:
    """Sections of lines with tabs and bulleted tables: the standard tab, the paid column; a rate over a bound becomes an override."""
    line = pages.bodies.select("url", F.posexplode(F.split("body", "\r\n?|\n")).alias("n", "t"))
    anchor = F.regexp_extract("t", r'^## .+?\{% id="([^"]+)" %\}\s*$', 1)
    w = Window.partitionBy("url").orderBy("n")
    line = line.withColumn("section", F.sum((anchor != "").cast("int")).over(w)).where("section > 0").withColumn("anchor", F.first(anchor).over(Window.partitionBy("url", "section").orderBy("n")))
    tag = lambda x: c("t").rlike(r"^\s*\{% " + x + r" %\}\s*$")
    s = Window.partitionBy("url", "section").orderBy("n")
    line = line.withColumn("table", F.sum(tag("table").cast("int")).over(s)).withColumn("ended", F.sum(tag("/table").cast("int")).over(s)).withColumn("inside", (c("table") > c("ended")) & ~tag("table"))
    title = F.regexp_extract("t", r'^\s*\{% tab title="([^"]*)" %\}\s*$', 1)
    state = F.when(~c("inside") & (title != ""), title).when(~c("inside") & (tag("/tab") | tag("tabs") | tag("/tabs")), "")
    line = line.withColumn("tab", F.coalesce(F.last(state, ignorenulls=True).over(s), lit("")))
    link = F.regexp_extract_all("t", lit(r"\[`([^\s`]+)`\]\(/docs/models/\S+?\)"), lit(1))
    ids = line.where("table = 0").groupBy("url", "section").agg(F.max("anchor").alias("anchor"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("n", link.alias("x")))), lambda v: v["x"])).alias("links"))
    prose = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~c("inside"), F.struct("n", F.trim("t").alias("x"))))), lambda v: v["x"]), " ")
    context = line.groupBy("url", "section").agg(sized(word_before(prose, "token context window")).cast("bigint").alias("context"))
    t = Window.partitionBy("url", "section", "table").orderBy("n")
    body = line.where("inside").withColumn("row", F.sum(c("t").rlike(r"^\s*---\s*$").cast("int")).over(t)).where(~c("t").rlike(r"^\s*---\s*$"))
    bullet = r"^\s*\* (.*)$"
    body = body.withColumn("cell", F.sum(c("t").rlike(bullet).cast("int")).over(t)).where("cell > 0 and trim(t) <> ''")
    text = F.trim(F.regexp_replace(F.regexp_replace(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", F.when(c("t").rlike(bullet), F.regexp_extract("t", bullet, 1)).otherwise(F.trim("t")).alias("x")))), lambda v: v["x"]), " "), r"\{%.*?%\}", " "), r"\s+", " "))
    cells = body.groupBy("url", "section", "table", "row", "cell").agg(text.alias("x"), F.max("tab").alias("tab"))
    rows = cells.groupBy("url", "section", "table", "row").agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "x"))), lambda v: v["x"]).alias("cells"), F.max("tab").alias("tab"))
    rw = Window.partitionBy("url", "section", "table").orderBy("row")
    rows = rows.withColumn("top", F.first("cells").over(rw)).withColumn("nth", F.row_number().over(rw)).where("nth > 1")
    paid = (F.array_position(F.transform("top", lambda x: x.contains("Paid Tier, per 1M tokens in USD")), lit(True)) - 1).cast("int")
    whole = Window.partitionBy("url", "section")
    rows = rows.where(paid >= 0).withColumn("tabs", F.max((c("tab") != "").cast("int")).over(whole)).where("tabs = 0 or tab = 'Standard'").withColumn("least", F.min("table").over(whole)).where("table = least")
    first = lambda *starts: F.coalesce(*[F.min_by(F.when(cell(0).startswith(x), F.get("cells", paid)), F.when(cell(0).startswith(x), c("row"))) for x in starts])
    wide = rows.groupBy("url", "section").agg(first("Input price").alias("i1"), first("Text input price").alias("i2"), first("Output price").alias("o"), F.max(F.when(cell(0) == "Context caching price", F.get("cells", paid))).alias("r"), F.max(cell(0).startswith("Output price")).alias("has_out"))
    wide = wide.where("i1 is not null or i2 is not null").join(ids, ["url", "section"]).join(context, ["url", "section"])
    got = wide.select("*", F.explode(F.when(F.size("links") > 0, c("links")).otherwise(F.array("anchor"))).alias("model_id")).withColumn("ord", c("section"))
    behind = lambda n: F.split(F.trim(F.substring(c(n), F.instr(c(n), ">") + 1, F.length(n))), r"[\s,]+(?![0-9])")
    word = lambda n: F.when(F.upper(F.get(behind(n), 1)).isin("K", "M"), F.concat(F.get(behind(n), 0), F.get(behind(n), 1))).otherwise(F.get(behind(n), 0))
    size_at = lambda n: F.when((F.instr(c(n), ">") > 0) & F.upper(word(n)).rlike("[KM]$"), sized(word(n)))
    for n in ("i1", "i2", "o", "r"):
        got = got.withColumn(f"{n}_at", size_at(n).cast("bigint")).withColumn(f"{n}t", F.when(c(f"{n}_at").isNotNull(), F.substring_index(n, ">", 1)).otherwise(""))
    got = scan(got, **{n: (n, "$", "") for n in ("i1", "i2", "o", "r")}, **{f"{n}t": (f"{n}t", "$", "") for n in ("i1", "i2", "o", "r")})

    def rate(n: str) -> Column:
        """The first amount, unless it is per something else than tokens."""
        return F.when(~F.coalesce(F.regexp_extract(c(n), r"(?s)\$[0-9][0-9,]*(?:\.[0-9]+)?\s*(per )", 1) != "", lit(False)) | (F.instr(c(n), "per ") > F.instr(c(n), "$") + 12), amount(n))

    text_in = rate("i1").isNull()
    over_of = lambda n: F.when(c(f"{n}_at").isNotNull(), amount(f"{n}t", -1))
    at = lambda n: c(f"{n}_at")
    i_at, i_over = F.when(text_in, at("i2")).otherwise(at("i1")), F.when(text_in, over_of("i2")).otherwise(over_of("i1"))
    bounds = F.array_distinct(F.array_compact(F.array(i_at, at("o"), at("r"))))
    fault = faults((F.greatest(*[F.coalesce(c(f"{n}_bad"), lit(False)) for n in ("i1", "i2", "o", "r")]), "unreadable rate"), (F.size(bounds) > 1, "long-context bounds differ"))
    over = F.when(F.size(bounds) == 1, F.array(override(rates(input=i_over, output=over_of("o"), cache_read=over_of("r")), min_tokens=F.get(bounds, 0))))
    return priced(got, "google", fault, {"input": F.coalesce(rate("i1"), rate("i2")), "output": F.coalesce(rate("o"), F.when(~c("has_out"), 0.0)), "cache_read": rate("r")}, overrides=over, limits={"context": c("context")})


@source(tables=True, component="DocTable", clean=unfenced)
def moonshot(pages: Pages) -> DataFrame:
    """Tables as component properties, or HTML tables, or calls in script state; writes of five minutes and of an hour."""
    # Titles of a rendered page and what they are on the plain one.
    titles = {"Input": "Input Price", "Output": "Output Price", "Cached Input": "Cached Input Price", "5m writes": "Cache Write Price (TTL 5min)", "1h writes": "Cache Write Price (TTL 1h)"}
    calls = pages.components.select("url", (c("late") * 2).alias("late"), "ord", "top", "cells")
    html = pages.rows.where("not first and not in_foot").select("url", lit(1).alias("late"), (c("table").cast("bigint") * 100_000 + c("ord")).alias("ord"), "top", "cells")
    known = F.create_map(*[lit(x) for kv in titles.items() for x in kv])
    rows = calls.unionByName(html).withColumn("head", F.transform("top", lambda t: F.when(c("late") == 2, F.coalesce(F.try_element_at(known, t), t)).otherwise(t)))
    flat = rows.select("url", "late", "ord", F.lower(F.trim(column("Model"))).alias("model_id"), F.coalesce(column("Input Price (Cache Miss)"), column("Input Price")).alias("i"), column("Output Price").alias("o"), F.coalesce(column("Input Price (Cache Hit)"), column("Cached Input Price")).alias("r"), column("Cache Write Price (TTL 5min)").alias("w"), column("Cache Write Price (TTL 1h)").alias("h"), column("Context Window").alias("n"))
    got = scan(flat.where("i is not null and o is not null and model_id rlike '^[a-z0-9][a-z0-9.-]*$'"), **{n: (n, "$", "") for n in "iorwh"})
    size = F.replace(F.regexp_extract(F.coalesce("n", lit("")), r"\d[\d,]*", 0), lit(","), lit("")).try_cast("bigint")
    some_price = got.where(F.greatest(*[c(f"{n}_bad") for n in "iorwh"]) | (F.size("i_amounts") > 0) & (F.size("o_amounts") > 0))
    return priced(some_price, "moonshot", faults((F.greatest(*[c(f"{n}_bad") for n in "iorwh"]), "unreadable rate")), {"input": amount("i"), "output": amount("o"), "cache_read": amount("r"), "cache_write": amount("w"), "cache_write_1h": amount("h")}, limits={"context": size}, order=("late",))


@source(wanted={"pane": Sel(attrs={"data-content-switcher-pane": "true"}), "switch": Sel(attrs={"data-content-switcher-id": "multimodal-image-pricing"}), "island": Sel("astro-island", value="props")})
def openai(pages: Pages) -> DataFrame:
    """Properties of page islands: rows of the standard tier, groups of image models, and a batch mode where it prices all that the standard one does."""
    rows = pages.elements
    island = rows.where("name = 'island'").select("url", "no", F.col("attrs")["component-export"].alias("kind"), c("path.pane").alias("pane"), c("path.switch").isNotNull().alias("image"), F.try_parse_json("value").alias("v"))
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    name = r"^([a-z0-9][a-z0-9.-]*)(?: \(.*\))?$"
    text = island.where((c("kind") == "TextTokenPricingTables") & (get(c("v"), "$.tier[1]", "string") == "standard"))
    row = text.select("url", "no", F.posexplode(get(c("v"), "$.rows[1]", "array<variant>")).alias("k", "r")).select("url", (c("no") * 10_000 + c("k")).alias("ord"), get(c("r"), "$[1]", "array<variant>").alias("x"))
    at = lambda i: F.get("x", i)
    raw = lambda v: get(v, "$[1]", "string")
    rate = lambda v: raw(v).try_cast("double")
    odd = lambda v: raw(v).isNotNull() & (raw(v) != "-") & rate(v).isNull()
    n = F.size("x")
    last = F.get("x", n - 1)
    write = F.when(n == 5, rate(at(3)))
    chat = row.select("url", "ord", F.regexp_extract(raw(at(0)), name, 1).alias("model_id"), rate(at(1)).alias("i"), rate(at(2)).alias("r"), write.alias("w"), rate(last).alias("o"), lit(None).cast("double").alias("mi"), lit(None).cast("double").alias("mo"), (odd(at(1)) | odd(at(2)) | odd(last)).alias("bad"), (~n.isin(4, 5)).alias("short"), lit(None).cast("struct<i:double,o:double,r:double,mi:double,mo:double>").alias("batch"), lit(False).alias("image"))
    panes = rows.where("name = 'pane'").select("url", c("no").alias("pane"), F.col("attrs")["data-value"].alias("tier"))
    group = island.where("image and kind = 'GroupedPricingTable'").join(panes, ["url", "pane"])
    group = group.withColumn("nth", F.row_number().over(Window.partitionBy("url", "tier").orderBy("no"))).where("nth = 1")
    label = lambda h: F.coalesce(get(h, "$[1]", "string"), get(h, "$[1].__pricingTooltipHeading[1].label[1]", "string"))
    heads = F.filter(F.transform(get(c("v"), "$.headings[1]", "array<variant>"), lambda h: fold_heading(F.coalesce(get(h, "$[1].__pricingTooltipHeading[1].label[1]", "string"), label(h)))), lambda h: h != "model")
    each = group.select("url", "no", "tier", heads.alias("head"), F.posexplode(get(c("v"), "$.groups[1]", "array<variant>")).alias("k", "g"))
    each = each.select("url", "no", "tier", "k", "head", get(c("g"), "$[1].model[1]", "string").alias("model"), F.explode(get(c("g"), "$[1].rows[1]", "array<variant>")).alias("r"))
    under = lambda x: F.get(get(c("r"), "$[1]", "array<variant>"), (F.array_position("head", x) - 1).cast("int"))
    line = each.select("url", "no", "tier", "k", F.regexp_extract("model", name, 1).alias("model_id"), raw(under("modality")).alias("kind"), *[rate(under(x)).alias(y) for x, y in (("input", "i"), ("output", "o"), ("cached input", "r"))], (odd(under("input")) | odd(under("output")) | odd(under("cached input"))).alias("bad"))
    wide = line.groupBy("url", "model_id", "tier").agg(F.min(c("no") * 10_000 + c("k")).alias("ord"), F.max("bad").alias("bad"), *[F.max(F.when(c("kind") == k, c(x))).alias(p + x) for k, p in (("Text", "t"), ("Image", "m")) for x in "ior"])
    full = wide.select("url", "model_id", "tier", "ord", "bad", F.struct(c("ti").alias("i"), F.coalesce("to", "mo").alias("o"), c("tr").alias("r"), c("mi").alias("mi"), c("mo").alias("mo")).alias("p"))
    whole = lambda p: c(f"{p}.i").isNotNull() & c(f"{p}.o").isNotNull() & c(f"{p}.mi").isNotNull() & c(f"{p}.mo").isNotNull()
    batch = full.where("tier = 'batch'").select("url", "model_id", c("p").alias("b"))
    image = full.where("tier = 'standard'").join(batch, ["url", "model_id"], "left")
    kept = F.when(whole("b") & (c("p.r").isNull() | c("b.r").isNotNull()), c("b"))
    image = image.select("url", "ord", "model_id", F.when(whole("p"), c("p.i")).alias("i"), c("p.r").alias("r"), lit(None).cast("double").alias("w"), c("p.o").alias("o"), c("p.mi").alias("mi"), c("p.mo").alias("mo"), "bad", lit(False).alias("short"), kept.alias("batch"), lit(True).alias("image"))
    both = chat.unionByName(image)
    both = both.withColumn("twice", F.size(F.collect_set("image").over(Window.partitionBy("url", "model_id"))) > 1)
    over = F.when(c("batch").isNotNull(), F.array(override(rates(input=c("batch.i"), output=c("batch.o"), cache_read=c("batch.r"), image=c("batch.mi"), image_output=c("batch.mo")), mode="batch")))
    return priced(both, "openai", faults((c("twice"), "in two tables"), (c("short"), "cells"), (c("bad"), "unreadable rate")), {"input": c("i"), "output": c("o"), "cache_read": c("r"), "cache_write": c("w"), "image": c("mi"), "image_output": c("mo")}, overrides=over)


@source(tables=True)
def zai(pages: Pages) -> DataFrame:
    """Tables whose last amount counts, Free as zero; a notice's multipliers in peak hours of another zone."""
    rows = data_rows(pages, F.array_contains("head", "model") & F.array_contains("head", "input") & F.array_contains("head", "output"))
    flat = rows.select("url", "ord", F.lower(F.trim(cell(0))).alias("model_id"), column("input").alias("i"), column("output").alias("o"), column("cached input").alias("r"), (~F.array_contains("head", "cached input")).alias("uncached"), (F.size("cells") < F.size("head")).alias("short"))
    got = scan(flat.where("model_id rlike '^glm-[a-z0-9][a-z0-9.-]*$'"), i=("i", "$", ""), o=("o", "$", ""), r=("r", "$", ""))
    own = lambda n: F.when(F.size(f"{n}_amounts") > 0, amount(n, -1)).when(F.contains(F.lower(n), lit("free")), 0.0)
    peak = r"Peak hours: ([A-Za-z]+) to ([A-Za-z]+), (\d{1,2}):(\d{2})[–—-](\d{1,2}):(\d{2}) Singapore Standard Time \(UTC\+(\d{1,2})\)"
    clause = r'\*\*([^*]+)\*\*:.*?API calls consume quota at a rate of "?(\d+(?:\.\d+)?)× during off-peak hours and (\d+(?:\.\d+)?)× during peak hours'
    notice = pages.bodies.where("body like '%consume quota at a rate of%' or body like '%Peak hours:%'")
    part = lambda k: F.regexp_extract("body", peak, k)
    num = lambda k: part(k).try_cast("int")
    said = F.regexp_extract_all("body", lit(clause), lit(0))
    count = F.size(F.split("body", "consume quota at a rate of")) - 1
    odd = (part(1) == "") | (count != F.size(said)) | (num(7) > 14) | (num(3) > 23) | (num(4) > 59) | (num(6) > 59) | ((num(5) > 23) & ~((num(5) == 24) & (num(6) == 0))) | ((num(3) == num(5)) & (num(4) == num(6)))
    week = F.array(*map(lit, DAYS))
    first, last = F.array_position(week, F.lower(part(1))), F.array_position(week, F.lower(part(2)))
    plan = F.transform(utc(num(3) * 60 + num(4), num(5) * 60 + num(6), num(7) * 60), lambda w: F.named_struct(lit("days"), shifted(day_range(F.lower(part(1)), F.lower(part(2))), w["shift"]), lit("window"), F.array(clock(w["start"]), clock(w["end"]))))
    sane = ~F.coalesce(odd | (first == 0) | (last < first), lit(True))
    quota = notice.select(c("url.run").alias("run"), F.explode(said).alias("s"), F.when(sane, plan).alias("plan"), (~sane).alias("odd")).select("run", F.lower(F.trim(F.regexp_extract("s", clause, 1))).alias("model_id"), F.regexp_extract("s", clause, 2).cast("double").alias("off"), F.regexp_extract("s", clause, 3).cast("double").alias("on"), "plan", "odd")
    quota = quota.groupBy("run", "model_id").agg(F.max(F.struct("off", "on", "plan", "odd")).alias("q"))
    got = got.withColumn("run", c("url.run")).join(quota, ["run", "model_id"], "left")
    bare = lit(None).cast(RATES)
    base = F.filter(F.array(override(bare, multiplier=c("q.off"))), lambda o: o["quota_multiplier"] != 1.0)
    over = F.when(c("q").isNotNull() & ~c("q.odd"), F.concat(base, F.transform("q.plan", lambda w: override(bare, days=w["days"], window=w["window"], multiplier=c("q.on")))))
    fault = faults((c("uncached"), "no Cached Input column"), (c("short"), "cells"), (c("i_bad") | c("o_bad") | c("r_bad"), "unreadable rate"), (F.coalesce(c("q.odd"), lit(False)), "quota notice"))
    return priced(got, "zai", fault, {"input": own("i"), "output": own("o"), "cache_read": own("r")}, overrides=over)

