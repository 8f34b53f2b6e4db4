"""Pages made by hand, one for each source, and what stands on them."""

import json

import pytest

from ratevane.sources import registry
from ratevane.sources.priced import SOURCES


def table(head, *rows, caption=""):
    row = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{x}</{tag}>" for x in cells) + "</tr>"
    return f"<table><caption>{caption}</caption><thead>{row(head, 'th')}</thead><tbody>{''.join(row(r, 'td') for r in rows)}</tbody></table>"


def markdown(head, *rows):
    return "\n".join(["| " + " | ".join(r) + " |" for r in (head, ["---"] * len(head), *rows)])


def island(props, kind):
    return f"<astro-island component-export=\"{kind}\" props='{json.dumps(props)}'></astro-island>"


def tuples(x):
    return [1, [tuples(v) for v in x]] if isinstance(x, list) else [0, {k: tuples(v) for k, v in x.items()}] if isinstance(x, dict) else [0, x]


PAGES = {}
#: (source, id): (input, output, cache read, fault), and more by name.
WANT = {}


def page(source, body, url="u"):
    PAGES.setdefault(source, []).append((url, body))


page("ai21", '<div class="b-cards--type-models"><div class="card"><h3 class="card__title">Fig Mini!</h3><div class="card__footer">$0.25 / 1M input tokens <br>$1,000.5 / 1M output tokens</div></div><div class="card"><h3 class="card__title">Fig Odd</h3><div class="card__footer">$0,25 / 1M input tokens $1 / 1M output tokens</div></div></div><div class="card"><h3 class="card__title">Elsewhere</h3></div>')
WANT |= {("ai21", "fig-mini"): (0.25, 1000.5, None, None), ("ai21", "fig-odd"): (None, None, None, "unreadable rate")}

term = lambda usd, day, unit="1K tokens": {"o": {"effectiveDate": f"{day}T00:00:00Z", "priceDimensions": {"d": {"unit": unit, "pricePerUnit": {"USD": usd}}}}}
product = lambda model, kind: {"attributes": {"model": model, "feature": "On-demand Inference", "inferenceType": kind}}
page("amazon", json.dumps({"products": {"a": product("Nova Lite", "Input tokens"), "b": product("Nova Lite", "Output tokens"), "x": product("Nova Lite", "Prompt cache read input tokens"), "c": product("Nova Pro", "Input tokens"), "d": product("Nova Pro", "Text output token"), "e": product("Other", "Input tokens")}, "terms": {"OnDemand": {"a": term("0.00006", "2026-01-02"), "b": term("0.00024", "2026-03-01"), "x": term("0.000015", "2026-02-01"), "c": term("0.1", "2026-01-01", "hours"), "d": term("0.1", "2026-01-01")}}}))
WANT |= {("amazon", "amazon.nova-lite-v1:0"): (0.06, 0.24, 0.015, None, {"effective_at": "2026-03-01"}), ("amazon", "amazon.nova-pro-v1:0"): (None, None, None, "terms of a product")}

page("anthropic", markdown(["Model", "Base Input Tokens", "5m Cache Writes", "1h Cache Writes", "Cache Hits & Refreshes", "Output Tokens"], ["Claude Opal 9", "$10 / MTok", "$12.50 / MTok", "$20 / MTok", "$1 / MTok<sup>1</sup>", "$50 / MTok"], ["[Claude Reed 4.5](u) (for prompts up to 200K tokens)", *["$2"] * 5], ["Claude Reed 4.5 (for prompts over 200K input tokens)", *["$4"] * 5], ["Claude Dune 3", "$1-2", *["$1"] * 4], ["note", *["$1"] * 5]) + "\n\n" + markdown(["Model", "Input", "Output"], ["Claude Opal 9 / Claude Gone 1", "$30 / MTok", "$150 / MTok"]))
WANT |= {("anthropic", "claude-opal-9"): (10.0, 50.0, 1.0, None, {"modes": ["fast"], "write_1h": 20.0}), ("anthropic", "claude-reed-4-5"): (2.0, 2.0, 2.0, None, {"bounds": [200000]}), ("anthropic", "claude-dune-3"): (None, None, None, "unreadable rate")}

block = lambda k, v: f'<div class="av-mp"><span class="av-mp-label">{k}</span><span class="av-mp-val">{v}</span></div>'
page("avian", '<div id="avModelGrid"><div class="av-model-card"><div class="av-model-label">Oak 3.5</div><div class="av-model-meta">128K context</div>' + block("Input", "$0.10") + block("Output", "$0.40") + '</div><div class="av-model-card"><div class="av-model-label">Elm</div>' + block("Input", "$1") + "</div></div>")
WANT |= {("avian", "oak-3.5"): (0.1, 0.4, None, None, {"context": 128_000}), ("avian", "elm"): (None, None, None, None)}

twice = lambda x: f'<div><div class="md:hidden">{x}</div><div class="hidden md:flex">{x}</div></div>'
grid = lambda *cells: '<div class="grid">' + "".join(map(twice, cells)) + "</div>"
page("baseten", '<div class="grid"><div>Model</div><div>Input</div><div>Cache Input</div><div>Output</div></div>' + grid('<a href="/library/fir-1/">Fir 1</a>', "$0.5", "-", "$1.5 <a>Try Model API</a>") + grid('<a href="/library/fir-embed/">F</a>', "$0.1", "-", "-") + grid('<a href="/library/fir-2/">Fir 2</a>', "-", "-", "-") + grid('<a href="/library/fir-3/">Fir 3</a>', "$1 $2", "-", "$3"))
WANT |= {("baseten", "fir-1"): (0.5, 1.5, None, None), ("baseten", "fir-embed"): (0.1, 0.0, None, None), ("baseten", "fir-2"): (None, None, None, None), ("baseten", "fir-3"): (None, None, None, "amounts")}

page("cerebras", json.dumps({"data": [{"id": "ash-8b", "pricing": {"prompt": "0.0000001", "completion": "0"}}, {"id": "ash-x", "pricing": {"prompt": "-1", "completion": "1"}}, {"id": "ash-y", "pricing": {"prompt": "n/a", "completion": "1"}}, {"id": "ash-z"}]}))
WANT |= {("cerebras", "ash-8b"): (0.1, 0.0, None, None), ("cerebras", "ash-x"): (None, None, None, None), ("cerebras", "ash-y"): (None, None, None, "unreadable prompt rate"), ("cerebras", "ash-z"): (None, None, None, None)}

head = ["Model", "Price in Tokens", "Price in Neurons"]
page("cloudflare", '<h2 id="llm-model-pricing">LLM</h2>' + table(head, ["@cf/Yew-1", "$0.10 per M input tokens<br>$0.20 per M output tokens<br>$0.02 per M cached input tokens", "n"], ["@cf/yew-2", "$0.1 per M input tokens", "n"]) + '<h2 id="other-model-pricing">Other</h2>' + table(head, ["@cf/img", "$0.1 per image", "n"], ["@cf/yew-3", "$1 per M input tokens<br>$2 per M output tokens", "n"]) + "<h2>End</h2>" + table(head, ["@cf/late", "$1 per M input tokens<br>$2 per M output tokens", "n"]))
WANT |= {("cloudflare", "@cf/yew-1"): (0.1, 0.2, 0.02, None), ("cloudflare", "@cf/yew-2"): (None, None, None, "token cell"), ("cloudflare", "@cf/yew-3"): (1.0, 2.0, None, None)}

flight = lambda name, out: r'{\"_type\":\"model\",\"modelName\":\"' + name + r'\",\"pricings\":[{\"inputLabel\":\"Input\",\"inputPrice\":2.5,\"outputLabel\":\"' + out + r'\",\"outputPrice\":10}]}'
page("cohere", '<script>self.__next_f.push([1,"' + flight("Bay R+", "Output") + flight("Bay Rank", "Searches") + '"])</script><ul><li>Bay Old pricing is $1.50 / 1M tokens for input and $2.00 / 1M tokens for output</li><li>Bay Bad pricing is $1,5 / 1M tokens for input and $2.00 / 1M tokens for output</li></ul>')
WANT |= {("cohere", "bay-r-plus"): (2.5, 10.0, None, None), ("cohere", "bay-rank"): (2.5, 0.0, None, None), ("cohere", "bay-old"): (1.5, 2.0, None, None), ("cohere", "bay-bad"): (None, None, None, "prose rate")}

dash = ["Model ID", "Scope", "Input token range", "Input price", "Output price"]
page("dashscope", "<p>Note: off-peak hours are from 22:00 to 08:00 the next day (UTC+8).</p>" + table(dash, ["box-plus", "International", "Token≤32K", "$0.4", "$1.2 more"], ["box-promo", "International", "Token≤32K", "50% off Original $2", "50% off Original $4"], ["box-day", "International", "No tiered pricing", "Off-peak $0.1 Peak $0.2", "Off-peak $0.3 Peak $0.6"], ["box-odd", "International", "No tiered pricing", "$1 10% off", "$2"], ["box-cn", "Mainland", "Token≤32K", "$9", "$9"], ["box-short", "International", "$5", "0.5 USD"]))
WANT |= {("dashscope", "box-plus"): (0.4, 1.2, None, None), ("dashscope", "box-promo"): (1.0, 2.0, None, None), ("dashscope", "box-day"): (0.1, 0.3, None, None, {"windows": [[0, 1400]], "over_in": [0.2]}), ("dashscope", "box-odd"): (None, None, None, "promotion")}

span = lambda name, *rows: f"<table><thead><tr><th>Model</th><th colspan=3>{name}</th></tr><tr><th></th><th>Input</th><th>Output</th><th>Cache read</th></tr></thead><tbody>" + "".join("<tr>" + "".join(f"<td>{x}</td>" for x in r) + "</tr>" for r in rows) + "</tbody></table>"
page("databricks", span("Standard Pay Per Token (DBU Per 1M Tokens)", ["GLM-5.2, 5.3 ⌖", "10", "20", "-"], ["GTE", "1.5", "-", "-"], ["Strange", "1", "2", "3"]) + span("Priority Pay Per Token (DBU Per 1M Tokens)", ["Kimi K3", "7", "8", "0.5"]))
WANT |= {("databricks", "glm-5.2"): (10.0, 20.0, None, None), ("databricks", "glm-5.3"): (10.0, 20.0, None, None), ("databricks", "gte"): (1.5, 0.0, None, None), ("databricks", "kimi-k3-priority"): (7.0, 8.0, 0.5, None), ("databricks", "Strange"): (None, None, None, "unmapped name")}

deep = table(["Model", "Context", "$ per 1M input tokens", "$ per 1M output tokens", "Actions"], ['<a href="/org/Cedar-7B">Cedar</a>', "128k", "$0.05 / $0.01 cached", "$0.10", ""], ['<a href="/org/cedar-s">C</a>', "-", '<span><span aria-label="List price">$2 / $1</span><span>$1 / $0.5</span></span>', '<span><span aria-label="List price">$4</span><span>$2</span></span>', ""], ["no link", "1k", "$1", "$1", ""], ['<a href="/org/cedar-m">C</a>', "lots", "$1", "$1", ""])
page("deepinfra", deep + deep)
WANT |= {("deepinfra", "cedar-7b"): (0.05, 0.1, 0.01, None, {"context": 131_072}), ("deepinfra", "cedar-s"): (1.0, 2.0, 0.5, None), ("deepinfra", "cedar-m"): (None, None, None, "unreadable context")}

page("deepseek", "<table><tr><td>MODEL</td><td>gum-chat (1)</td><td>gum-mind</td></tr><tr><td>CONTEXT LENGTH</td><td colspan=2>1M</td></tr><tr><td>MAX OUTPUT</td><td>8K</td><td>64K</td></tr><tr><td>1M INPUT TOKENS (CACHE HIT)</td><td>OFF-PEAK</td><td>$0.02</td><td>$0.03</td></tr><tr><td>PEAK</td><td>$0.04</td><td>-</td></tr><tr><td>1M INPUT TOKENS (CACHE MISS)</td><td>OFF-PEAK</td><td>$0.2</td><td>$0.3</td></tr><tr><td>PEAK</td><td>$0.4</td><td>-</td></tr><tr><td>1M OUTPUT TOKENS</td><td>OFF-PEAK</td><td>$1</td><td>$2</td></tr><tr><td>PEAK</td><td>$3</td><td>-</td></tr></table><p>(1) Peak hours are 01:00 - 04:00 and 06:30 - 10:00 UTC, Monday through Friday.</p>")
page("deepseek", table(["API", "Unit", "Price"], ["Search API", "Per 1,000 successful requests", "$5"], ["Fetch", "Per 1,000 successful requests", "$1"]), "guide")
WANT |= {("deepseek", "gum-chat"): (0.2, 1.0, 0.02, None, {"windows": [[100, 400], [630, 1000]], "over_in": [0.4, 0.4], "effective_at": "2026-08-23", "search": 0.005, "context": 1_048_576}), ("deepseek", "gum-mind"): (0.3, 2.0, 0.03, None, {"windows": None})}

line = lambda *x, cls="": f'<span class="gen-ai-pricing-matrix-row {cls}">' + "".join(f"<span>{v}</span>" for v in x) + "</span>"
matrix = lambda *rows: '<span class="gen-ai-pricing-matrix">' + line("Processing Mode", "Prompt length", "Input", "Output", "Cache read", cls="gen-ai-pricing-matrix-header") + "".join(line(*r) for r in rows) + "</span>"
page("digitalocean", table(["Provider", "Model", "Serverless Inference per 1M"], ["P", "<a>Ivy 4.1</a>", matrix(["Standard", "≤ 200K", "$1", "$4", "$0.1"], ["Standard", "> 200K tokens", "$2", "$8", "N/A"], ["Batch", "", "$0.5", "$2", "N/A"])], ["P", "Ivy Embed", matrix(["Standard", "", "$0.02", "N/A", "N/A"])], ["P", "Ivy Image", matrix(["Standard", "", "$1", "$1", "N/A"])], ["P", "Ivy Odd", matrix(["Standard", "", "about 1", "$1", "N/A"])]))
WANT |= {("digitalocean", "ivy-4.1"): (1.0, 4.0, 0.1, None, {"bounds": [200_000], "over_in": [2.0]}), ("digitalocean", "ivy-4.1-batch"): (0.5, 2.0, None, None), ("digitalocean", "ivy-embed"): (0.02, 0.0, None, None), ("digitalocean", "ivy-odd"): (None, None, None, "unreadable rate")}

page("fireworks", table(["Model", "Standard", "Priority"], ["Larch v4 (new)", "$0.9 in $0.09 cached $2 out", "$1"], ["Larch x", "$1 $2", ""]))
WANT |= {("fireworks", "larch-v4-new"): (0.9, 2.0, 0.09, None), ("fireworks", "larch-x"): (None, None, None, "amounts")}

google_table = lambda *rows: "{% table %}\n* \n* Free Tier\n* Paid Tier, per 1M tokens in USD\n---\n" + "\n---\n".join("\n".join(f"* {x}" for x in r) for r in rows) + "\n{% /table %}\n"
page("google", '# Pricing\n\n## Pine 3 {% id="pine-3" %}\n\n[`pine-3-pro`](/docs/models/pine) with a 1M token context window\n\n{% tabs %}\n{% tab title="Standard" %}\n' + google_table(["Input price", "no", "$1.25, prompts <= 200k tokens $2.50, prompts > 200k\n  tokens"], ["Output price (with thoughts)", "no", "$10, prompts <= 200k tokens $15, prompts > 200k"], ["Context caching price", "no", "$0.125 (text) $4.50 / 1,000,000 tokens per hour"]) + '{% /tab %}\n{% tab title="Batch" %}\n' + google_table(["Input price", "no", "$9"], ["Output price", "no", "$9"]) + '{% /tab %}\n{% /tabs %}\n\n## Pine Embed {% id="pine-embed" %}\n\n' + google_table(["Text input price", "no", "$0.15"]) + '\n## Pine Draw {% id="pine-draw" %}\n\n' + google_table(["Output price", "no", "$0.03 per image"]))
WANT |= {("google", "pine-3-pro"): (1.25, 10.0, 0.125, None, {"bounds": [200_000], "over_in": [2.5], "context": 1_000_000}), ("google", "pine-embed"): (0.15, 0.0, None, None)}

page("groq", markdown(["MODEL ID", "SPEED (T/SEC)", "PRICE PER 1M TOKENS", "RATE LIMITS (DEVELOPER PLAN)", "CONTEXT WINDOW (TOKENS)", "MAX COMPLETION TOKENS", "MAX FILE SIZE"], ["[![i](x)Elm 8B](/docs/model/org/elm-8b)org/elm-8b", "500", "$0.05 input$0.08 output", "1", "131,072", "8,192", "-"], ["[Say](/docs/model/say-1)say-1", "9", "$0.11 per hour", "1", "-", "-", "1"], ["[Odd](/docs/model/odd-1)odd-1", "9", "cheap", "1", "-", "-", "1"], ["no link", "9", "$1 input $1 output", "1", "-", "-", "1"]))
WANT |= {("groq", "org/elm-8b"): (0.05, 0.08, None, None, {"context": 131_072}), ("groq", "say-1"): (None, None, None, None), ("groq", "odd-1"): (None, None, None, "unreadable price")}

page("minimax", markdown(["**Model**", "Input \\$ / M tokens", "**Output** \\$ / M tokens", "Prompt caching Read"], ["**Moss-M2**<br />fast", "~~$0.60~~ $0.30", "$1.2", "$0.03"], ["**Moss-M1**", "free", "$1", "-"]))
WANT |= {("minimax", "Moss-M2"): (0.3, 1.2, 0.03, None), ("minimax", "Moss-M1"): (None, None, None, None)}

mist = lambda slug, *cells: [f'<a href="/models/{slug}">x</a>', *cells]
page("mistral", "<section>Prices /M Tokens" + table(["Model", "Input", "Cached input", "Output"], mist("teak-25-08", "$0.3", "-", "$0.9"), mist("teak-free", "Free", "-", "Free"), mist("teak-sale", "<del>$4</del><ins>Sale: $2</ins>", "-", "$6"), mist("teak-odd", "$1,5", "-", "$1")) + "</section><section>Per page" + table(["Model", "Input", "Cached input", "Output"], mist("teak-ocr", "$1", "-", "$1")) + "</section>")
WANT |= {("mistral", "teak-25-08"): (0.3, 0.9, None, None), ("mistral", "teak-free"): (0.0, 0.0, None, None), ("mistral", "teak-sale"): (2.0, 6.0, None, None), ("mistral", "teak-odd"): (None, None, None, "unreadable rate")}

page("moonshot", '```\n<DocTable columns={["Model","Input Price","Output Price"]} rows={[["fenced","$1","$1"]]} />\n```\n<DocTable columns={[{title: "Model"}, {title: "Input Price (Cache Hit)"}, {title: "Input Price (Cache Miss)"}, {title: "Output Price"}, {title: "Context Window"},]} rows={[["Palm-K3", <>{"$0.1"} off</>, "$0.5", "$2", "262,144 tokens"],]} />\n' + table(["Model", "Input Price", "Output Price", "Cache Write Price (TTL 1h)"], ["palm-web", "$1", "$2", "$3"], ["palm-k3", "$9", "$9", "$9"]))
WANT |= {("moonshot", "palm-k3"): (0.5, 2.0, 0.1, None, {"context": 262_144}), ("moonshot", "palm-web"): (1.0, 2.0, None, None, {"write_1h": 3.0})}

dl = lambda **kv: "<dl>" + "".join(f"<dt>{k}</dt><dd>{v}</dd>" for k, v in kv.items()) + "</dl>"
card = lambda slug, body: f'<article data-testid="model-section-mobile-card"><a href="/models/model-detail/{slug}?x=1">m</a>{body}</article>'
page("novita", card("org-sub-birch-7b", dl(Context='<span title="32768">32k</span>', Input='<span title="0.07">$0.07</span><div data-pricing-key="cache-read"><span title="0.07">a</span><span title="0.01">b</span></div>', Output='<span title="0.2">$0.2</span>')) + card("org-birch-x", dl(Input="tiered")) + r'<script>self.__next_f.push([1,"{\"id\":\"org-sub/birch-7b\"}"])</script>')
WANT |= {("novita", "org-sub/birch-7b"): (0.07, 0.2, 0.01, None, {"context": 32_768}), ("novita", "org/birch-x"): (None, None, None, None)}

groups = lambda i, cached: {"headings": tuples(["Model", "Modality", "Input", {"__pricingTooltipHeading": {"label": "Cached input"}}, "Output"]), "groups": tuples([{"model": "rose-image-1", "rows": [["Text", i, cached, None], ["Image", i * 2, None, i * 8]]}])}
page("openai", island({"tier": [0, "standard"], "rows": tuples([["rose-5", 1.25, 0.125, 10], ["rose-5-mini (new)", 0.25, "-", 0.5, 2], ["rose-x", None, None, 1], ["Rose Bad", 1, 1, 1]])}, "TextTokenPricingTables") + island({"tier": [0, "batch"], "rows": tuples([["rose-b", 1, 1, 1]])}, "TextTokenPricingTables") + '<div data-content-switcher-id="multimodal-image-pricing"><div data-content-switcher-pane="true" data-value="standard">' + island(groups(5, 1.25), "GroupedPricingTable") + '</div><div data-content-switcher-pane="true" data-value="batch">' + island(groups(2.5, 0.6), "GroupedPricingTable") + "</div></div>")
WANT |= {("openai", "rose-5"): (1.25, 10.0, 0.125, None), ("openai", "rose-5-mini"): (0.25, 2.0, None, None, {"write": 0.5}), ("openai", "rose-x"): (None, None, None, None), ("openai", "rose-image-1"): (5.0, 40.0, 1.25, None, {"modes": ["batch"], "over_in": [2.5], "image": 10.0})}

page("perplexity", table(["Model", "Input ($/1M)", "Output ($/1M)", "Cache read ($/1M)"], ["perplexity/Bell Pro", "3", "$15", "-"], ["perplexity/kimi-k3", "1", "1", "1"], ["other/x", "1", "1", "1"], ["perplexity/bell-odd", "1,5", "2", "-"]))
page("perplexity", "<p>Fast search costs $1.00, instead of $5.00 per 1,000 invocations.</p>", "fee")
WANT |= {("perplexity", "bell-pro"): (3.0, 15.0, None, None, {"web_search": 0.005}), ("perplexity", "bell-odd"): (None, None, None, "unreadable rate")}

page("publicai", table(["Model ID", "Context Length", "Pricing", "Country of Origin"], ["<a>org/Fern-8B</a> new", "64K", "$0.1 / $0.2 per 1M tokens", "X"], ["org/fern-odd", "64K", "$0.1 per 1M tokens", "X"], ["org/fern-none", "?", "on request", "X"]))
WANT |= {("publicai", "org/fern-8b"): (0.1, 0.2, None, None, {"context": 64_000}), ("publicai", "org/fern-odd"): (None, None, None, "amounts"), ("publicai", "org/fern-none"): (None, None, None, None)}

page("sambanova", table(["Model", "Cached Input Tokens", "Input (per 1M tokens)", "Output (per 1M tokens)"], ["Sorrel 3.1 Big", "N/A", "0.60 USD", "1.20 USD"], ["Sorrel Two", "0.1 USD", "0.50 - 0.60 USD", "1 USD"], ["Sorrel Three", "?", "1 USD", "1 USD"]))
WANT |= {("sambanova", "sorrel-3.1-big"): (0.6, 1.2, None, None), ("sambanova", "sorrel-two"): (None, None, None, "unreadable rate"), ("sambanova", "sorrel-three"): (None, None, None, "cached input")}

page("scaleway", table(["Name <span>SortIcon</span>", "Tasks", "Input tokens", "Output tokens", "Try"], ["thyme-9b", "Chat", "€1.80 / million tokens €0.2 / million tokens cached", "€5.50 / million tokens", '<a href="/try?modelName=thyme-9b">x</a>'], ["thyme-free", "Chat", "Free", "Free", ""], ["thyme-say", "Audio", "€0.003 / Audio minute", "-", ""], ["thyme-odd", "Chat", "€1 a lot", "€1 / million tokens", ""], ["thyme-mix", "Chat", "Free", "Free", '<a href="/try?modelName=other">x</a>'], caption="Generative API") + table(["Name", "Tasks", "Input tokens", "Output tokens", "Try"], ["elsewhere", "Chat", "Free", "Free", ""], caption="Other"))
WANT |= {("scaleway", "thyme-9b"): (1.8, 5.5, 0.2, None), ("scaleway", "thyme-free"): (0.0, 0.0, None, None), ("scaleway", "thyme-say"): (None, None, None, None), ("scaleway", "thyme-odd"): (None, None, None, "input price"), ("scaleway", "thyme-mix"): (None, None, None, "link of another model")}

page("together", table(["Model", "Input", "Output"], ['<a class="pricing_model-link" href="x">Sage 70B</a> promo', "$0.6 $0.1 cached", "$1"], ['<a href="promo">Buy now</a>', "$1", "$1"], ["sage-plain", "$0.2", "$0.3"], ["sage-none", "free trial", ""]))
WANT |= {("together", "sage-70b"): (0.6, 1.0, 0.1, None), ("together", "sage-plain"): (0.2, 0.3, None, None), ("together", "sage-none"): (None, None, None, None)}

page("volcengine", "<div>doubao-seed-1.6 复制 上下文窗口 256k 最大输出 32k 输入价格 0.72 - 2.4 元/百万 输出价格 7.2元/百万 复制 rest 输入价格 99元/百万</div><div>doubao-seed-lite 复制 输入价格 输出价格 1元/百万</div><div>doubao-seedream-4 输入价格 1元/百万 输出价格 1元/百万</div>")
WANT |= {("volcengine", "doubao-seed-1.6"): (0.1, 1.0, None, None, {"context": 262_144}), ("volcengine", "doubao-seed-lite"): (None, None, None, None)}

c4d = lambda tag, *x: f"<c4d-pricing-table-{tag}row>" + "".join(f"<c4d-pricing-table-{'header-' if tag else ''}cell>{v}</c4d-pricing-table-{'header-' if tag else ''}cell>" for v in x) + f"</c4d-pricing-table-{tag}row>"
page("watsonx", "<c4d-pricing-table><c4d-pricing-table-head>" + c4d("header-", "Model Name", "Model Provider", "Pay as you go *") + "</c4d-pricing-table-head><c4d-pricing-table-body>" + c4d("", "Rye 3 New", "I", "USD 0.1 per 1M tokens") + c4d("", "rye-big", "I", "USD 1 in / USD 3 out") + c4d("", "rye-odd", "I", "USD 1 – USD 3") + c4d("", "rye-ask", "I", "contact") + "</c4d-pricing-table-body></c4d-pricing-table>")
WANT |= {("watsonx", "rye-3"): (0.1, 0.1, None, None), ("watsonx", "rye-big"): (1.0, 3.0, None, None), ("watsonx", "rye-odd"): (None, None, None, "unreadable rate"), ("watsonx", "rye-ask"): (None, None, None, None)}

xmodel = lambda name, **kv: {"name": name} | kv
page("xai", "<script>globalThis.__XAI_PUBLIC_MODELS__ = " + json.dumps({"clusterConfigs": [{"languageModels": [xmodel("tarn-4", promptTextTokenPrice="30000", completionTextTokenPrice=150000, cachedPromptTokenPrice="7500", maxPromptLength=256000, longContextThreshold=128000, promptTextTokenPriceLongContext=60000, completionTokenPriceLongContext=300000), xmodel("tarn-odd", promptTextTokenPrice=1, completionTextTokenPrice=1, promptTextTokenPriceLongContext=5), xmodel("tarn-none")]}, {"languageModels": [xmodel("tarn-4", promptTextTokenPrice=1, completionTextTokenPrice=1)]}]}) + ";</script>")
WANT |= {("xai", "tarn-4"): (3.0, 15.0, 0.75, None, {"bounds": [128_000], "over_in": [6.0], "context": 256_000}), ("xai", "tarn-odd"): (None, None, None, "long-context threshold"), ("xai", "tarn-none"): (None, None, None, None)}

page("zai", table(["Model", "Input", "Cached Input", "Output"], ["GLM-9", "<s>$0.6</s> $0.3", "$0.05", "$1.1"], ["GLM-9-Air", "Free", "Free", "Free"], ["other", "$1", "$1", "$1"]))
page("zai", 'Peak hours: Monday to Friday, 06:00–14:30 Singapore Standard Time (UTC+8)\n- **GLM-9**: API calls consume quota at a rate of "0.5× during off-peak hours and 2× during peak hours"', "notice")
WANT |= {("zai", "glm-9"): (0.3, 1.1, 0.05, None, {"windows": [None, [2200, 2400], [0, 630]], "multipliers": [0.5, 2.0, 2.0], "days0": ["monday", "tuesday", "wednesday", "thursday", "sunday"]}), ("zai", "glm-9-air"): (0.0, 0.0, 0.0, None)}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(s, u, b) for s, made in PAGES.items() for u, b in made], "source string, url string, body string").repartition(4).cache()


@pytest.mark.parametrize("source", sorted(SOURCES))
def test_source(pages, source):
    got = {r.model_id: r for r in registry.all_priced(pages, (source,)).collect()}
    want = {i: w for (s, i), w in WANT.items() if s == source}
    assert want, "no page"
    assert sorted(got) == sorted(want)
    for i, w in want.items():
        r, more = got[i], w[4] if len(w) > 4 else {}
        rates = (r.rates.input, r.rates.output, r.rates.cache_read) if r.rates else (None, None, None)
        assert (*rates, r.fault) == w[:4], i
        own = {
            "effective_at": r.effective_at, "context": r.limits and r.limits.context, "write": r.rates and r.rates.cache_write, "write_1h": r.rates and r.rates.cache_write_1h, "image": r.rates and r.rates.image,
            "search": r.fees and r.fees.search, "web_search": r.fees and r.fees.web_search, "modes": r.overrides and [o.when.mode for o in r.overrides], "bounds": r.overrides and [o.when.min_tokens for o in r.overrides],
            "windows": r.overrides and [o.when.window for o in r.overrides], "over_in": r.overrides and [o.rates and o.rates.input for o in r.overrides], "multipliers": r.overrides and [o.quota_multiplier for o in r.overrides], "days0": r.overrides and len(r.overrides) > 1 and r.overrides[1].when.days,
        }
        assert {k: own[k] for k in more} == more, i


def test_no_pages_and_odd_pages(spark):
    none = spark.createDataFrame([], "source string, url string, body string")
    assert registry.all_priced(none, ("openai", "google", "amazon")).collect() == []
    odd = spark.createDataFrame([(s, "u", b) for s in SOURCES for b in (None, "", "<table><tr><td>", "{", "]]>")], "source string, url string, body string").coalesce(1)
    assert registry.all_priced(odd).collect() == []


def test_spellings(spark):
    ids = spark.createDataFrame([("xai", "tarn-4-0709-reasoning"), ("mistral", "codestone-25-08"), ("mistral", "stonal-3-8b-25-12"), ("groq", "a-1234")], "source string, model_id string")
    got = {}
    for r in registry.spellings(ids).orderBy("ord").collect():
        got.setdefault(r.model_id, []).append(r.spelling)
    assert got == {"tarn-4-0709-reasoning": ["tarn-4-0709-reasoning", "tarn-4"], "codestone-25-08": ["codestone-25-08", "codestone-2508"], "stonal-3-8b-25-12": ["stonal-3-8b-25-12", "stonal-3-8b-2512", "stonal-8b-2512"], "a-1234": ["a-1234"]}


def test_price_list_urls(spark):
    from ratevane.sources.providers import price_list_urls

    made = lambda at: json.dumps({"regions": {"us-east-1": {"currentVersionUrl": at}}})
    rows = [("https://h/a/index.json", made("/x/y.json")), ("https://h/a/b.json?q", made("v/y.json")), ("https://h/c", made("https://k/z")), ("https://h/d", "{}")]
    got = {r.url: r.file for r in price_list_urls(spark.createDataFrame(rows, "url string, body string")).collect()}
    assert got == {"https://h/a/index.json": "https://h/x/y.json", "https://h/a/b.json?q": "https://h/a/v/y.json", "https://h/c": "https://k/z", "https://h/d": None}
