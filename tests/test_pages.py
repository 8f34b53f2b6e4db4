"""Pages read once: what breaks a parser, script literals, runs side by side, and what a run knows of its detection."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ratevane.functions import literals, markup, tables
from ratevane.operators import absence, runs
from ratevane.sources import registry
from tests.test_providers import PAGES, table

BROKEN = {"digits": "<p>&#" + "9" * 5000 + ";</p>", "declaration": "<![x[<p>", "deep": "<div>" * 3000, "span": '<table><tr><td colspan="²">a</td><td colspan="9999999999999">b</td></tr></table>'}


def test_pages_that_break_a_parser(spark):
    good = table(["model", "input", "output"], ["oak", "$1", "$2"])
    rows = [("together", name, body) for name, body in BROKEN.items()] + [("together", "good", good), ("together", "none", None), ("xai", "blank", "  ")]
    pages = spark.createDataFrame(rows, "source string, url string, body string").coalesce(1)
    found = registry.read(pages)
    assert {(r.source, r.url): r.fault for r in found.faults.collect()} == {("together", "declaration"): "markup: AssertionError", ("together", "none"): "empty page", ("xai", "blank"): "empty page"}
    assert [(r.model_id, r.rates.input) for r in registry.all_priced(found).collect()] == [("oak", 1.0)]
    got = {r.url: r for r in tables.tables_of(pages, "url", "body").collect()}
    assert got["declaration"].cells is None and got["span"].cells == ["a", *["b"]] and "digits" not in got and got["good"] is not None


def test_bodies_go_through_python_once(spark):
    rows = [(s, u, b) for s, made in PAGES.items() for u, b in made]
    pages = spark.createDataFrame(rows, "source string, url string, body string")
    calls = spark.sparkContext.accumulator(0)
    whole = markup.page_rows

    def counted(index, body):
        calls.add(1)
        return whole(index, body)

    found = registry.read(pages)
    plan = registry.all_priced(found)._jdf.queryExecution().optimizedPlan().toString()
    python = [x for x in plan.split("\n") if "MapInArrow" in x]
    assert python and not any("body" in x for x in python)  # amounts only
    before = markup.page_rows
    try:
        markup.page_rows = counted
        again = registry.read(pages.coalesce(1))
        registry.all_priced(again, ("mistral", "cloudflare", "moonshot")).collect()
    finally:
        markup.page_rows = before
    assert calls.value in (0, len(rows))  # workers may have the function by its module


def test_runs_do_not_mix(spark):
    head = ["Model", "Input ($/1M)", "Output ($/1M)", "Cache read ($/1M)"]
    fee = lambda n: f"<p>Fast search costs $1.00, instead of ${n}.00 per 1,000 invocations.</p>"
    rows = [(run, "perplexity", u, b) for run, i, n in (("r1", "3", 5), ("r2", "4", 8)) for u, b in (("p", table(head, ["perplexity/bell", i, "9", "-"])), ("fee", fee(n)))]
    got = registry.all_priced(spark.createDataFrame(rows, "run string, source string, url string, body string"), ("perplexity",))
    assert sorted((r.run, r.rates.input, r.fees.web_search) for r in got.collect()) == [("r1", 3.0, 0.005), ("r2", 4.0, 0.008)]


def test_literals():
    read = literals.parsed
    assert read("[1, -2.5e1, 'a\\'b', \"c\\u0041\\x42\\n\", `d`, true, null, undefined, {a: 1, 'b c': [,] } ]".replace("[,]", "[]")) == [1, -25, "a'b", "cAB\n", "d", True, None, None, {"a": 1, "b c": []}]
    assert read(" [ 'x]', {k: '}',}, /* note */ [[1,],], // end\n ] ") == ["x]", {"k": "}"}, [[1]]]
    assert literals.text_of(read('<>{"$0.1"} off {/* c */}<b class="x" wide n={[1]}>now</b></>')) == "$0.1 off now"
    assert literals.text_of(read('_jsxs(a.b, { children: ["one ", _jsx("i", {children: "two"}), jsx(C, {})] })')) == "one two"
    assert literals.text_of(read('React.createElement("p", null, "a", createElement(B, {x: 1}, "b"))')) == "ab"
    assert literals.plain_json(read("<A b={1}>c</A>")) == {"component": "A", "props": {"b": 1, "children": ["c"]}}
    for text, at in (("[1, 2", 5), ("{a 1}", 3), ("[foo]", 1), ("'open", 0), ("`${x}`", 1), ("1 2", 2), ("", 0), ("<a>x</b>", 4), ("12abc", 0), ("'\\u{110000}'", 1), ("/* x", 0)):
        with pytest.raises(literals.Fault) as found:
            read(text)
        assert found.value.at == at, (text, str(found.value))
    with pytest.raises(literals.Fault):
        read("[" * 5000)


def test_literals_of_random_values():
    rng = random.Random(5)

    def value(depth):
        kind = rng.randint(0, 5 if depth < 4 else 3)
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randint(0, 4))]
        if kind == 5:
            return {"".join(rng.choice("ab[]{}',\"\\ é") for _ in range(rng.randint(1, 5))): value(depth + 1) for _ in range(rng.randint(0, 3))}
        return (rng.randint(-99, 99), "".join(rng.choice("xy[]{}<>',\"\\\n/* é") for _ in range(rng.randint(0, 8))), None, True)[kind]

    for _ in range(500):
        x = value(0)
        assert literals.parsed(json.dumps(x, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)) == x


def test_component_tables_and_fences():
    page = "text <DocTable columns={[{title: 'A', w: [1]}, 'B']} rows={[[<b>x]</b>, '1'], ['y', _jsx(I, {children: '2'})],]} /> <DocTable columns={[} rows={[]} /> DocTableau _jsx(DocTable, {columns: ['C'], rows: [['z']]})"
    one, bad, two = literals.component_tables(page, "DocTable")
    assert one == (["A", "B"], [["x]", "1"], ["y", "2"]]) and two == (["C"], [["z"]]) and isinstance(bad, literals.Fault)
    assert literals.unfenced("a\n```js\nb\n~~~\n```\nc\n~~~~\nd\n~~~\n~~~~\ne\n``` open\nf\n") == "a\nc\ne\n``` open\nf\n"
    body = 'self.__next_f.push([1,"a\\"b"]) self.__next_f.push([0]) self.__next_f.push(oops) self.__next_f.push([1,"c"]) <template data-mint="manifest">{"page":{"mdx":{"mdxSource":{"compiledSource":"d"}}}}</template><template data-mint="manifest">no</template>'
    assert literals.stream_of(body) == 'a"bcd'


def test_literal_columns(spark):
    df = spark.createDataFrame([(1, "[1,{a:'b'},]"), (2, "[1"), (3, None)], "i int, t string")
    assert [(r.t_json, r.t_fault) for r in literals.scan_literals(df, "t").orderBy("i").collect()] == [('[1, {"a": "b"}]', None), (None, "open list at 2"), (None, None)]


def of(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_whether_a_run_saw_a_source_whole(spark):
    good, changed = table(["Model", "Standard", "Priority"], ["Larch 1", "$1 $2 $3", ""]), table(["Name", "Standard", "Priority"], ["Larch 1", "$1 $2 $3", ""])
    odd = table(["Model", "Standard", "Priority"], ["Larch 1", "$1 $2 $3", ""], ["Larch 2", "$1-2", ""])
    rows = [("1", "fireworks", "u", good), ("2", "fireworks", "u", changed), ("3", "fireworks", "u", odd), ("4", "fireworks", "u", good), ("4", "fireworks", "v", "<![x[<p>"), ("5", "fireworks", "u", table(["Model", "Standard", "Priority"], ["Larch 3", "$1 $2 $3", ""]))]
    pages = of(spark, rows, "run string, source string, url string, body string")
    found = registry.read(pages, ("fireworks",))
    priced = registry.all_priced(found, ("fireworks",))
    valid = runs.validity(found.fetched, found.faults, priced)
    assert {r.run: (r.settled, r.reason) for r in valid.collect()} == {"1": (True, None), "2": (False, "no row"), "3": (False, "skipped larch-2: unreadable rate"), "4": (False, "page v: markup: AssertionError"), "5": (True, None)}
    stored = of(spark, [("fireworks", "larch-1"), ("fireworks", "larch-9")], "source string, model_id string")
    held = of(spark, [("fireworks", "larch-9")], "source string, model_id string")
    seen = runs.sightings(stored, priced, registry.spellings(priced.select("source", "model_id").distinct()), valid, held)
    got = {(r.model_id, r.run): (r.present, r.settled, r.held) for r in seen.collect()}
    assert got["larch-1", "1"] == (True, True, False) and got["larch-1", "2"] == (False, False, False) and got["larch-1", "5"] == (False, True, False) and got["larch-9", "5"] == (False, True, True) and len(got) == 10
    assert not absence.two_strikes(seen).where("removes").count()  # one whole run alone misses larch-1


def test_spellings_and_priced_sets(spark):
    schema = "source string, model_id string, run string, rates struct<input:double>, fault string"
    priced = of(spark, [("xai", "tarn-4-0709", None, (1.0,), None), ("mistral", "teak-25-08", None, None, None), ("groq", "elm", None, None, None)], schema)
    stored = of(spark, [("xai", "tarn-4"), ("mistral", "teak-2508"), ("groq", "elm")], "source string, model_id string")
    valid = of(spark, [("xai", "", True), ("mistral", "", True), ("groq", "", True)], "source string, run string, settled boolean")
    seen = runs.sightings(stored, priced, registry.spellings(priced.select("source", "model_id")), valid, stored.where("false"))
    assert {r.source: r.present for r in seen.collect()} == {"xai": True, "mistral": False, "groq": True}  # mistral's absence goes by prices


def test_state_from_run_to_run_is_the_batch_rule(spark):
    rng = random.Random(8)
    rows = [("s" if m < 4 else "t", f"m{m}", f"r{r}", rng.random() < 0.4, rng.random() < 0.8, rng.random() < 0.2) for m in range(7) for r in range(9) if m < 4 or r % 2]
    schema = "source string, model_id string, run string, present boolean, settled boolean, held boolean"
    batch = {(r.model_id, r.run): (r.absent_runs, r.since, r.removes) for r in absence.two_strikes(of(spark, rows, schema)).collect()}
    kinds = "source string, model_id string, absent_runs int, since string"
    state, none = of(spark, [("u", "other", 1, "r")], kinds), of(spark, [], "source string, model_id string")
    for r in range(9):
        seen = [x for x in rows if x[2] == f"r{r}"]
        after, due = runs.advance(state, of(spark, seen, schema), none)
        held_now, kept = {x.model_id for x in due.collect()}, {x.model_id: (x.absent_runs, x.since) for x in after.collect()}
        assert kept["other"] == (1, "r")
        for _, m, run, *_ in seen:
            n, since, removes = batch[m, run]
            assert kept.get(m, (0, None)) == (n, since if n else None), (m, run)
            assert (m in held_now) >= removes
        state = of(spark, [tuple(x) for x in after.select("source", "model_id", "absent_runs", "since").collect()], kinds)
    gone, due = runs.advance(of(spark, [("s", "m0", 2, "r1")], kinds), of(spark, [("s", "m0", "r9", False, True, False)], schema), of(spark, [("s", "m0")], "source string, model_id string"))
    assert gone.collect() == [] == due.collect()


def test_whole_ids_in_texts(spark):
    from ratevane.functions import mentions

    texts = {"_m-2_ and **M-3**.": {"m-2", "m-3"}, "m-2_fast m-2.5 xm-2 m-2-x": {"m-2.5"}, "`m-2`, m-2: (m-3)": {"m-2", "m-3"}, "[m-2](m-3) <a m-3>m-2.5</a>": {"m-2", "m-2.5"}, "": set(), None: set(), "m-2": {"m-2"}}
    ids = spark.createDataFrame([("m-2",), ("m-2",), ("m-2.5",), ("m-3",), ("",), (None,)], "model_id string")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", mentions.visible(F.col("t")).alias("t"))
    for block in (1 << 20, 4):
        got = {}
        for r in mentions.mentions(df, "i", "t", ids, block).collect():
            got.setdefault(r.i, []).append(r.model_id)
        assert {i: sorted(x) for i, x in got.items()} == {i: sorted(w) for i, w in enumerate(texts.values()) if w}
    assert mentions.mentions(df, "i", "t", ids.where("false")).collect() == []


def test_a_document_of_fragments(spark, tmp_path):
    from ratevane.sources.documents import text_of, write_document

    rows = [(f"s{i % 3}", f"m{i:03d}", i) for i in range(200)] + [("quote\"d", "x\\y", 1)]
    df = spark.createDataFrame(rows, "source string, model_id string, n int").repartition(5)
    members = df.select("source", "model_id", F.concat(text_of(F.col("model_id")), F.lit(":"), F.col("n").cast("string")).alias("member"))
    files = write_document(members, f"{tmp_path}/doc", ["source", "model_id"], group="source").collect()
    want = {}
    for s, m, n in rows:
        want.setdefault(s, {})[m] = n
    raw = b"".join((tmp_path / "doc" / r.file).read_bytes() for r in sorted(files, key=lambda r: r.start))
    assert json.loads(raw) == want and len(files) > 1 and [r.start for r in sorted(files, key=lambda r: r.file)] == sorted(r.start for r in files)
    assert all(raw[r.start : r.start + r.bytes] == (tmp_path / "doc" / r.file).read_bytes() for r in files)
    write_document(members.where("false"), f"{tmp_path}/none", ["source", "model_id"], group="source")
    assert json.loads(b"".join(p.read_bytes() for p in (tmp_path / "none").glob("part*"))) == {}
