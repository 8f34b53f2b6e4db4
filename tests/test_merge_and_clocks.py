import json
import random

import pytest
from pyspark.sql import functions as F

from ratevane.functions import clock
from ratevane.operators import catalog, log, merge, ops, validate
from ratevane.schema import ROW
from ratevane.sources import listing


def test_clocks(spark):
    lit = F.lit
    one = spark.range(1).select(
        clock.utc(lit(60), lit(300), lit(480)).alias("a"),
        clock.pieces(lit(1380), lit(60)).alias("b"),
        clock.complement(lit(600), lit(0)).alias("c"),
        clock.day_range(lit("friday"), lit("monday")).alias("d"),
        clock.shifted(F.array(lit("monday"), lit("friday")), lit(-1)).alias("e"),
        clock.parsed(lit("24:00")).alias("f"),
        clock.parsed(lit("25:10")).alias("g"),
        clock.week_row(lit("2026-09-10").cast("date")).cast("string").alias("h"),
    ).first()
    assert [tuple(x) for x in one.a] == [(1020, 1260, -1)]
    assert [tuple(x) for x in one.b] == [(1380, 1440, 0), (0, 60, 1)]
    assert [tuple(x) for x in one.c] == [(0, 600)]
    assert one.d == ["monday", "friday", "saturday", "sunday"] and one.e == ["thursday", "sunday"]
    assert one.f == 2400 and one.g is None and one.h == "2026-09-07"


def test_listing(spark):
    body = """{"data":[{"id":"a/x","name":"V: X","context_length":10,"pricing":{"prompt":"0.000001","completion":"-1","odd":"7","overrides":"[{\\"utc_days\\":[\\"friday\\",\\"monday\\",\\"friday\\"],\\"utc_start\\":2200,\\"utc_end\\":200,\\"prompt\\":\\"0.000002\\"},{\\"min_prompt_tokens\\":100,\\"prompt\\":\\"0\\",\\"completion\\":\\"0.000003\\"}]"}},
    {"id":"a/x:free","canonical_slug":"a/x","pricing":{}},{"id":"b","alias_target":"a/x","pricing":{}},{"name":"no id"},{"id":"img","architecture":{"output_modalities":["image"]},"pricing":{"image":"0","web_search":"0.01"}}]}"""
    got = {r.model_id: r for r in listing.listing_rows(spark.createDataFrame([(body,), ("nope",)], "body string"), "api", "2026-01-01").collect()}
    assert sorted(got) == ["a/x", "img"]
    x = got["a/x"]
    assert (x.rates.input, x.rates.output, x.limits.context, x.provenance.name, x.modality) == (1.0, None, 10, "X", None) and '"odd"' in x.unmapped
    assert [(o.when.days, o.when.window, o.when.timezone, o.when.min_tokens, o.rates.input, o.rates.output) for o in x.overrides] == [(["monday", "friday"], [2200, 2400], "UTC", None, 2.0, None), (["monday", "friday"], [0, 200], "UTC", None, 2.0, None), (None, None, None, 100, None, 3.0)]
    assert (got["img"].modality, got["img"].rates.image, got["img"].fees.web_search, got["img"].overrides) == ("image", 0.0, 0.01, None)


def test_contract(spark):
    good = '{"schema":4,"source":"s","model_id":"m","observed_at":"2026-01-01","rates":{"input":1.0}}'
    cases = {
        None: good,
        "unknown": good[:-1] + ',"odd":1}',
        "missing": good.replace('"model_id":"m",', ""),
        "schema": good.replace("4", "3", 1),
        "rates": good.replace("1.0", "-1.0"),
        "currency": good[:-1] + ',"currency":"eur"}',
        "fx_rate": good[:-1] + ',"currency":"EUR"}',
        "fx_pair": good[:-1] + ',"provenance":{"fx_rate":1.1}}',
        "overrides": good[:-1] + ',"overrides":[{"when":{"timezone":"Asia/Shanghai","window":[100,200]},"rates":{"input":2.0}}]}',
        "removed": good[:-1] + ',"removed":false}',
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "want string, line string").withColumn("r", F.from_json("line", ROW)).select("want", "line", "r.*")
    for r in df.select("want", validate.fault(F.col("line")).alias("got")).collect():
        assert r.want == r.got


def test_merges(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    claims = "canonical string, source string, model_id string"
    base = df([("a", "s", "1"), ("b", "s", "2")], claims)
    head = df([("a", "s", "1"), ("b", "s", "2"), ("h", "s", "9")], claims)
    branch = df([("a", "s", "1"), ("b", "s", "2"), ("b", "s", "3"), ("n", "s", "9"), ("k", "s", "5")], claims)
    assert sorted(map(tuple, merge.catalog_union(base, head, branch).collect())) == [("k", "s", "5")]  # the head claims an id of b and of n
    files = df([("s", "{}", "head", 5), ("s", "{1}", "b", 5), ("t", "{}", "head", 1), ("t", "{2}", "b", 2)], "source string, state string, ref string, authored int")
    assert sorted((r.source, r.ref) for r in merge.absence_merge(files).collect()) == [("s", "head"), ("t", "b")]
    assert {r.number: r.settled for r in merge.settled(df([(1, True), (1, False), (2, True), (3, None)], "number int, channel_settled boolean")).collect()} == {1: False, 2: True, 3: False}
    lines = df([("ERROR:a.b:detector for x failed: e",), ("job\tstep\t2026 WARNING:a:detect skip for y: z",), ("  File",), ("INFO:a:fine",)], "line string")
    assert sorted((r.provider, r["class"]) for r in ops.issues(lines).collect()) == [("x", "hard"), ("y", "soft")]
    ids = df([("@cf/Meta/x", None, None), ("OpenAI/y", None, None), ("gpt-4", "v", "reseller"), ("gpt-llama", "Vend", "first_party"), ("a/b/c", "v", "first_party")], "id string, v string, k string")
    got = [r[0] for r in ids.select(catalog.vendor_of(F.col("id"), F.col("v"), F.col("k"), {"gpt": "openai", "llama": "meta"})).collect()]
    assert got == ["meta", "openai", "openai", "vend", None]


def in_sequence(head, branches):
    """What a loop over branches lands: (canonical, claims) of changed entries, unless one of their claims is taken."""
    merged = {c: json.dumps(e, sort_keys=True) for c, e in head}
    claims = lambda e: {(s, i) for s, ids in e["sources"].items() for i in ([ids] if isinstance(ids, str) else ids)}
    taken = {x for _, e in head for x in claims(e)}
    refused = []
    for branch, _, canonical, entry, base in sorted(branches, key=lambda b: b[:2]):
        if base == entry:
            continue
        if claims(entry) & taken:
            refused.append((branch, canonical))
            continue
        merged[canonical] = json.dumps(entry, sort_keys=True)
        taken |= claims(entry)
    return sorted(merged.items()), sorted(refused)


@pytest.mark.parametrize("task_claims", [0, 7, 100_000])
def test_catalogs_of_branches_land_as_in_a_loop(spark, task_claims):
    rng = random.Random(task_claims + 1)
    entry = lambda *ids: {"vendor": None, "curated": bool(rng.randint(0, 1)), "sources": {s: [i for t, i in ids if t == s] for s in {t for t, _ in ids}}}
    some = lambda n: entry(*{(rng.choice("st"), str(rng.randint(0, 60))) for _ in range(n)})
    head = [("h0", entry(("s", "1"), ("t", "2"))), ("h1", {"sources": {"s": "3"}})]
    branches = [(f"b{b}", i, f"c{rng.randint(0, 9)}", some(rng.randint(1, 3)), None) for b in range(6) for i in range(8)]
    branches += [("b7", k, f"chain{k}", entry(("u", str(k)), ("u", str(k + 1))), None) for k in range(9)]  # each conflicts with the next
    branches += [("b0", 90, "h0", head[0][1], head[0][1]), ("b1", 91, "h0", entry(("z", "1")), head[0][1]), ("b8", 0, "h1", {"sources": {"s": "3"}, "vendor": "v"}, head[1][1]), ("b9", 0, "none", {"sources": {}}, None)]
    text = lambda e: None if e is None else json.dumps(e)
    made = spark.createDataFrame([(b, i, c, text(e), text(o)) for b, i, c, e, o in branches], "branch string, ord int, canonical string, entry string, base_entry string").repartition(3)
    catalog_, refused = merge.catalog_merge(spark.createDataFrame([(c, text(e)) for c, e in head], "canonical string, entry string"), made, task_claims)
    want, want_refused = in_sequence(head, branches)
    assert sorted((r.canonical, json.dumps(json.loads(r.entry), sort_keys=True)) for r in catalog_.collect()) == want
    assert sorted(map(tuple, refused.collect())) == want_refused
    nothing = made.where("false")
    assert merge.catalog_merge(nothing.select("canonical", "entry"), nothing, task_claims)[0].collect() == []


def test_lines_are_sorted_and_recorded(spark):
    line = lambda m, d: '{"model_id": "%s", "observed_at": "%s", "x": 1}' % (m, d)
    lines = spark.createDataFrame([("s", 0, line("b", "1")), ("s", 1, line("a", "2")), ("s", 2, line("a", "1")), ("t", 0, line("z", "1"))], "path string, pos int, line string")
    assert [r.line for r in merge.sorted_lines(lines).where("path = 's'").orderBy("pos").collect()] == [line("a", "1"), line("a", "2"), line("b", "1")]
    schema = "source string, model_id string, observed_at string, line string"
    stored = spark.createDataFrame([("s", "m", "1", "x"), ("s", "m", "2", "y")], schema)
    rows = spark.createDataFrame([("s", "m", "1", "x"), ("s", "m", "2", "x"), ("s", "n", "1", "x")], schema)
    assert [r.observed_at for r in log.recorded(rows, stored).collect()] == ["1"]
