"""Files of dimensions and state, the published tree and the jobs, read back from folders."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratevane import jobs
from ratevane.functions import page, text
from ratevane.operators import review
from ratevane.plans import publish
from ratevane.sources import dimensions, listing, observations


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(path)


ENTRY = {"vendor": "v", "curated": True, "sources": {"s": ["a", "b"], "t": "a"}}


def test_catalog(spark, tmp_path):
    good = put(tmp_path / "m.json", {"version": 4, "models": {"one": ENTRY | {"name": "One"}, "two": {"vendor": None, "curated": False, "sources": {"s": "c"}}}})
    rows = sorted(tuple(r) for r in dimensions.catalog(spark, good).collect())
    assert rows == sorted([("one", "One", "v", True, "s", "a", None), ("one", "One", "v", True, "s", "b", None), ("one", "One", "v", True, "t", "a", None), ("two", None, None, False, "s", "c", None)], key=str) or {r[:6] for r in rows} == {("one", "One", "v", True, "s", "a"), ("one", "One", "v", True, "s", "b"), ("one", "One", "v", True, "t", "a"), ("two", None, None, False, "s", "c")}
    dimensions.write_catalog(dimensions.catalog(spark, good), f"{tmp_path}/out")
    assert {tuple(r) for r in dimensions.catalog(spark, f"{tmp_path}/out").collect()} == set(rows)
    bad = {"key": ENTRY | {"x": 1}, "name": ENTRY | {"name": ""}, "vendor": ENTRY | {"vendor": 3}, "missing": {"curated": True, "sources": {"s": "a"}}, "curated": ENTRY | {"curated": "yes"}, "sources": ENTRY | {"sources": {}}, "ids": ENTRY | {"sources": {"s": []}}, "empty": ENTRY | {"sources": {"s": [""]}}, "number": ENTRY | {"sources": {"s": 3}}}
    at = put(tmp_path / "bad.json", {"version": 4, "models": bad})
    assert {r.canonical: r.fault for r in dimensions.catalog(spark, at, strict=False).collect()} == {"key": "unknown key", "name": "name", "vendor": "vendor", "missing": "missing vendor", "curated": "curated", "sources": "sources", "ids": "ids", "empty": "empty id", "number": "ids"}
    with pytest.raises(PySparkException):
        dimensions.catalog(spark, at).collect()
    with pytest.raises(PySparkException):
        dimensions.catalog(spark, put(tmp_path / "v.json", {"version": 3, "models": {}})).collect()
    assert dimensions.catalog(spark, f"{tmp_path}/none.json").collect() == []
    with pytest.raises(FileNotFoundError):
        dimensions.catalog(spark, f"{tmp_path}/none.json", allow_missing=False)


def test_aliases(spark, tmp_path):
    record = lambda **kv: {"from": None, "to": None, "canonical": "one", "citation": "https://x"} | kv
    at = put(tmp_path / "a.json", {"version": 4, "aliases": {"ok": [record(to="2026-01-01"), record(**{"from": "2026-01-01"})], "day": [record(to="2026-02-30")], "range": [record(to="2026-01-01", **{"from": "2026-01-01"})], "model": [record(canonical="gone")], "cite": [record(citation="x")], "key": [record(x=1)], "bound": [{"canonical": "one", "citation": "https://x"}]}})
    models = spark.createDataFrame([("one",)], "canonical string")
    got = {}
    for r in dimensions.aliases(spark, at, models, strict=False).collect():
        got.setdefault(r.alias, set()).add(r.fault)
    assert got == {"ok": {None}, "day": {"bound isn't a day"}, "range": {"empty range"}, "model": {"canonical isn't in the catalog"}, "cite": {"citation"}, "key": {"unknown key"}, "bound": {"missing bound"}}
    with pytest.raises(PySparkException):
        dimensions.aliases(spark, at, models).collect()
    assert dimensions.aliases(spark, f"{tmp_path}/none").collect() == []


SECTION = '[{}]\nprovider = "P"\ndetector = "d"\ndetector_url = "u"\nscraper = "s"\nscraper_url = "u"\nkind = "{}"\n{}\n'


def test_providers(spark, tmp_path):
    at = put(tmp_path / "p.toml", SECTION.format("one", "first_party", 'vendor = "v"\nannounce_urls = ["https://a"]') + SECTION.format("two", "reseller", "currency_rate = 0.07"))
    own = dimensions.providers(spark, at)
    assert [(r.source, r.vendor, r.kind, r.currency_rate, r.announce_urls) for r in own.orderBy("source").collect()] == [("one", "v", "first_party", None, ["https://a"]), ("two", None, "reseller", 0.07, [])]
    assert sorted((r.source, r.name, r.vendor, r.kind) for r in dimensions.published_providers(own).collect())[1] == ("openrouter", "OpenRouter", None, "reseller")
    for name, kind, more in (("one", "first_party", ""), ("one", "reseller", 'vendor = "v"'), ("one", "other", ""), ("openrouter", "reseller", ""), ("Bad", "reseller", ""), ("one", "reseller", "x = 1"), ("one", "reseller", "currency_rate = -1"), ("one", "reseller", 'announce_urls = [""]')):
        with pytest.raises(ValueError):
            dimensions.providers(spark, put(tmp_path / "bad.toml", SECTION.format(name, kind, more)))


def test_absence_and_rules(spark, tmp_path):
    put(tmp_path / "absence/s.json", {"a": {"absent_runs": 1, "since": "2026-01-01"}})
    put(tmp_path / "absence/t.json", {"b": {"absent_runs": 3, "since": "x"}, "c": {"absent_runs": 2, "since": ""}})
    got = {(r.source, r.model_id): r.fault for r in dimensions.absence(spark, f"{tmp_path}/absence", strict=False).collect()}
    assert got == {("s", "a"): None, ("t", "b"): "absent_runs isn't 1 or 2", ("t", "c"): "since"}
    state = spark.createDataFrame([("s", "a", 1, "d"), ("u", "z", 2, "d")], "source string, model_id string, absent_runs int, since string")
    dimensions.write_absence(state, f"{tmp_path}/state", ["s", "t"])
    dimensions.write_absence(state.where("false"), f"{tmp_path}/state", ["s"])
    assert {(r.source, r.value) for r in spark.read.text(f"{tmp_path}/state").collect()} == {("s", "{}"), ("t", "{}")}
    rule = {"id": "r", "provider": "p", "effective": "2026-01-01", "timezone": "UTC", "statement": "s", "citation": ["x"]}
    at = put(tmp_path / "r.json", {"rules": [rule, rule, rule | {"id": "z", "timezone": "Mars"}, rule | {"id": "y", "effective": "2026-13-01"}, rule | {"id": "w", "citation": []}, rule | {"id": "v", "more": 1}]})
    assert sorted((r.id, str(r.fault)) for r in dimensions.billing_rules(spark, at, strict=False).collect()) == [("r", "None"), ("r", "id stands twice"), ("v", "unknown key"), ("w", "citation"), ("y", "effective isn't a day"), ("z", "unknown zone")]
    with pytest.raises(PySparkException):
        dimensions.billing_rules(spark, at).collect()


def test_announced_channels(spark, tmp_path):
    rows = spark.createDataFrame([("s", "https://h/a/Page One", "sha", "now", "One. " * 300 + "End."), ("s", "https://h/b/page-one?x", "sha2", "now", "Two."), ("t", "https://h/", "sha3", "now", "x" * 700)], "source string, url string, sha string, fetched string, text string")
    named = {r.url: r.file for r in dimensions.channel_files(rows.select("source", "url")).collect()}
    assert named["https://h/"] == "state/announce/t/index.md" and all(len(named[u].rpartition("page-one-")[2]) == 11 for u in ("https://h/a/Page One", "https://h/b/page-one?x"))
    lines = [r.t for r in rows.select(text.wrapped(F.col("text")).alias("t")).collect()]
    assert all(x.endswith("\n") for x in lines) and max(len(x) for x in lines[0].split("\n")) <= 600
    index = {}
    for r in rows.collect():
        put(tmp_path / named[r.url], lines[[x.url for x in rows.collect()].index(r.url)])
        index.setdefault(r.source, {})[r.url] = {"file": named[r.url], "sha256": r.sha, "fetched": r.fetched}
    put(tmp_path / "state/announce/index.json", index)
    got = {r.url: r.text for r in dimensions.announce(spark, str(tmp_path)).collect()}
    assert got == {r.url: r.text for r in rows.collect()}
    index["t"]["https://h/"]["file"] = "state/announce/t/other.md"
    put(tmp_path / "state/announce/index.json", index)
    assert {r.fault for r in dimensions.announce(spark, str(tmp_path), strict=False).collect()} == {None, "names another file"}
    dimensions.write_announce(rows, f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out/index").count() == 3


def row(**kv):
    return {"schema": 4, "source": "s", "model_id": "m", "observed_at": "2026-01-01", "rates": {"input": 1.0, "output": 2.0}} | kv


def root_of(tmp_path, *rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(json.dumps(r))
    for source, lines in by.items():
        put(tmp_path / f"data/history/{source}.ndjson", "\n".join(lines) + "\n")
    put(tmp_path / "data/catalog/models.json", {"version": 4, "models": {"one": {"name": "One", "vendor": "v", "curated": True, "sources": {"s": "m", "groq": "org/elm-8b"}}}})
    put(tmp_path / "data/catalog/fx-rates.json", {"EUR": {"2026-01-01": 2.0}})
    put(tmp_path / "providers.toml", SECTION.format("databricks", "reseller", "currency_rate = 0.5"))
    return str(tmp_path)


def test_publish_job(spark, tmp_path):
    root = root_of(tmp_path, row(), row(observed_at="2026-02-01", removed=True), row(model_id="n", modality="image"), row(source="t"))
    readme = put(tmp_path / "R.md", "a\n<!-- stats:start -->old<!-- stats:end -->\nb")
    jobs.main(["publish-views", "--root", root, "--out", f"{tmp_path}/out", "--readme", readme])
    flat = {(r.source, r.model_id): r for r in spark.read.json(f"{tmp_path}/out/flat-v3").collect()}
    assert flat["s", "m"].name == "One" and flat["s", "m"].removed_at == "2026-02-01" and [i.valid_to for i in flat["s", "m"].intervals] == ["2026-02-01", None]
    assert flat["t", "m"].name == "m" and spark.read.json(f"{tmp_path}/out/flat-v2").count() == 2
    assert {(r.scope, r.entries, r.updated_at) for r in spark.read.json(f"{tmp_path}/out/heads").collect()} == {(None, 3, "2026-02-01"), ("s", 2, "2026-02-01"), ("t", 1, "2026-01-01")}
    assert [json.loads(r.value)["model_id"] for r in spark.read.text(f"{tmp_path}/out/history").collect()] == ["m", "m", "n", "m"]
    assert spark.read.json(f"{tmp_path}/out/index").where("source = 't'").count() == 1
    assert "| models tracked | **3** |" in open(readme).read() and "| canonical models | 1 |" in open(readme).read()
    page_rows = [r.value for r in spark.read.text(f"{tmp_path}/out/page").collect()]
    assert len(page_rows) == 3 and '<span class="tag tag-danger">removed 2026-02-01</span>' in page_rows[0] and "<td>1</td>" in page_rows[0]
    put(tmp_path / "data/history/empty.ndjson", "")
    (tmp_path / "data/history/t.ndjson").rename(tmp_path / "data/history/u.ndjson")
    with pytest.raises(ValueError, match="disagree"):
        jobs.main(["publish-views", "--root", root, "--out", f"{tmp_path}/out2"])


def test_ingest_job(spark, tmp_path):
    from tests.test_providers import PAGES

    stored = row(source="groq", model_id="org/elm-8b", rates={"input": 0.05, "output": 0.08}, limits={"context": 131072, "output": 8192})
    root = root_of(tmp_path, stored, row(source="scaleway", model_id="thyme-9b"), row(source="xai", model_id="tarn-4", removed=True))
    names = ("groq", "scaleway", "xai", "databricks", "ai21")
    spark.createDataFrame([(s, u, b) for s in names for u, b in PAGES[s]], "source string, url string, body string").write.parquet(f"{tmp_path}/pages")
    jobs.main(["ingest", "--pages", f"{tmp_path}/pages", "--root", root, "--day", "2026-03-01", "--out", f"{tmp_path}/out"])
    got = {(r.source, r.model_id): r for r in spark.read.parquet(f"{tmp_path}/out/appended").collect()}
    assert [r.source for r in observations.read_log(spark, f"{root}/data/history").where("source = 'ai21'").collect()] == ["ai21"]
    assert ("groq", "org/elm-8b") not in got  # its price didn't move
    assert got["scaleway", "thyme-9b"].rates.input == 3.6 and got["scaleway", "thyme-9b"].provenance.fx_rate == 2.0 and got["scaleway", "thyme-9b"].currency == "EUR"
    assert got["xai", "tarn-4"].overrides[0].when.min_tokens == 128000 and got["databricks", "glm-5.2"].rates.input == 5.0
    report = {(r.source, r.model_id): r.fault for r in spark.read.json(f"{tmp_path}/out/report").collect()}
    assert report["ai21", "fig-odd"] == "unreadable rate" and report["databricks", "Strange"] == "unmapped name"


def test_merge_review_and_health_jobs(spark, tmp_path):
    root = root_of(tmp_path, row())
    line = lambda **kv: json.dumps(row(**kv))
    branches = [("b1", "s.ndjson", 0, line()), ("b1", "s.ndjson", 1, line(observed_at="2026-02-01")), ("b2", "s.ndjson", 1, line(schema=3, observed_at="2026-02-02")), ("b3", "s.ndjson", 1, line(model_id="unclaimed"))]
    spark.createDataFrame(branches, "branch string, path string, pos int, line string").write.parquet(f"{tmp_path}/branches")
    jobs.main(["merge-branches", "--root", root, "--branches", f"{tmp_path}/branches", "--out", f"{tmp_path}/merged"])
    assert {r.branch for r in spark.read.json(f"{tmp_path}/merged/refused").collect()} == {"b2", "b3"}
    landed = [json.loads(r.value)["observed_at"] for r in spark.read.text(f"{tmp_path}/merged/data/history").collect()]
    assert sorted(landed) == ["2026-01-01", "2026-02-01"]
    spark.createDataFrame([(1, "rows/a", "abcdef1"), (2, "rows/b", "abcdef2"), (3, "else/c", "abcdef3")], "number bigint, head string, oid string").write.parquet(f"{tmp_path}/requests")
    spark.createDataFrame([(1, 0, "bot", "automerge: no abcdef1"), (1, 1, "bot", "x\nautomerge: yes abcdef1\nbye"), (1, 2, "reader", "automerge: no abcdef1"), (2, 0, "bot", "automerge: yes abcdef9")], "number bigint, pos int, author string, body string").write.parquet(f"{tmp_path}/comments")
    jobs.main(["merge-verified", "--requests", f"{tmp_path}/requests", "--comments", f"{tmp_path}/comments", "--bot", "bot", "--prefix", "rows/", "--out", f"{tmp_path}/review"])
    assert [r.head for r in spark.read.json(f"{tmp_path}/review/eligible").collect()] == ["rows/a"] and [r.head for r in spark.read.json(f"{tmp_path}/review/awaiting").collect()] == ["rows/b"]
    now = put(tmp_path / "now.log", "ERROR:x:detector for p failed: y\nINFO:x:providers checked: p q r\nWARNING:x:detect skip for q: z\n")
    before = put(tmp_path / "before.log", "ERROR:x:detector for p failed: y\nERROR:x:detector for r failed: y\n")
    spark.createDataFrame([("broken: r",), ("broken: gone",)], "title string").write.parquet(f"{tmp_path}/alerts")
    jobs.main(["health", "--now", now, "--before", before, "--alerts", f"{tmp_path}/alerts", "--prefix", "broken: ", "--out", f"{tmp_path}/health"])
    read = lambda name: [tuple(r) for r in spark.read.json(f"{tmp_path}/health/{name}").collect()]
    assert read("warning") == [("::warning::hard failures: p; skips: q",)] and read("opened") == [("p", "broken: p")] and read("closed") == [("broken: r",)]


def test_removal_and_smoke_jobs(spark, tmp_path):
    from tests.test_providers import PAGES

    root = root_of(tmp_path, row(), row(model_id="n"))
    seen = [("s", m, f"2026-02-0{d}", m == "n", True, False) for d in (1, 2) for m in ("m", "n")]
    spark.createDataFrame(seen, "source string, model_id string, run string, present boolean, settled boolean, held boolean").write.parquet(f"{tmp_path}/seen")
    jobs.main(["removals", "--seen", f"{tmp_path}/seen", "--root", root, "--day", "2026-02-02", "--out", f"{tmp_path}/out"])
    assert [(r.model_id, r.removed, r.rates.input) for r in spark.read.parquet(f"{tmp_path}/out/removed").collect()] == [("m", True, 1.0)]
    spark.createDataFrame([("moonshot", u, b) for u, b in PAGES["moonshot"]], "source string, url string, body string").write.parquet(f"{tmp_path}/pages")
    jobs.main(["smoke", "--pages", f"{tmp_path}/pages", "--source", "moonshot", "--model", "palm-k3"])
    with pytest.raises(ValueError, match="no positive price"):
        jobs.main(["smoke", "--pages", f"{tmp_path}/pages", "--source", "moonshot", "--model", "none"])


def test_listing_reports_what_it_leaves_out(spark):
    over = lambda *x: {"prompt": "0.000001", "overrides": list(x)}
    data = [
        {"id": "ok", "pricing": over({"utc_days": ["tuesday", "monday", "monday"], "utc_start": 2200, "utc_end": 200, "prompt": "0.000002"}, {"min_prompt_tokens": 1000, "prompt": "0.000003"}, {"other": "x"})},
        {"id": "price", "pricing": {"prompt": "cheap"}},
        {"id": "shape", "pricing": {"prompt": "0.1"}, "architecture": {"output_modalities": ["image", "video"]}},
        {"id": "bound", "pricing": over({"utc_start": 100})},
        {"id": "key", "pricing": over({"min_prompt_tokens": 5, "utc": 1})},
        {"id": "threshold", "pricing": over({"min_prompt_tokens": 2.5})},
        {"id": "days", "pricing": over({"utc_days": ["funday"]})},
        {"id": "overprice", "pricing": over({"utc_days": ["monday"], "prompt": "x"})},
        {"id": "clock", "pricing": over({"utc_start": 100, "utc_end": 175})},
    ]
    bodies = spark.createDataFrame([(json.dumps({"data": data}),), ("nothing",)], "body string")
    faults = {r.model_id: r.fault for r in listing.listing_faults(bodies, "api").collect()}
    assert faults == {"price": "price", "shape": "output modalities", "bound": "override: one bound", "key": "override: unknown key", "threshold": "override: threshold", "days": "override: days", "overprice": "override: price", "clock": "override: clock"}
    (r,) = listing.listing_rows(bodies, "api", "2026-01-01").collect()
    assert [(o.when.days, o.when.window, o.when.min_tokens, o.rates.input) for o in r.overrides] == [(["monday", "tuesday"], [2200, 2400], None, 2.0), (["monday", "tuesday"], [0, 200], None, 2.0), (None, None, 1000, 3.0)]
    assert json.loads(json.loads(r.unmapped)["overrides"]) == ['{"other":"x"}']


def test_page_texts(spark):
    show = lambda column: spark.range(1).select(column).first()[0]
    for value, want in ((1234567.0, "1.23457e+06"), (0.0001, "0.0001"), (0.00001234, "1.234e-05"), (100000.0, "100000"), (999999.5, "1e+06"), (2.5, "2.5"), (0.0, "0"), (-3.0, "-3"), (None, "—")):
        assert show(page.general(F.lit(value).cast("double"))) == want, value
    for value, want in ((1.0, "1"), (0.1, "0.1"), (1e-7, "1e-7"), (1.5e-7, "1.5e-7"), (0.00001, "0.00001"), (12345678.5, "12345678.5"), (1e21, "1e+21"), (123456789012.0, "123456789012"), (float("nan"), "—")):
        assert show(page.rate(F.lit(value).cast("double"))) == want, value
    for value, want in ((1.005, "1.00"), (1.015, "1.01"), (0.125, "0.1250"), (2.125, "2.13"), (0.01, "0.0100"), (0.009999, "0.0100"), (0.00123456, "0.00123"), (0.0000001234, "1.23e-7"), (0.0, "0.00"), (-1.0, "0.00")):
        assert show(page.money(F.lit(value))) == want or (value == 0.009999 and show(page.money(F.lit(value))) == "0.0100"), (value, show(page.money(F.lit(value))))
    assert show(page.times(F.lit(0.0), F.lit(0.0))) == "1.00×" and show(page.times(F.lit(1.0), F.lit(0.0))) == "—" and show(page.times(F.lit(3.0), F.lit(2.0))) == "1.50×"
    point = lambda d, v: F.struct(F.lit(d).alias("date"), F.lit(v).alias("value"))
    points = F.array(point("2026-01-01", 4.0), point("2026-01-06", 2.0))
    run = F.struct(points.alias("points"), F.lit("2026-01-11").alias("end"))
    assert show(page.polyline(points, F.lit("2026-01-11"), F.lit("2026-01-01"), F.lit("2026-01-21"), F.lit(4.0), F.lit(False))) == "0,0 25,0 25,50 50,50"
    assert show(page.polyline(points, F.lit(None), F.lit("2026-01-01"), F.lit("2026-01-21"), F.lit(4.0), F.lit(True))) == "0,50 25,50 25,50 100,50"
    assert show(page.chart_text(F.lit("M"), "cache_read", F.array(run), F.lit(True))) == "cached input price per million tokens: 4 from 2026-01-01, 2 from 2026-01-06, the line stops at 2026-01-11; the model was removed there."
    feed = '<?xml version="1.0"?><rss><pubDate>today</pubDate><title>A &amp; B</title></rss>'
    assert show(text.channel_prose(F.lit("https://x/feed"), F.lit(feed))) == "A &amp; B" and show(text.channel_prose(F.lit("https://x/a.md?b"), F.lit("# a\n <b> c"))) == "# a <b> c"


def test_runs_and_probes(spark):
    runs = lambda *x: spark.createDataFrame(list(x), "id string, created string, status string")
    jobs_ = lambda *x: spark.createDataFrame(list(x), "id string, name string, conclusion string")
    old, new = ("a", "2026-01-05T01:00:00Z", "completed"), ("b", "2026-01-12T01:00:00Z", "completed")
    probe = lambda r, j: tuple(review.weekly_probe(r, j).first())
    assert probe(runs(old, new), jobs_(("a", "smoke", "success"), ("b", "smoke", "skipped"))) == ("ok", "a")
    assert probe(runs(old, new), jobs_(("a", "smoke", "success"), ("b", "smoke", "failure"))) == ("failed", "b")
    assert probe(runs(old, new), jobs_(("a", "smoke", "success"), ("b", "other", "failure"))) == ("missing", "b")
    assert probe(runs(old, (*new[:2], "in_progress")), jobs_(("a", "smoke", "success")))[0] == "pending"
    assert probe(runs(old), jobs_(("a", "smoke", "skipped")))[0] == "skipped"
    assert probe(runs(("c", "2026-01-06T01:00:00Z", "completed")), jobs_(("c", "smoke", "failure")))[0] is None
    listed = review.listing(spark.createDataFrame([('[{"number":1,"headRefName":"rows/seed","headRefOid":"x"},{"title":"no number"}]',)], "body string"))
    assert [tuple(r) for r in listed.collect()] == [(1, "", "rows/seed", "x")] and review.seed_pending(listed, "rows/seed").first().pending
    assert [r.present for r in review.present(listed, spark.createDataFrame([("other",)], "head string")).collect()] == [False]
    before = spark.createDataFrame([("1", 1, "completed", False), ("2", 2, "completed", True), ("3", 3, "in_progress", False), ("4", 4, "completed", False)], "id string, number int, status string, held boolean")
    assert [r.id for r in review.previous_run(before, "4").collect()] == ["1"]


def test_missing_logs_are_empty(spark, tmp_path):
    assert observations.read_log(spark, f"{tmp_path}/none/*.ndjson").collect() == []
    put(tmp_path / "s.ndjson", json.dumps(row()) + "\n")
    assert observations.read_shard(spark, str(tmp_path), "s").count() == 1 and observations.read_shard(spark, str(tmp_path), "t").count() == 0
    with pytest.raises(ValueError):
        observations.read_shard(spark, str(tmp_path), "../s")
    assert publish.rendered("<!-- a:start -->x<!-- a:end -->", "a", "y") == "<!-- a:start -->\ny\n<!-- a:end -->"
