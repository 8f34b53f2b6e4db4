"""What the page shows and what can't be taken up, by hand; an ingest run in which two page ids are stored under one key."""

import json

import pytest
from pyspark.sql import functions as F

from ratevane import jobs
from ratevane.functions import page
from ratevane.operators import candidates, catalog, rates, review
from ratevane.plans import catalogue, priced_pages
from ratevane.schema import OVERRIDES, RATES
from ratevane.sources.priced import SOURCES
from tests.test_files_and_jobs import root_of, row
from tests.test_providers import table
from tests.test_runs_of_jobs import log_of

KEYS = "source string, model_id string"


def test_every_source_has_a_query_with_sql():
    asked = {n.removeprefix("priced_") for n in catalogue.SQL if n.startswith("priced_")}
    assert set(SOURCES) <= asked and set(priced_pages.QUERIES) == set(priced_pages.SQL)


def test_refused(spark):
    priced = spark.createDataFrame([("s", "a", "a"), ("s", "b-1", "b"), ("s", "c-1", "c"), ("s", "d", "d"), ("t", "a", "a"), ("s", "a", "a"), ("s", None, None)], KEYS + ", stored string")
    stored = spark.createDataFrame([("s", "a", True), ("s", "b", None), ("s", "c", False), ("t", "a", False)], KEYS + ", removed boolean")
    covered = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "b"), ("s", "d"), ("s", None)], KEYS)
    got = candidates.refused(priced, stored, covered)
    assert sorted(map(tuple, got.collect())) == [("s", "a", "a", "removed"), ("s", "b-1", "b", "covered"), ("s", "d", "d", "covered")]
    assert candidates.refused(priced.limit(0), stored, covered).collect() == [] and candidates.refused(priced, stored.limit(0), covered.limit(0)).collect() == []


def test_keepers(spark):
    named = spark.createDataFrame([("s", "b", "x"), ("s", "a", "x"), ("s", "x", "x"), ("s", "q", "y"), ("s", "p", "y"), ("t", "b", "x")], KEYS + ", stored string")
    assert sorted((r.source, r.stored, r.model_id) for r in candidates.keepers(named).collect()) == [("s", "x", "x"), ("s", "y", "p"), ("t", "x", "b")]


def test_a_seed_that_collides_stops_the_query(spark):
    keys = spark.createDataFrame([("s", "m"), ("s", "m"), ("s", "n"), ("t", "m")], KEYS)
    claimed = spark.createDataFrame([("s", "n")], KEYS)
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "canonical string")
    assert sorted(r.canonical for r in catalog.seeds(keys, claimed, names("s/n", "one")).collect()) == ["s/m", "t/m"]
    with pytest.raises(Exception, match="seed collides with an entry of the catalog: t/m"):
        catalog.seeds(keys, claimed, names("t/m", "t/m")).collect()


def test_found(spark):
    rows = spark.createDataFrame([("Ash 8B", "Maker"), ("100% oak", None), (None, None)], "name string, vendor string")
    shown = lambda needle: [r.name for r in rows.where(page.found(F.lit(needle), F.col("name"), F.col("vendor"))).collect()]
    assert shown(" mAkE ") == shown("8b") == ["Ash 8B"] and shown("%") == ["100% oak"] and shown("_") == []
    assert shown("") == shown("   ") == shown(None) == ["Ash 8B", "100% oak", None]


def test_priced_axes(spark):
    over = '[{"when":{"window":[100,400]},"rates":{"audio":1.0}},{"when":{"mode":"fast"},"rates":{"image":1.0}},{"when":{"window":[0,100]},"rates":null}]'
    at = lambda base, o: rates.priced_axes(F.from_json(F.lit(base), RATES), F.from_json(F.lit(o), OVERRIDES))
    one = spark.range(1).select(at('{"output":1.0,"input":0.0}', over).alias("a"), at(None, over).alias("b"), at('{"input":1.0}', None).alias("c"), at(None, None).alias("d")).first()
    assert tuple(one) == (["input", "output", "audio"], ["audio"], ["input"], [])


def test_channels_that_share_a_slug_only_in_another_index(spark):
    urls = [(1, "s", "https://h/a/x"), (1, "s", "https://h/b/x"), (2, "s", "https://h/a/x"), (2, "s", "https://h/a/x"), (3, "s", "https://h/")]
    branches = spark.createDataFrame(urls, "number int, source string, url string")
    diffs = spark.createDataFrame([(1, "state/announce/s/x.md"), (2, "state/announce/s/x.md"), (3, "state/announce/s/index.md"), (3, "state/announce/s/x.md"), (9, "state/announce/s/x.md")], "number int, path string")
    assert sorted(map(tuple, review.changed_channels(branches, diffs).collect())) == [(2, "s", "https://h/a/x"), (3, "s", "https://h/")]
    assert review.changed_channels(branches, diffs.limit(0)).collect() == []


def test_rates_read_as_they_are_written(spark):
    values = [0.0, 1.0, -2.5, 0.1, 1e-6, 9.5e-7, 1.25e-10, 123456789.0, 1e20, 1e21, 1.5e22, 1e7, 12345678.9, float("nan"), float("inf"), None]
    want = ["0", "1", "-2.5", "0.1", "0.000001", "9.5e-7", "1.25e-10", "123456789", "100000000000000000000", "1e+21", "1.5e+22", "10000000", "12345678.9", "—", "—", "—"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    assert [r.t for r in df.select("i", page.rate(F.col("v")).alias("t")).orderBy("i").collect()] == want


def test_two_page_ids_of_one_stored_key(spark, tmp_path):
    root = root_of(tmp_path, row(source="mistral", model_id="teak-2508", rates={"input": 1.0, "output": 2.0}), row(source="mistral", model_id="elm-2501", rates={"input": 1.0, "output": 2.0}))
    link = lambda slug, *cells: [f'<a href="/models/{slug}">x</a>', *cells]
    body = "<section>Prices /M Tokens" + table(["Model", "Input", "Cached input", "Output"], link("teak-25-08", "$7", "-", "$7"), link("teak-2508", "$3", "-", "$4"), link("elm-25-01", "$5", "-", "$6")) + "</section>"
    spark.createDataFrame([("mistral", "u", body)], "source string, url string, body string").write.parquet(f"{tmp_path}/pages")
    jobs.main(["ingest", "--pages", f"{tmp_path}/pages", "--root", root, "--day", "2026-03-01", "--out", f"{tmp_path}/out"])
    got = log_of(spark, root)
    assert got == {("mistral", "teak-2508"): [("2026-01-01", False, 1.0), ("2026-03-01", False, 3.0)], ("mistral", "elm-2501"): [("2026-01-01", False, 1.0), ("2026-03-01", False, 5.0)]}
    report = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out/report/run=2026-03-01").collect()]
    assert [(r["model_id"], r["fault"]) for r in report] == [("teak-25-08", "stored under teak-2508, which another id refreshes")]
