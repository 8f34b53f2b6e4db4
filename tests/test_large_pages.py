"""What keeps pages, and what stands on them, within the memory of one process."""

import random

import pyarrow as pa

from ratevane.functions import markup
from ratevane.operators import catalog, runs, temporal
from ratevane.plans import priced_pages
from ratevane.sources import registry
from ratevane.sources.priced import READINGS
from tests.test_providers import table


def test_parts_are_dealt_before_pages_are_made(spark, tmp_path):
    spark.createDataFrame([(i, i % 50 + 1) for i in range(40)], "p_partkey bigint, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    pages = priced_pages.databricks(priced_pages._parts(spark, str(tmp_path)))
    assert pages.rdd.getNumPartitions() == 4 and len({r.run for r in pages.collect()}) == 40


def test_headings_of_databricks_are_not_broadcast(spark):
    body = '<table><thead><tr><th>Model</th><th>Standard Pay Per Token (DBU Per 1M Tokens)</th></tr><tr><th></th><th>Input</th><th>Output</th><th>Cache read</th></tr></thead><tbody><tr><td>GTE</td><td>1</td><td>-</td><td>-</td></tr></tbody></table>'
    pages = spark.createDataFrame([(f"r{i}", "databricks", "u", body) for i in range(3)] + [("r9", "databricks", "u", body.replace("Cache read", "Cache")), ("r8", "databricks", "u", table(["GTE"], ["1"]))], "run string, source string, url string, body string")
    got = registry.all_priced(pages, ("databricks",))
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.run, r.model_id, r.rates.input) for r in got.collect()) == [(f"r{i}", "gte", 1.0) for i in range(3)]


def test_least_id_of_a_run_where_another_begins_with_it(spark):
    rows = [("m100000", "unreadable rate"), ("m1000004", "unreadable rate"), ("m1", None)]
    priced = spark.createDataFrame([("s", "r", *x) for x in rows], "source string, run string, model_id string, fault string")
    fetched = spark.createDataFrame([("s", "r"), ("t", "r"), ("v", "r")], "source string, run string")
    faults = spark.createDataFrame([("t", "r", "u", "empty page"), ("t", "r", "u/2", "empty page"), ("v", "r", None, "empty page")], "source string, run string, url string, fault string")
    got = {r.source: r.reason for r in runs.validity(fetched, faults, priced).collect()}
    assert got == {"s": "skipped m100000: unreadable rate", "t": "page u: empty page", "v": "page empty page"}


def test_aliases_in_slices_of_days(spark):
    rnd = random.Random(5)
    days = [f"2026-{m:02}-{d:02}" for m in (1, 2, 3) for d in range(1, 29)]
    some = lambda: rnd.choice([None, *rnd.sample(days, 4)])
    aliases = [(rnd.choice(["a", "b", None]), some(), some(), str(i)) for i in range(150)]
    probes = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, *days])) for i in range(400)]
    p, a = spark.createDataFrame(probes, "k int, alias string, day string"), spark.createDataFrame(aliases, "alias string, valid_from string, valid_to string, canonical string")
    whole = sorted(map(tuple, catalog.alias_on(p, a).collect()), key=str)
    for n in (2, 3, 20):
        cut = catalog.alias_on(p, a, cuts=temporal.cuts_of(p, "day", n))
        assert cut.columns == ["k", "alias", "day", "canonical"] and sorted(map(tuple, cut.collect()), key=str) == whole
    assert cut.rdd.getNumPartitions() >= 16  # two aliases, more tasks


def held_rows(monkeypatch, body, reading):
    """Rows of a page, and the most that were held in memory of it."""
    most, put = [0], markup._Held.put

    def counted(held, rows):
        put(held, rows)
        most[0] = max(most[0], len(held.rows))

    monkeypatch.setattr(markup._Held, "put", counted)
    return list(markup.page_rows(markup.Index(reading), body)), most[0]


def test_a_large_page_is_not_held_in_memory(monkeypatch):
    monkeypatch.setattr(markup, "HELD_ROWS", 50)
    monkeypatch.setattr(markup, "HELD_BYTES", 1000)
    rows = "".join(f"<tr><td>m{i}<td>a<table><tr><td>b</td></tr></table></td></tr>" for i in range(5000))
    got, most = held_rows(monkeypatch, f"<table>{rows}<caption>late</caption></table>", READINGS["fireworks"])
    assert most < 300 and len(got) == 5000 and {r["caption"] for r in got} == {"late"} and [r["first"] for r in got[:2]] == [True, False]
    assert [r["cells"][0] for r in got] == [f"m{i}" for i in range(5000)] and got[-1]["cells"][1] == "a b" and got[-1]["top"][0] == "m0"
    broken, _ = held_rows(monkeypatch, f"<table>{rows}</table><![x[<p>", READINGS["fireworks"])
    assert broken == [{"kind": "fault", "value": "markup: AssertionError"}]


def test_batches_of_pages_are_bounded(spark, monkeypatch):
    card = '<div class="av-model-card"><div class="av-model-label">m{i}</div></div>'
    body = '<div id="avModelGrid">' + "".join(card.replace("{i}", str(i)) for i in range(3000)) + "</div>"
    caught, kept = [], []

    class Caught:
        def mapInArrow(self, f, schema):  # noqa: N802
            caught.append(f)

    monkeypatch.setattr(markup, "reachable", lambda df: Caught())
    monkeypatch.setattr(markup, "shared_table", lambda df, name, *by: kept.append(by))
    pages = spark.createDataFrame([], "source string, url string, body string")
    registry.read(pages, ("avian",))
    registry.read(pages, ("avian", "ai21"))
    batch = pa.RecordBatch.from_pydict({"source": ["avian"] * 3, "run": [""] * 3, "url": ["a", "b", "c"], "body": [body] * 3})
    made = list(caught[0](iter([batch])))
    assert max(b.num_rows for b in made) == markup.BATCH_ROWS and sum(b.num_rows for b in made) == 3 * 6001
    assert {x for b in made for x in b.column(2).to_pylist()} == {"a", "b", "c"} and kept == [(), ("source",)]
