"""Jobs one after the other on one log: pages taken up, branches merged, the tree published; runs that come twice; rows that come late."""

import json
import random

from pyspark.sql import functions as F

from ratevane import jobs
from ratevane.operators.temporal import interval_chain
from ratevane.sources import observations
from ratevane.streaming.chain import interval_stream, standing
from tests.test_files_and_jobs import put, root_of, row
from tests.test_providers import PAGES, table

API = json.dumps({"data": [{"id": "v/api-1", "name": "V: Api 1", "context_length": 10, "pricing": {"prompt": "0.000001", "completion": "0.000002"}}, {"id": "v/api-odd", "pricing": {"prompt": "cheap"}}]})


def log_of(spark, root):
    rows = observations.read_log(spark, f"{root}/data/history").orderBy("path", "pos").collect()
    out = {}
    for r in rows:
        out.setdefault((r.source, r.model_id), []).append((r.observed_at, bool(r.removed), r.rates and r.rates.input))
    return out


def together(*rows):
    return table(["model", "input", "output"], *rows)


def test_pages_branches_and_tree_in_a_row(spark, tmp_path):
    root = root_of(tmp_path, row(source="together", model_id="oak", rates={"input": 1.0, "output": 2.0}), row(source="together", model_id="elm"), row(source="together", model_id="held"), row(source="xai", model_id="tarn-4", rates={"input": 9.0, "output": 9.0}))
    pages = [("together", "u", together(["oak", "$1", "$2"], ["fir", "$3", "$4"], ["held", "$8", "$8"])), ("openrouter", "a", API), ("xai", "u", "<script>changed</script>")]
    spark.createDataFrame(pages, "source string, url string, body string").write.parquet(f"{tmp_path}/pages")
    waiting = [("b", "together.ndjson", 7, json.dumps(row(source="together", model_id="held", observed_at="2026-02-01", rates={"input": 7.0, "output": 7.0})))]
    spark.createDataFrame(waiting, "branch string, path string, pos int, line string").write.parquet(f"{tmp_path}/pending")
    run = lambda day: jobs.main(["ingest", "--pages", f"{tmp_path}/pages", "--root", root, "--day", day, "--out", f"{tmp_path}/out", "--pending", f"{tmp_path}/pending"])
    run("2026-03-01")
    once = log_of(spark, root)
    run("2026-03-01")  # again: nothing stands twice
    assert log_of(spark, root) == once
    assert once["together", "fir"] == [("2026-03-01", False, 3.0)] and once["openrouter", "v/api-1"] == [("2026-03-01", False, 1.0)]
    assert len(once["together", "held"]) == len(once["together", "oak"]) == 1  # held, and unchanged
    valid = {r.source: r.reason for r in spark.read.parquet(f"{tmp_path}/out/validity/run=2026-03-01").collect()}
    assert valid == {"together": None, "openrouter": "skipped v/api-odd: price", "xai": "no row"}
    state = lambda day: {(r.source, r.model_id): (r.absent_runs, r.since) for r in spark.read.parquet(f"{tmp_path}/out/state/run={day}").collect()}
    assert state("2026-03-01") == {("together", "elm"): (1, "2026-03-01")}  # a changed page delists nothing
    run("2026-03-02")
    after = log_of(spark, root)
    assert after["together", "elm"] == [("2026-01-01", False, 1.0), ("2026-03-02", True, 1.0)] and len(after["xai", "tarn-4"]) == 1

    line = lambda **kv: json.dumps(row(source="together", **kv))
    branches = [("b1", "together.ndjson", 0, line(model_id="oak", observed_at="2026-03-04")), ("b2", "together.ndjson", 0, line(model_id="new", observed_at="2026-03-04")), ("b3", "together.ndjson", 0, line(model_id="nobody", observed_at="2026-03-04"))]
    spark.createDataFrame(branches, "branch string, path string, pos int, line string").write.parquet(f"{tmp_path}/branches")
    entry = lambda *ids: json.dumps({"vendor": None, "curated": False, "sources": {"together": list(ids)}})
    put(tmp_path / "data/catalog/models.json", {"version": 4, "models": {"a": json.loads(entry("oak"))}})
    put(tmp_path / "data/catalog/billing-rules.json", {"rules": [{"id": "r1", "text": "head"}]})
    changes = f"{tmp_path}/changes"
    spark.createDataFrame([("b2", 0, "n", entry("new"), None), ("b4", 0, "a2", entry("oak"), None), ("b5", 0, "n2", entry("new", "x"), None)], "branch string, ord int, canonical string, entry string, base_entry string").write.parquet(f"{changes}/entries")
    spark.createDataFrame([("b1", "r1", '{"id":"r1"}'), ("b3", "r9", '{"id":"r9"}'), ("b2", "r2", '{"id":"r2"}')], "branch string, id string, rule string").write.parquet(f"{changes}/rules")
    files = [("head", 1, "together", "{}"), ("b1", 5, "together", '{"elm":{"absent_runs":2,"since":"x"},"fir":{"absent_runs":1,"since":"y"}}'), ("b3", 9, "together", '{"oak":{"absent_runs":1,"since":"z"}}')]
    spark.createDataFrame(files, "ref string, authored int, source string, state string").write.parquet(f"{changes}/absence")
    jobs.main(["merge-branches", "--root", root, "--branches", f"{tmp_path}/branches", "--changes", changes, "--out", f"{tmp_path}/next"])
    assert [r.branch for r in spark.read.json(f"{tmp_path}/next/refused").collect()] == ["b3"]
    merged = log_of(spark, f"{tmp_path}/next")
    assert merged == after | {("together", "oak"): [*after["together", "oak"], ("2026-03-04", False, 1.0)], ("together", "new"): [("2026-03-04", False, 1.0)]}
    assert sorted(r.canonical for r in spark.read.parquet(f"{tmp_path}/next/catalog").collect()) == ["a", "n"]
    assert sorted((r.branch, r.canonical) for r in spark.read.json(f"{tmp_path}/next/refused-entries").collect()) == [("b4", "a2"), ("b5", "n2")]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/next/rules").collect()) == ["r1", "r2"]
    assert [(r.model_id, r.absent_runs) for r in spark.read.parquet(f"{tmp_path}/next/absence").collect()] == [("fir", 1)]  # elm's removal has landed
    put(tmp_path / "next/data/catalog/models.json", {"version": 4, "models": {}})
    jobs.main(["publish-views", "--root", f"{tmp_path}/next", "--out", f"{tmp_path}/tree"])
    flat = {(r.source, r.model_id): r for r in spark.read.json(f"{tmp_path}/tree/flat-v3").collect()}
    assert sorted(flat) == sorted(merged) and flat["together", "elm"].removed_at == "2026-03-02" and [i.valid_from for i in flat["together", "oak"].intervals] == ["2026-01-01", "2026-03-04"]


def test_a_stream_of_pages_takes_each_file_up_once(spark, tmp_path):
    root = root_of(tmp_path, row(source="together", model_id="oak"))
    args = ["ingest", "--pages", f"{tmp_path}/pages", "--root", root, "--day", "2026-03-01", "--out", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/at"]
    schema = "source string, url string, body string"
    for n, price in enumerate((3, 4)):
        spark.createDataFrame([("together", "u", together(["fir", f"${price}", "$9"]))], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/pages")
        jobs.main(args)
        assert [x[2] for x in log_of(spark, root)["together", "fir"]] == [3.0, 4.0][: n + 1]
    for commit in (tmp_path / "at" / "commits").glob("*1*"):  # as if the last run had died after its work
        commit.unlink()
    jobs.main(args)
    assert [x[2] for x in log_of(spark, root)["together", "fir"]] == [3.0, 4.0]
    assert sorted(r.run for r in spark.read.parquet(f"{tmp_path}/out/appended").select("run").distinct().collect()) == ["2026-03-01-00000000", "2026-03-01-00000001"]


def test_late_rows_change_intervals(spark, tmp_path):
    rng = random.Random(3)
    day = lambda: f"2026-01-{rng.randint(1, 28):02d}"
    rows = [("s", f"m{i % 3}", day(), i, rng.choice([None, day()]), rng.random() < 0.2) for i in range(60)]
    schema = "source string, model_id string, observed_at string, pos bigint, effective_at string, removed boolean"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        late = rows[:]
        rng.shuffle(late)
        for n in range(3):
            spark.createDataFrame(late[n * 20 : n * 20 + 20] + late[:4], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")  # some rows come again
            stream = interval_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"))
            query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination(240)
            come = spark.createDataFrame(late[: n * 20 + 20], schema)
            got = standing(spark.read.parquet(f"{tmp_path}/out"))
            assert sorted(map(str, got.collect())) == sorted(map(str, interval_chain(come).select(got.columns).collect()))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert spark.read.parquet(f"{tmp_path}/out").where(F.col("change") == -1).count() > 0
