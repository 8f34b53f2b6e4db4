import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratevane.operators import absence, log
from ratevane.sources import observations as O
from ratevane.streaming import flows


def test_shards_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"schema": 4, "source": "s", "model_id": m, "observed_at": d, "rates": {"input": 1.5}} for m, d in (("b", "2026-01-02"), ("a", "2026-01-03"), ("a", "2026-01-01"))]
    rows[0]["provenance"] = {"name": "x y"}
    (tmp_path / "in" / "s.ndjson").write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))
    read = O.read_log(spark, f"{tmp_path}/in")
    assert [(r.pos, r.model_id, r.rates.input) for r in read.orderBy("pos").collect()] == [(0, "b", 1.5), (1, "a", 1.5), (2, "a", 1.5)]
    O.write_shards(read, f"{tmp_path}/out")
    again = O.read_log(spark, f"{tmp_path}/out").where("source = 's'").orderBy("path", "pos").collect()
    assert [(r.model_id, r.observed_at) for r in again] == [("a", "2026-01-01"), ("a", "2026-01-03"), ("b", "2026-01-02")]
    (tmp_path / "in" / "t.ndjson").write_text("[1]\n")
    with pytest.raises(PySparkException):
        O.read_log(spark, f"{tmp_path}/in").collect()
    assert O.read_log(spark, f"{tmp_path}/in", strict=False).where("source is null").count() == 1


def test_dimension_files(spark, tmp_path):
    (tmp_path / "fx.json").write_text(json.dumps({"EUR": {"2026-01-01": 1.1}}))
    assert [tuple(r) for r in O.read_fx(spark, f"{tmp_path}/fx.json").collect()] == [("EUR", "2026-01-01", 1.1)]
    (tmp_path / "bad.json").write_text(json.dumps({"EUR": {"2026-01-01": 0.0}}))
    with pytest.raises(PySparkException):
        O.read_fx(spark, f"{tmp_path}/bad.json").collect()
    (tmp_path / "c.json").write_text(json.dumps({"version": 4, "models": {"m": {"name": "M", "vendor": None, "curated": True, "sources": {"s": ["a", "b"], "t": "c"}}}}))
    assert sorted((r.source, r.model_id) for r in O.read_catalog(spark, f"{tmp_path}/c.json").collect()) == [("s", "a"), ("s", "b"), ("t", "c")]
    (tmp_path / "a.json").write_text(json.dumps({"version": 4, "aliases": {"x": [{"from": None, "to": "2026-01-01", "canonical": "m", "citation": "u"}]}}))
    assert [tuple(r)[:4] for r in O.read_aliases(spark, f"{tmp_path}/a.json").collect()] == [("x", None, "2026-01-01", "m")]


def drain(stream, tmp_path, name, spark):
    q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp_path}/{name}").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(240)
    return spark.table(name).collect()


def arrive(spark, tmp_path, name, schema, parts, made):
    """Rows of a stream whose parts arrive one after the other, each taken up by a run of its own with the state of those before."""
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}-in/{n}")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}-in/*")
        q = made(stream).writeStream.format("parquet").option("path", f"{tmp_path}/{name}-out").option("checkpointLocation", f"{tmp_path}/{name}-at").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(240)
    return spark.read.parquet(f"{tmp_path}/{name}-out").collect()


def test_change_stream_is_the_batch_rule(spark, tmp_path):
    rows = [("s", f"m{i % 3}", i, i % 7 == 3, float(i // 6)) for i in range(60)]
    schema = "source string, model_id string, pos bigint, removed boolean, v double"
    parts = [rows[i : i + 20] for i in (0, 20, 40)]
    got = sorted((r.model_id, r.pos, r.value, r.reappeared) for r in arrive(spark, tmp_path, "changes", schema, parts, lambda s: flows.change_stream(s, "v")))
    batch = log.changes(spark.createDataFrame(rows, schema), ["v"])
    assert got == sorted((r.model_id, r.pos, r.v, r.reappeared) for r in batch.collect())


def test_windowed_counts(spark, tmp_path):
    at = lambda h, m: dt.datetime(2026, 1, 1, h, m)
    first = [("s", at(1, 5)), ("s", at(1, 50)), ("t", at(1, 10)), ("s", at(2, 1))]
    late = [("s", at(9, 0)), ("s", at(2, 30))]
    end = [("s", at(23, 0)), ("s", at(1, 1))]
    got = arrive(spark, tmp_path, "counts", "source string, at timestamp", [first, late, end], lambda s: flows.windowed_counts(s, "at", "1 hour", "2 hours"))
    assert sorted((r.source, r.start.hour, r.n) for r in got) == [("s", 1, 2), ("s", 2, 2), ("s", 9, 1), ("t", 1, 1)]  # the last row is too late for its window


def test_removal_stream_is_the_batch_rule(spark, tmp_path):
    rows = [("s", f"m{k}", f"2026-01-{d:02d}", (d * k) % 3 == 0, d != 5, k == 4 and d == 7) for d in range(1, 11) for k in range(1, 5)]
    schema = "source string, model_id string, run string, present boolean, settled boolean, held boolean"
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.parquet(f"{tmp_path}/seen")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/seen")
    got = sorted((r.model_id, r.run) for r in drain(absence.stream_removals(stream), tmp_path, "removals", spark))
    assert got == sorted((r.model_id, r.run) for r in absence.two_strikes(df).where("removes").collect())


def test_queries_have_names_and_sql():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "price_asof_day" in e.oracle_sql()
