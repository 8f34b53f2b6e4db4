"""Interval cases and session totals worked out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from ratevane.operators import log, rates, temporal
from ratevane.schema import AXES, OVERRIDES, RATES

INTERVALS = {
    "future effective": ([("08-01", None, 1.0, False), ("08-20", "08-23", 2.0, False), ("09-01", None, None, True)], [("08-01", "08-23", 1.0), ("08-23", "09-01", 2.0), ("09-01", None, None)]),
    "backfill clamp": ([("08-25", "08-01", 1.0, False), ("08-20", "08-22", 2.0, False)], [("08-01", None, 1.0), ("08-22", "08-22", 2.0)]),
    "same day": ([("08-05", None, 1.0, False), ("08-05", None, 2.0, False)], [("08-05", "08-05", 1.0), ("08-05", None, 2.0)]),
    "removed last": ([("08-01", None, 1.0, False), ("08-06", None, None, True)], [("08-01", "08-06", 1.0), ("08-06", None, None)]),
    "revival": ([("08-26", None, 1.0, False), ("08-29", None, None, True), ("09-08", None, 0.5, False)], [("08-26", "08-29", 1.0), ("08-29", "09-08", None), ("09-08", None, 0.5)]),
    "removal alone": ([("08-06", "08-01", None, True)], [("08-06", None, None)]),
}
LOG = "source string, model_id string, pos bigint, observed_at string, effective_at string, rate_input double, removed boolean"


def frame(spark, rows):
    day = lambda d: d and f"2026-{d}"
    return spark.createDataFrame([("s", "m", i, day(o), day(e), r, x) for i, (o, e, r, x) in enumerate(rows)], LOG)


@pytest.mark.parametrize("name", INTERVALS)
def test_intervals(spark, name):
    rows, want = INTERVALS[name]
    got = temporal.interval_chain(frame(spark, rows)).orderBy("valid_from", "pos").collect()
    assert [(r.valid_from[5:], r.valid_to and r.valid_to[5:], r.rate_input) for r in got] == want


def test_every_day_against_a_day_by_day_search(spark):
    rows = [("08-01", None, 1.0, False), ("08-20", "08-23", 2.0, False), ("08-10", "08-15", 3.0, False), ("08-25", None, None, True), ("08-28", "08-27", 4.0, False), ("08-28", None, 5.0, False)]
    probes = spark.createDataFrame([("s", "m", f"2026-08-{d:02d}") for d in range(1, 32)], "source string, model_id string, day string")
    got = {r.day: None if r.removed else r.rate_input for r in temporal.price_as_of(temporal.interval_chain(frame(spark, rows)), probes, ["pos", "removed", "rate_input"]).collect()}
    for d in range(1, 32):
        day, best = f"08-{d:02d}", None
        for i, (o, e, r, x) in enumerate(rows):
            start = o if x else e or o
            if start <= day and (best is None or (o, i) >= best[:2]):
                best = (o, i, None if x else r)
        assert got[f"2026-{day}"] == (best and best[2])


def test_changes_and_unions(spark):
    df = frame(spark, [("08-01", None, 1.0, False), ("08-02", None, 1.0, False), ("08-03", None, None, True), ("08-04", None, 1.0, False), ("08-05", None, 2.0, False)])
    assert [(r.pos, r.reappeared) for r in log.changes(df, ["rate_input"]).orderBy("pos").collect()] == [(0, False), (3, True), (4, False)]
    extra = frame(spark, [("08-01", None, 9.0, False), ("08-01", None, None, True), ("08-03", None, None, True), ("08-09", None, None, True), ("08-09", None, 3.0, False), ("08-10", None, 4.0, False), ("08-10", None, 5.0, False)])
    assert sorted(r.pos for r in log.key_union(df, extra).collect()) == [1, 3, 5]
    empty = df.limit(0)
    assert log.stats(empty).first().asDict() == {"models": 0, "sources": 0, "rows": 0, "first_seen": "-", "days": 0, "updated_at": ""}
    assert temporal.interval_chain(empty).collect() == [] and temporal.runs(temporal.interval_chain(empty), "rate_input").collect() == []


WEEK = ["monday", "tuesday", "wednesday", "thursday", "friday"]
BOTH = [dict(window=[100, 400], days=WEEK, rates=dict(input=4.0, output=16.0)), dict(window=[100, 200], days=WEEK, rates=dict(input=9.0, output=36.0))]
SHADOW = [dict(window=[100, 400], rates=dict(input=9.0, output=36.0)), dict(window=[100, 200], days=["monday"], multiplier=0.4)]
FAST = [dict(mode="fast", rates=dict(input=10.0, output=50.0))]
BATCH = [dict(mode="batch", rates=dict(input=2.5, output=15.0, cache_read=0.625))]
VOLUME = [dict(min_tokens=500_000, rates=dict(input=0.5))]
SESSIONS = [
    (dict(input=2.0, output=8.0, cache_read=0.5), BOTH, "2026-09-07", 120, "", 1_000_000, 200_000, 50_000, 10.9),
    (dict(input=2.0, output=8.0, cache_read=0.5), BOTH, "2026-09-07", 240, "", 1_000_000, 200_000, 50_000, 4.9),
    (dict(input=2.0, output=8.0, cache_read=0.5), BOTH, "2026-09-06", 120, "", 1_000_000, 200_000, 50_000, 2.5),
    (dict(input=2.0, output=8.0, cache_read=0.5), BOTH, "2026-09-07", 420, "", 1_000_000, 200_000, 50_000, 2.5),
    (dict(input=1.0, output=4.0), [], "2026-10-05", 120, "", 1_000_000, 200_000, 50_000, 1.4),
    (dict(input=1.0), VOLUME, "2026-10-05", 0, "", 1_000_000, 0, 0, 0.5),
    (dict(input=1.0), VOLUME, "2026-10-05", 0, "", 100_000, 0, 0, 0.1),
    (dict(input=1.0), VOLUME, "2026-10-05", 0, "", 300_000, 300_000, 0, 0.3),
    (dict(input=1.0), VOLUME, "2026-10-05", 0, "", 500_000, 0, 0, 0.5),
    (dict(input=2.0, output=8.0, cache_read=0.5), SHADOW, "2026-09-07", 120, "", 1_000_000, 200_000, 50_000, 2.5),
    (dict(input=2.0, output=8.0, cache_read=0.5), SHADOW, "2026-09-07", 240, "", 1_000_000, 200_000, 50_000, 10.9),
    (dict(input=5.0, output=25.0), FAST, "2026-09-07", 0, "fast", 1_000_000, 200_000, 50_000, 14.5),
    (dict(input=5.0, output=25.0), FAST, "2026-09-07", 0, "batch", 1_000_000, 200_000, 50_000, 7.25),
    (dict(input=5.0, output=30.0, cache_read=1.25), BATCH, "2026-09-07", 0, "batch", 1_000_000, 200_000, 50_000, 3.375),
    (dict(input=5.0, output=30.0, cache_read=1.25), BATCH, "2026-09-07", 0, "", 1_000_000, 200_000, 50_000, 6.75),
    (dict(input=5.0), [], "2026-09-07", 0, "", 1_000_000, 0, 1, None),
]


def test_sessions(spark):
    axes = lambda r: tuple(r.get(a) for a in AXES)

    def entry(o):
        when = tuple(o.get(k) for k in ("days", "window", "timezone", "min_tokens", "mode"))
        return (when, axes(o["rates"]) if "rates" in o else None, o.get("multiplier"))

    rows = [(i, axes(b), [entry(o) for o in os], datetime.date.fromisoformat(day), minute, mode, a, c, o) for i, (b, os, day, minute, mode, a, c, o, _) in enumerate(SESSIONS)]
    df = spark.createDataFrame(rows, f"i int, base {RATES}, overrides {OVERRIDES}, day date, minute int, mode string, a bigint, c bigint, o bigint")
    c = F.col
    own = rates.effective(c("base"), c("overrides"), lambda o: rates.matches(o, c("day"), c("minute"), c("a") + c("c"), c("mode"), rates.MINUTES))
    got = {r.i: r.t for r in df.select("i", rates.session_total(own, c("a"), c("c"), c("o")).alias("t")).collect()}
    assert [got[i] if got[i] is None else round(got[i], 6) for i in range(len(rows))] == [s[-1] for s in SESSIONS]


def test_slices_of_a_large_key_change_nothing(spark):
    import random

    rng = random.Random(6)
    day = lambda: f"{rng.randint(1, 9):02d}-{rng.randint(1, 28):02d}"
    rows = [(day(), rng.choice([None, day()]), float(i), rng.random() < 0.2) for i in range(300)]
    df = frame(spark, rows)
    cuts = temporal.cuts_of(df, "observed_at", 5)
    assert 3 <= len(cuts) <= 4 and temporal.cuts_of(df, "observed_at", 1) == []
    order = lambda x: sorted((r.pos, r.valid_from, str(r.valid_to)) for r in x.collect())
    whole, sliced = temporal.interval_chain(df), temporal.interval_chain(df, cuts=cuts)
    assert order(whole) == order(sliced)
    probes = spark.createDataFrame([("s", "m", f"2026-{day()}") for _ in range(200)] + [("s", "m", "2025-01-01"), ("s", "other", "2026-05-05")], "source string, model_id string, day string")
    got = [sorted(map(str, map(tuple, temporal.price_as_of(whole, probes, ["pos", "removed"], cuts=c).collect()))) for c in (None, cuts)]
    assert got[0] == got[1] and len(got[0]) == 202
