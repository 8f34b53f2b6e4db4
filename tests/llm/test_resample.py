import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratevane.llm import resample as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, percent, min_words, n, buckets, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    made = [(i, *runs(t, n)) for i, t in rows]
    s, t = Counter(bucket(f) for _, _, x in made for f in x), Counter(bucket(f) for x in target for f in runs(x, n)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    out = []
    for i, w, x in made:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in x)
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= min_words])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = {id(r): k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


TARGET = ["alpha beta gamma", None, "", "tau tau TAU", "é Ñ"]


@pytest.mark.parametrize("options", [{}, {"percent": 55, "min_words": 2, "max_words": 3, "buckets": 97, "seed": 1}, {"percent": 100, "min_words": 0}])
def test_against_brute_force(docs, spark, options):
    target = spark.createDataFrame([(t, 3) for t in TARGET], "text string, fit int")
    known = {"percent": 10, "min_words": 20, "max_words": 1, "buckets": 10_000, "seed": 2024} | options
    want = brute([(r.doc_id, r.text) for r in docs.collect()], TARGET, *(known[k] for k in ("percent", "min_words", "max_words", "buckets", "seed")))
    assert Counter(map(tuple, R.resample(docs, target, **options).collect())) == want


def test_no_rows_and_no_target(docs, none, spark):
    target = spark.createDataFrame([], "text string")
    assert R.resample(none, docs).collect() == []
    assert Counter(map(tuple, R.resample(docs, target).collect())) == brute([(r.doc_id, r.text) for r in docs.collect()], [], 10, 20, 1, 10_000, 2024)


def test_ties_and_repeats_get_each_rank_once(spark):
    df = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit("one two").alias("text")).repartition(5)
    got = [r["rank"] for r in R.resample(df, df, min_words=1, percent=50).collect()]
    assert sorted(x for x in got if x) == list(range(1, 1501)) and len(got) == 3000


def test_checksums():
    rng = random.Random(3)
    raw = bytes(rng.randrange(256) for _ in range(9000))
    start = np.array([rng.randrange(8000) for _ in range(500)])
    end = start + np.array([rng.choice([0, 1, 5, 47, 48, 49, 900]) for _ in range(500)])
    assert R.crc32_of(np.frombuffer(raw, np.uint8), start, end).tolist() == [zlib.crc32(raw[a:b]) for a, b in zip(start, end, strict=True)]
    assert R.crc32_of(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def test_positions_are_those_of_one_sort(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 101).alias("x"), "id").repartition(6)
    got = {r["id"]: r["at"] for r in R.numbered(df, [F.col("x").desc(), F.col("id").asc()], "at").collect()}
    assert got == {i: k for k, i in enumerate(sorted(range(5000), key=lambda i: (-(i * 7919 % 101), i)))}
