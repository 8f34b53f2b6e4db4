import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ratevane.llm import wumanber as W

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window):
    out = []
    for i, t in rows:
        words, hit, ids = split(t), set(), set()
        for name, text in items:
            w = split(text)
            k = min(window, len(w))
            own = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if k else set()
            found = [j for j in range(len(words) - k + 1) if tuple(words[j : j + k]) in own]
            hit |= {j + x for j in found for x in range(k)}
            if found and name is not None:
                ids.add(str(name))
        out.append((i, len(words), len(hit), tuple(sorted(ids))))
    return Counter(out)


def found(df):
    rows = df.collect()
    for r in rows:
        assert r.n_hit == sum(s["last"] - s["first"] + 1 for s in r["spans"])
        assert all(a["last"] + 1 < b["first"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows)


ITEMS = [(1, "alpha beta gamma delta omega tau alpha"), (10, "beta"), (2, None), (3, "..."), (4, "ALPHA-alpha tau"), (4, "word word word"), (None, "gamma gamma"), (5, "é à É"), (6, "same text HERE"), (6, "same text HERE"), (7, "x" * 5000), (8, "word " * 400)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in ITEMS], "item_id bigint, text string, shard int, words string").repartition(2)


@pytest.mark.parametrize(("window", "block", "shard_bytes"), [(10, 3, 1 << 20), (4, 2, 1 << 20), (3, 3, 60), (1, 3, 1 << 20), (300, 5, 1 << 20)])
def test_against_brute_force(docs, items, window, block, shard_bytes):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(W.decontaminate(docs, items, window=window, block=block, shard_bytes=shard_bytes)) == brute(rows, ITEMS, window)


def test_no_rows_and_no_items(docs, none, items, spark):
    assert W.decontaminate(none, items).collect() == []
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert {(r.n_hit, len(r["items"]), len(r["spans"])) for r in W.decontaminate(docs, empty).collect()} == {(0, 0, 0)}


def test_texts_are_apart_and_lanes_are_not(spark):
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 30)}" for _ in range(3000)]
    own = spark.createDataFrame([(i, " ".join(words[i : i + 10])) for i in range(0, 2990, 61)], "item_id bigint, text string")
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:5])), (3, " ".join(words[5:10])), (4, "(" + "--".join(words[61:71]).upper() + ")")], "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: (r.n_hit, len(r["items"])) for r in W.decontaminate(df, own).collect()}
    assert got[1] == (500, 50) and got[2] == got[3] == (0, 0) and got[4] == (10, 1)


def test_strings_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(W, "folded", lambda words, last, n: np.zeros(len(last), np.uint64))
    items = ["a b c", "d e f", "a b d"]
    a = W.built(["1", "2", "3"], pa.array(items), 3, 2)[3]
    text = "d e f a b c a b x".encode()
    plain, start, end, doc = W.plain_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    last, string = W.occurrences(a, 3, 2, plain, start, end, W.span_hashes(plain, start, end), np.array([0, 9]))
    raw, cut = a["text"].tobytes(), a["text_at"]
    assert sorted((x, raw[int(cut[s]) : int(cut[s + 1])].decode()) for x, s in zip(last.tolist(), string.tolist(), strict=True)) == [(2, "d e f"), (5, "a b c")]


def test_most_places_are_skipped():
    rng = random.Random(7)
    text = " ".join(f"w{rng.randint(0, 10_000)}" for _ in range(4000)).encode()
    a = W.built([str(i) for i in range(50)], pa.array([" ".join(f"w{rng.randint(0, 10_000)}" for _ in range(30)) for _ in range(50)]), 10, 3)[10]
    plain, start, end, _ = W.plain_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    words = W.span_hashes(plain, start, end)
    blocks = (W.folded(words, np.arange(2, len(words)), 3) >> np.uint64(64 - int(len(a["shift"])).bit_length() + 1)).astype(np.int64)
    assert np.mean(a["shift"][blocks] == 8) > 0.8
