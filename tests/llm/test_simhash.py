import re

import numpy as np
import xxhash

from ratevane.llm import simhash as S
from ratevane.llm.components import components, union_find

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(fps):
    a, b = [], []
    for i, x in enumerate(fps):
        for y in fps[i:]:
            if bin(x ^ y).count("1") <= 4:
                a.append(x)
                b.append(y)
    return dict(zip(*map(np.ndarray.tolist, union_find(np.array(a, np.uint64), np.array(b, np.uint64))), strict=True))


def test_against_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [fingerprint(t) for _, t in rows]
    label = brute(sorted(set(prints)))
    least = {}
    for (i, _), f in zip(rows, prints, strict=True):
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    want = sorted((str(i), f"{f:016x}", str(least.get(label[f]))) for (i, _), f in zip(rows, prints, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in S.simhash_groups(docs).collect()) == want


def crowd(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = [base]
    for _ in range(10):
        x = base.copy()
        for _ in range(rng.integers(0, 7)):
            x = x ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        out.append(x)
    dense = [base[0] ^ np.uint64((1 << a) | (1 << b)) for a in range(16) for b in range(16)]
    return np.unique(np.concatenate([*out, np.array(dense, np.uint64)]))


def test_links_of_crowds(monkeypatch):
    for deep, small in ((4096, 32), (8, 2)):
        monkeypatch.setattr(S, "DEEP_BUCKET", deep)
        monkeypatch.setattr(S, "SMALL_BUCKET", small)
        fp = crowd(deep, 60)
        a, b = [], []
        for t, mask in enumerate(S.TABLES):
            key = fp & np.uint64(mask)
            order = np.argsort(key, kind="stable")
            x, y = S.bucket_links(np.full(len(fp), t), key[order], fp[order], S.pivot_table(fp[order]))
            assert (np.bitwise_count(x ^ y) <= 4).all()
            a.append(x)
            b.append(y)
        a = np.concatenate([*a, fp])
        b = np.concatenate([*b, fp])
        assert dict(zip(*map(np.ndarray.tolist, union_find(a, b)), strict=True)) == brute(fp.tolist())


def test_components_in_rounds(spark):
    rng = np.random.default_rng(2)
    ids = rng.permutation(400)
    links = [(int(ids[i]), int(ids[i + 1])) for i in range(0, 398) if i % 50 != 49] + [(int(ids[0]), int(ids[j])) for j in range(2, 40)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    want = dict(zip(*map(np.ndarray.tolist, union_find(*np.array(links).T)), strict=True))
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    for bound in (4_000_000, 20):
        got = {r.node: r.label for r in components(df, bound).collect()}
        assert groups(got) == groups(want)


def test_no_rows(none):
    assert S.simhash_groups(none).collect() == []


def test_keep_first(docs, none):
    for bound in (0, 1_000_000):
        kept = S.keep_first(docs, broadcast_rows=bound)
        assert kept.columns == docs.columns
        groups = S._grouped(docs, "doc_id", "text").select("fp", "least").distinct().collect()
        assert sorted((str(r.doc_id), fingerprint(r.text)) for r in kept.collect()) == sorted((str(i), f) for i, f in {(r.least.doc_id, int(r.fp) % 2**64) for r in groups if fingerprint_of(docs, r.least) == int(r.fp) % 2**64})
    assert S.keep_first(none).collect() == [] and S.keep_first(none).columns == none.columns


def fingerprint_of(docs, least):
    rows = [r.text for r in docs.collect() if r.doc_id == least.doc_id]
    hashes = docs.sparkSession.createDataFrame([(t,) for t in rows], "text string").selectExpr("text", "xxhash64(text) AS own").collect()
    return next(fingerprint(r.text) for r in hashes if r.own == least.own)


def test_an_id_of_several_texts_loses_none(spark):
    df = spark.createDataFrame([(5, "same text"), (9, "same text"), (5, "a text found nowhere else"), (None, "same text"), (9, "another one, alone here"), (7, "x"), (7, "x")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.text) for r in S.keep_first(df).collect()) == [(5, "a text found nowhere else"), (5, "same text"), (7, "x"), (9, "another one, alone here")]


def test_pivot_distances_are_carried(spark):
    fp = crowd(3, 20)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
    rows = S.with_pivots(df).collect()
    table = {r.fp: np.array([r.d0, r.d1], np.int64).view(np.uint8).tolist() for r in rows}
    assert table == dict(zip(fp.view(np.int64).tolist(), S.pivot_table(fp).tolist(), strict=True))
