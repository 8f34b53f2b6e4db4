import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from ratevane.llm import golomb
from ratevane.llm.exact_dedup import exact_dedup, keep_unique


def brute(rows):
    norm = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out, stayed = [], set()
    for i, t in rows:
        own = groups[norm(t)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep and norm(t) not in stayed, hashlib.sha256(norm(t).encode()).hexdigest()))
        if i == keep:
            stayed.add(norm(t))
    return Counter(out)


def test_against_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, exact_dedup(docs).collect())) == brute(rows)


def test_shuffled_join_beyond_the_broadcast_bound(docs):
    assert Counter(map(tuple, exact_dedup(docs, broadcast_rows=0).collect())) == Counter(map(tuple, exact_dedup(docs).collect()))


def test_only_ascii_is_lowered(spark):
    got = {r.doc_id: r.group_size for r in exact_dedup(spark.createDataFrame([(1, "É"), (2, "é"), (3, "E"), (4, "e")], "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 2}


def test_no_rows(none):
    assert exact_dedup(none).collect() == []


def test_keep_unique_keeps_columns_and_one_row_of_each_text(docs, none):
    for bound in (0, 1_000_000):
        kept = keep_unique(docs, broadcast_rows=bound)
        assert kept.columns == docs.columns
        low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        assert Counter(low(r.text) for r in kept.collect()) == Counter({low(r.text) for r in docs.collect()})
    assert keep_unique(none).collect() == [] and keep_unique(none).columns == none.columns


def test_an_id_of_several_texts_loses_none(spark):
    df = spark.createDataFrame([(5, "same text"), (9, "same text"), (5, "a text found nowhere else"), (None, "same TEXT"), (7, "x"), (7, "X")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.text.lower()) for r in keep_unique(df).collect()) == [(5, "a text found nowhere else"), (7, "x"), (9, "same text")]


def test_golomb_round_trip():
    random.seed(1)
    for n in (0, 1, 2, 50, 3000):
        for universe in (4096, 1 << 44):
            values = np.array(sorted(random.sample(range(universe), min(n, universe))), np.uint64)
            code, k = golomb.encode(values, universe)
            assert np.array_equal(golomb.decode(code, len(values), k), values)
            if n == 3000 and universe > 4096:
                assert len(code) < 0.7 * 8 * n
    assert golomb.flags(golomb.bitmap(np.array([True, False, True])), 3).tolist() == [True, False, True]
