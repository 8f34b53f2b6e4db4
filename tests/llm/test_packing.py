import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from ratevane.llm.packing import boundaries, pack


def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts, strict=True))


def test_dynamic_programme_against_all_choices():
    random.seed(4)
    for _ in range(200):
        n, k = random.randint(1, 9), random.randint(1, 5)
        lengths = sorted(random.sample(range(0, 60), n))
        counts = [random.randint(1, 30) for _ in lengths]
        got = boundaries(lengths, counts, k)
        assert got == sorted(got) and len(got) <= k and got[-1] == lengths[-1]
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for r in range(k) for c in combinations(lengths[:-1], min(r, n - 1)))
        assert padding(lengths, counts, got) == best
    assert boundaries([], [], 3) == []


def test_very_long_texts_keep_their_length(spark):
    rows = [(1, "w " * 70_001), (2, "w " * 70_002), (3, "w"), (4, None)]
    got = {r.doc_id: (r.n_tokens, r.bucket_length) for r in pack(spark.createDataFrame(rows, "doc_id bigint, text string"), buckets=4).collect()}
    assert got == {1: (70_001, 70_001), 2: (70_002, 70_002), 3: (1, 1), 4: (0, 0)}


@pytest.mark.parametrize("budget", [1, 64, 65_536])
def test_batches(docs, budget):
    rows = pack(docs, buckets=4, token_budget=budget).collect()
    want = Counter((r.doc_id, len((r.text or "").split())) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    size = defaultdict(int)
    for r in rows:
        size[r.bucket, r.batch] += 1
        assert r.n_tokens <= r.bucket_length
    for (b, i), n in size.items():
        length = next(r.bucket_length for r in rows if r.bucket == b)
        last = max(j for c, j in size if c == b)
        full = max(1, budget // max(1, length))
        assert n == full if i < last else 1 <= n <= full
    lengths = sorted({r.n_tokens for r in rows})
    counts = [sum(r.n_tokens == x for r in rows) for x in lengths]
    assert sum(r.bucket_length - r.n_tokens for r in rows) == padding(lengths, counts, boundaries(lengths, counts, 4))


def test_no_rows(none):
    assert pack(none).collect() == []
