import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from ratevane.llm import veccodes as V

SCHEMA = "vec_id bigint, embedding array<double>, label int, pos int, part string, row int, ints int, n int"
MOST = (1 << 63) - 1


def brute(rows, parts, entries, rounds, scale=256):
    held = lambda x: max(-(1 << 63), min(MOST, math.floor(x * scale)))
    kept = [(i, [held(x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    sizes = Counter(len(v) for _, v, _ in kept if v and len(v) % parts == 0)
    if not sizes:
        return [(i, None, None, label, None) for i, _, label in kept], []
    size = min(sizes, key=lambda s: (-sizes[s], s))
    width, own = size // parts, [r for r in kept if len(r[1]) == size]
    first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * width : (p + 1) * width] for r in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = defaultdict(list)
        for _, v, _ in own:
            for p in range(parts):
                x = v[p * width : (p + 1) * width]
                found[p, near(p, x)[1]].append(x)
        for (p, k), xs in found.items():
            books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for i, v, label in own:
        at = [near(p, v[p * width : (p + 1) * width]) for p in range(parts)]
        out.append((i, tuple(k for _, k in at), min(MOST, sum(min(MOST, d) for d, _ in at)), label))
    total = Counter()
    for _, _, e, label in out:
        total[label] += e
    return [(*r, min(MOST, total[r[3]])) for r in out] + [(i, None, None, label, None) for i, v, label in kept if len(v) != size], books


def same(spark, rows, parts, entries, rounds=2):
    df = spark.createDataFrame([(i, v, label, 1, "x", 2, 3, 4) for i, v, label in rows], SCHEMA).repartition(3)
    done, books = V.compress(df, parts=parts, entries=entries, rounds=rounds)
    want, want_books = brute(rows, parts, entries, rounds)
    assert [b.tolist() for b in books] == want_books
    assert Counter((r.vec_id, r.codes and tuple(r.codes), r.error, r.label, r.label_error) for r in done.collect()) == Counter(want)
    assert V.digest(books) == hashlib.sha256(",".join(str(x) for b in want_books for e in b for x in e).encode()).hexdigest()


def vectors(n, size, seed, spread=1.0):
    rng = random.Random(seed)
    return [(rng.randrange(n), [round(rng.gauss(0, spread), 2) for _ in range(size)], rng.choice([None, 1, 2, 3])) for _ in range(n)]


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 5, 2), (2, 64, 1), (8, 3, 0), (1, 7, 3)])
def test_against_brute_force(spark, parts, entries, rounds):
    same(spark, vectors(150, 8, parts), parts, entries, rounds)


def test_nulls_repeats_ties_and_other_lengths(spark):
    rows = vectors(40, 4, 9) + [(None, [1.0, 2.0, 3.0, 4.0], None)] * 3 + [(5, [1.0, 2.0, 3.0, 4.0], 1)] * 60
    rows += [(6, None, 1), (7, [1.0, None, 2.0, 3.0], 1), (8, [1.0, float("nan"), 2.0, 3.0], 1), (9, [float("-inf")] * 4, 1), (10, [], 1), (11, [1.0, 2.0], 2), (12, [1.0] * 3, None)]
    same(spark, rows, 2, 6)


def test_integers_beyond_doubles_and_beyond_64_bits(spark):
    rows = vectors(20, 4, 3) + [(50, [1e15, -1e15, 2.0, 3.0], 1), (51, [3e38, -3e38, 0.5, 1.0], 1), (52, [1e16, 1e16, 1e16, -1e16], None), (0, [-3e38, 3e38, 1.0, 1.0], 2)]
    same(spark, rows, 2, 4)


def test_no_usable_rows(spark):
    same(spark, [], 2, 4)
    same(spark, [(1, None, 1), (2, [1.0], None), (3, [], 1)], 2, 4)


def test_one_vector_holds_most_rows(spark):
    same(spark, vectors(30, 8, 5) + [(i, [0.25] * 8, 1) for i in range(100, 2500)], 4, 16)
