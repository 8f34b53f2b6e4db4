import random
from functools import lru_cache

from ratevane.llm import linealign as L


def test_alignment_is_common_and_rising():
    random.seed(2)
    for _ in range(300):
        a = [random.randrange(8) for _ in range(random.randint(0, 12))]
        b = [random.randrange(8) for _ in range(random.randint(0, 12))]
        got = L.patience(a, b)
        assert all(a[x] == b[y] for x, y in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))

        @lru_cache(None)
        def lcs(i, j):
            return 0 if i == len(a) or j == len(b) else max(lcs(i + 1, j), lcs(i, j + 1), (a[i] == b[j]) + lcs(i + 1, j + 1))  # noqa: B023

        assert bool(got) == bool(lcs(0, 0))
        if len(set(a)) == len(a) and len(set(b)) == len(b):
            assert len(got) == lcs(0, 0)


def line(rng, n=12):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def brute(rows):
    """The pairs that share a line, aligned one by one."""
    keyed = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = {k: k[1].split("\n") for k in keyed}
    holders = {}
    for k in keyed:
        for x in {x for x in lines[k] if x.split()}:
            holders.setdefault(x, []).append(k)
    pairs = set()
    for h in holders.values():
        pairs |= {(k, e) for n, k in enumerate(h) for e in h[:n]}
    gone = {k: set() for k in keyed}
    for later, earlier in pairs:
        (ha, wa), (hb, wb) = (L.line_hashes(k[1].encode()) for k in (later, earlier))
        gone[later] |= set(L.common_lines(ha, wa, hb, wb))
    return sorted((str(i), "\n".join(x for n, x in enumerate(lines[i, t or ""]) if n not in gone[i, t or ""]), len(lines[i, t or ""]), len(gone[i, t or ""])) for i, t in rows)


def test_against_brute_force(spark):
    rng = random.Random(8)
    common, passage = line(rng, 25), [line(rng) for _ in range(4)]
    rows = [(i, "\n".join([line(rng), common] + ([*passage[:2], "", *passage[2:]] if i % 3 == 0 else []) + [line(rng)])) for i in range(40)]
    rows += [(100 + i, rows[4][1]) for i in range(5)] + [(200, None), (201, ""), (202, "\n\n"), (None, "\n".join(passage)), (7, rows[7][1]), (300, passage[0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, gone int").repartition(3)
    got = sorted((str(r.doc_id), r.text, r.n_lines, r.n_deleted) for r in L.align_lines(df).collect())
    assert got == brute(rows)
    clean = {r.doc_id: r for r in L.align_lines(df).collect()}
    assert clean[0].n_deleted > 0 and clean[None].n_deleted == 0 and clean[104].n_deleted == 3 and clean[300].n_deleted == 0


def all_pairs(rows):
    """Every later document aligned with every earlier one: (id, lines lost)."""
    made = [(i, L.line_hashes(t.encode())) for i, t in sorted(rows)]
    return [(i, len({x for _, b in made[:k] for x in L.common_lines(*a, *b)})) for k, (i, a) in enumerate(made)]


def test_no_pair_is_left_out(spark):
    rng = random.Random(3)
    own = [line(rng) for _ in range(4)]
    spread = [y for x in own for y in (x, line(rng))]
    rows = [(1, "\n".join(own)), (2, "\n".join(spread)), (3, "\n".join(own))]
    pool = [line(rng, rng.choice((3, 7, 12, 25))) for _ in range(14)]
    for i in range(10, 90):
        cut = [pool[a : a + rng.randint(1, 5)] for a in (rng.randrange(14) for _ in range(rng.randint(1, 4)))]
        rows.append((i, "\n".join(y for x in cut for y in [*x, *([""] if rng.random() < 0.3 else []), *([line(rng)] if rng.random() < 0.5 else [])])))
    got = sorted((r.doc_id, r.n_deleted) for r in L.align_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == all_pairs(rows)
    assert dict(got)[3] == 4


def test_edge_rows(spark, docs, none):
    more = [(3, "one two three four five\n" * 7 + "end"), (3, "one two three four five\n" * 7 + "other end"), (None, "one two three four five\n" * 5), (900, "word " * 3000), (901, "a line\n" + "word " * 3000)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    rows = [tuple(r) for r in docs.selectExpr("doc_id", "coalesce(text, '') AS t", "xxhash64(coalesce(text, '')) AS own").collect()]
    keyed = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    made = [L.line_hashes(t.encode()) for _, t, _ in keyed]
    gone = {k: {x for b in made[:n] for x in L.common_lines(*made[n], *b)} for n, k in enumerate(keyed)}
    want = sorted((str(k[0]), "\n".join(x for i, x in enumerate(k[1].split("\n")) if i not in gone[k]), len(k[1].split("\n")), len(gone[k])) for k in rows)
    got = L.align_lines(docs)
    assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_deleted) for r in got.collect()) == want
    assert got.columns == ["doc_id", "text", "n_lines", "n_deleted"] and L.align_lines(none).collect() == []
    assert sum(bool(x) for x in gone.values()) > 0


def test_swapped_passages_cost_a_few_alignments_each(spark, monkeypatch):
    rng = random.Random(6)
    a, b, n = line(rng, 25), line(rng, 25), 300
    rows = [(0, f"{b}\n{a}")] + [(i, f"{a}\n{line(rng)}\n{b}") for i in range(1, n)]
    pairs = []
    whole = L._aligned
    monkeypatch.setattr(L, "_aligned", lambda p, *more: pairs.append(p.count()) or whole(p, *more))
    got = {r.doc_id: r.n_deleted for r in L.align_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i] for i in range(n)] == [0, 1] + [2] * (n - 2)
    assert sum(pairs) <= 2 * n


def test_rounds_reach_the_last_holder(spark):
    rng = random.Random(7)
    a, b, c = (line(rng, 25) for _ in range(3))
    # in each of the first documents `a` comes behind a passage that the last one has in another order, so that only the last but one takes it
    rows = [(i, f"{line(rng)}\n{b}\n{c}\n{a}") for i in range(9)] + [(20, f"{a}\n{line(rng)}"), (30, f"{a}\n{b}\n{c}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((r.doc_id, r.n_deleted) for r in L.align_lines(df).collect()) == all_pairs(rows)
