import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from ratevane.llm import repetition as R
from ratevane.llm.textbuf import chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    count = Counter(tuple(w[k : k + 3]) for k in range(n - 2))
    three = {k + d for k in range(n - 2) if count[tuple(w[k : k + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    where = defaultdict(list)
    for a in range(n):
        for b in range(a + least, n + 1):
            where[tuple(w[a:b])].append(a)
    longest, covered, maximal = 0, set(), 0
    for sub, at in where.items():
        if len(at) > 1:
            longest = max(longest, len(sub))
            left = {w[a - 1] if a else (a,) for a in at}
            right = {w[a + len(sub)] if a + len(sub) < n else (a,) for a in at}
            if len(left) > 1 and len(right) > 1:
                maximal += 1
                covered |= {x for a in at for x in range(a, a + len(sub))}
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(three), len(covered), longest, maximal


def test_against_brute_force():
    random.seed(3)
    texts = [None, "", " \n ", "a a a a a a a", "x\n\nx\ny x y x y", "# a # b\n# a # b", "é b\t é b é b"]
    texts += [" ".join(random.choice("abcd") for _ in range(random.randint(1, 50))) for _ in range(150)]
    for limit in (40, 1 << 20):
        made = [R.measure(data, off, 3) for _, _, data, off in chunks(pa.array(texts), limit)]
        got = {k: np.concatenate([m[k] for m in made]).tolist() for k in made[0]}
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "n_maximal_repeats"]
        for i, t in enumerate(texts):
            assert tuple(got[k][i] for k in names) == brute(t, 3), t


def test_rows_and_verdicts(docs, none):
    rows = R.repetition_rules(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed) for r in rows)
    assert R.repetition_rules(none).collect() == []


def test_long_repeats_fail_and_clean_texts_stay(spark):
    random.seed(1)
    fresh = " ".join(f"w{random.randrange(10**6)}" for _ in range(600))
    twice = " ".join(f"v{random.randrange(10**6)}" for _ in range(150))
    rest = " ".join(f"u{random.randrange(10**6)}" for _ in range(900))
    got = {r.doc_id: r for r in R.repetition_rules(spark.createDataFrame([(1, fresh), (2, f"{twice} {rest} {twice}")], "doc_id bigint, text string")).collect()}
    assert got[1].kept and got[1].longest_repeat == 0
    assert not got[2].base_failed and not got[2].kept and got[2].longest_repeat == 150
