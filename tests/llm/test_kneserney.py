import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ratevane.llm import kneserney as K
from ratevane.llm.charlm import amounts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")), None]


class Brute:
    """The textbook's model over tuples of words."""

    def __init__(self, texts, order):
        self.order, top, uses = order, Counter(), Counter()
        for t in texts:
            words = ["<s>"] * order + split(t)
            uses.update(words[order:])
            top.update(tuple(words[i - order + 1 : i + 1]) for i in range(order, len(words)))
            self.padded = None
        levels = {order: top}
        for k in range(order - 1, 0, -1):
            before = defaultdict(set)
            for t in texts:
                words = ["<s>"] * order + split(t)
                for i in range(order, len(words)):
                    before[tuple(words[i - k + 1 : i + 1])].add(words[i - k])
            levels[k] = Counter({g: len(s) for g, s in before.items()})
        self.uses, self.n, self.v, self.levels = uses, sum(uses.values()), len(uses), levels
        self.d = {k: amounts([sum(c == j for c in level.values()) for j in (1, 2, 3, 4)]) for k, level in levels.items()}
        self.after = {k: defaultdict(list) for k in levels}
        for k, level in levels.items():
            for g, c in level.items():
                self.after[k][g[:-1]].append(c)

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (self.v + 1)
        counts = self.after[k].get(gram[:-1])
        lower = self.p(gram[1:])
        if not counts:
            return lower
        c = self.levels[k].get(gram, 0)
        off = lambda x: self.d[k][min(x, 3)]
        return max(c - off(c), 0) / sum(counts) + sum(map(off, counts)) / sum(counts) * lower

    def score(self, text):
        words = ["<s>"] * self.order + split(text)
        return sum(math.log10(self.p(tuple(words[i - self.order + 1 : i + 1]))) for i in range(self.order, len(words)))

    def base(self, text):
        return sum(math.log10((self.uses[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in split(text))


@pytest.mark.parametrize("hot", [K.HOT, 0.001])
def test_against_the_textbook(docs, hot):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    brute = Brute([t for i, t in rows if not held(i)], 3)
    want = sorted((str(i), held(i), len(split(t)), sum(brute.uses[w] > 0 for w in split(t)), brute.n, round(brute.base(t), 6), round(brute.score(t), 6)) for i, t in rows)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in K.score_texts(docs, hot=hot).collect())
    assert got == want


def test_probabilities_sum_to_one():
    random.seed(1)
    texts = [" ".join(random.choice("abcde") for _ in range(random.randint(1, 9))) for _ in range(40)]
    brute = Brute(texts, 3)
    for context in (("a", "b"), ("<s>", "<s>"), ("zz", "a")):
        assert abs(sum(brute.p((*context, w)) for w in [*"abcde", None, "unseen"]) - 1) < 1e-9


def test_better_than_the_base_on_held_out_texts(spark):
    rng = random.Random(2)
    follows = {w: [rng.choice("abcdefghij") for _ in range(3)] for w in "abcdefghij"}
    rows = []
    for i in range(400):
        w, out = rng.choice("abcdefghij"), []
        for _ in range(30):
            out.append(w)
            w = rng.choice(follows[w])
        rows.append((i, " ".join(out)))
    got = [r for r in K.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if r.held_out]
    assert len(got) > 20 and all(r.score > r.base_score for r in got)


def test_no_rows(none, spark):
    assert K.score_texts(none).collect() == []
    only = spark.createDataFrame([(i, "a b") for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:3], "doc_id bigint, text string")
    assert {(r.train_tokens, r.n_known, r.score) for r in K.score_texts(only).collect()} == {(0, 0, 0.0)}


def test_frequent_words_are_dealt_over_owners(spark):
    import numpy as np

    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "the", f"w{rng.randint(0, 400)}"]) for _ in range(200)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = K.fit(df.select("doc_id", "text"))
    word = K.tokens(np.frombuffer(b"the", np.uint8), np.array([0, 3]))[0][:1]
    the, uses = model.words.numbers(word)
    deal = model.deal
    assert uses[0] == sum(t.split().count("the") for t in texts)
    assert deal.frequent(the).all() and len(set(deal.trigram(np.repeat(the, 500), np.arange(500, dtype=np.uint32) * 7_919).tolist())) > 4
    got = [{r.doc_id: round(r.score, 6) for r in K.score_texts(df, hot=h).collect()} for h in (K.HOT, 1e9)]
    assert got[0] == got[1]
    brute = Brute([t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10], 3)
    assert all(abs(got[0][i] - brute.score(t)) < 1e-5 for i, t in enumerate(texts))


def test_large_counts_and_long_contexts():
    import numpy as np

    rng = np.random.default_rng(4)
    n = 5000
    middle, older, minor = (rng.integers(0, m, n).astype(np.uint32) for m in (40, 9, 1 << 31))
    order = np.lexsort((minor, older, middle))
    count = np.where(rng.random(n) < 0.05, rng.integers(255, 100_000, n), rng.integers(1, 5, n))
    a = K.third_level(middle[order], older[order], minor[order], count)
    assert K.counts_at(a, np.arange(n)).sum() == count.sum() and len(a["long"]) > 200 and (np.diff(a["start"].astype(np.int64)) >= 0).all()


def test_words_whose_hashes_share_bits_are_told_apart(spark, monkeypatch):
    import numpy as np

    whole = K.span_hashes
    monkeypatch.setattr(K, "span_hashes", lambda data, a, b: whole(data, a, b) | np.uint64(0xFFFFFFFF))  # equal lower halves
    texts = [f"w{i} w{i + 1} w{i} x{i % 3}" for i in range(40)]
    brute = Brute([t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10], 3)
    got = {r.doc_id: r.score for r in K.score_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert all(abs(got[i] - brute.score(t)) < 1e-9 for i, t in enumerate(texts))


def test_scores_depend_on_no_neighbours_and_contexts_are_looked_for_once(spark, monkeypatch):
    import numpy as np

    rng = random.Random(21)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    model = K.fit(spark.createDataFrame([(t,) for t in texts], "text string"), 0.05)
    own = texts[:60] + ["w1 w2 w3 never seen w1 w2", "", "w5"]
    raw = [t.encode() for t in own]
    looked = []
    monkeypatch.setattr(K.Model, "_context", lambda self, a, middle, older, real=K.Model._context: looked.extend(zip(middle.tolist(), older.tolist(), strict=True)) or real(self, a, middle, older))
    together = model.score(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *(len(r) for r in raw)]))["score"]
    assert looked and len(looked) == len(set(looked))
    assert together.tolist() == [float(model.score(np.frombuffer(r, np.uint8), np.array([0, len(r)]))["score"][0]) for r in raw]
