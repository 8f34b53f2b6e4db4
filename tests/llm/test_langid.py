import random
from collections import Counter, defaultdict

import numpy as np

from ratevane.llm import charlm, langid


def test_models_sum_to_one():
    x = np.array([ord(c) for c in "abracadabra abra cad"], np.uint32)
    model = charlm.Mixture([charlm.train(x, np.zeros(len(x), np.int64), 12, 3)], 12)
    letters = sorted(set(x.tolist())) + list(range(1000, 1000 + 12 - len(set(x.tolist()))))
    for context in ("", "a", "ab", "zz", "ra"):
        total = sum(10.0 ** float(model.score(np.array([*map(ord, context), c], np.uint32), np.zeros(len(context) + 1, np.int64))[-1, 0]) for c in letters)
        assert abs(total - 1) < 1e-5


def made(language, rng, n):
    parts = {"xx": ["the", "ing", "and", "er"], "yy": ["que", "ión", "los", "ar"]}[language]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_held_out_accuracy_and_rejection(spark):
    rng = random.Random(2)
    rows = [(i, made(lang := rng.choice(["xx", "yy"]), rng, rng.randint(5, 60)), lang) for i in range(600)]
    rows += [(1000, None, "xx"), (1001, "12 -- !", "yy"), (1002, "", None), (1003, "ЖЩЮЯ ЪЫЭ ЖЖЮ ЩЪЫ " * 30, None), (None, "the and", "xx")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in langid.languages_of(df).collect()}
    held = [i for i, _, _ in rows[:600] if got[i].held_out]
    assert len(held) > 100 and sum(got[i].lang_pred == rows[i][2] for i in held) / len(held) > 0.98
    assert sum(not got[i].rejected for i in range(600)) > 590
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and all(got[i].rejected for i in (1000, 1001, 1002, 1003))
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == len(rows)


def test_a_rare_language_and_junk_labels_keep_the_rejection(spark):
    rng = random.Random(6)
    rare = lambda: " ".join("".join(rng.choice(["ka", "ulo", "zim", "pe"]) for _ in range(3)) for _ in range(30))
    gibberish = lambda: " ".join("".join(rng.choice("qxjzkvwbf") for _ in range(6)) for _ in range(40))
    rows = [(i, made(lang := rng.choice(["xx", "yy"]), rng, rng.randint(5, 60)), lang) for i in range(600)]
    rows += [(700 + i, rare(), "zz") for i in range(10)] + [(800 + i, gibberish(), "xx") for i in range(3)]
    rows += [(1000, "ЖЩЮЯ ЪЫЭ ЖЖЮ ЩЪЫ " * 30, None), (1001, gibberish(), None), (1002, gibberish(), None)]
    got = {r.doc_id: r for r in langid.languages_of(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(got[i].rejected for i in (1000, 1001, 1002))
    assert sum(not got[i].rejected for i in range(600)) > 590
    assert all(got[700 + i].lang_pred == "zz" for i in range(10)) and sum(not got[700 + i].rejected for i in range(10)) >= 8


def test_calibration_of_junk_labels_and_rare_languages():
    rng = np.random.default_rng(1)
    own = np.stack([rng.normal(2.0, 0.1, 60), rng.normal(6.0, 0.1, 60), rng.normal(9.0, 0.1, 60)], axis=1)
    bits = np.concatenate([own, own[:, [1, 0, 2]], [[15.0, 14.9, 16.0], [14.0, 14.5, 15.0]]])
    made = langid.Identifier(["xx", "yy", "zz"], None)
    made.calibrate(np.full(len(bits), 200), bits, np.array([0] * 60 + [1] * 60 + [0, 0]))  # two labels of junk, no text of zz
    rejected = made.decide(np.full(4, 200), np.array([[9.0, 12.0, 12.0], [12.0, 12.0, 9.0], [2.1, 6.0, 9.0], [9.0, 9.0, 2.1]]))[2]
    assert rejected.tolist() == [True, True, False, False]


def test_nothing_learned_and_no_rows(docs, none):
    from pyspark.sql import functions as F

    rows = langid.languages_of(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(rows) == docs.count() and {r.lang_pred for r in rows} == {"und"}
    assert langid.languages_of(none).collect() == []
    assert langid.languages_of(docs).count() == docs.count()


def textbook(streams, alphabet, order):
    """log10 p(c | context) of an interpolated modified Kneser-Ney model over tuples of characters, written from its definition."""
    top = Counter()
    for s in streams:
        padded = " " * (order - 1) + s
        top.update(padded[i - order + 1 : i + 1] for i in range(order - 1, len(padded)))
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        before = defaultdict(set)
        for g in levels[k + 1]:
            before[g[1:]].add(g[0])
        levels[k] = Counter({g: len(s) for g, s in before.items()})

    def probability(context, c):
        k = len(context) + 1
        counts = {g[-1]: n for g, n in levels[k].items() if g[:-1] == context}
        lower = 1 / alphabet if k == 1 else probability(context[1:], c)
        if not counts:
            return lower
        d = charlm.amounts(np.array([sum(n == j for n in levels[k].values()) for j in (1, 2, 3, 4)]))
        total = sum(counts.values())
        own = counts.get(c, 0)
        return (own - d[min(own, 3)]) / total + sum(d[min(n, 3)] for n in counts.values()) / total * lower

    return probability


def test_the_model_is_the_textbooks(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 8))) for _ in range(40)]
    levels = charlm.fitted(spark.createDataFrame([("xx", t) for t in texts] + [("yy", None)], "lang string, text string").repartition(5), "lang", 100)
    assert list(levels) == ["xx"]
    model, want = charlm.Mixture([levels["xx"]], 100), textbook(texts, 100, charlm.ORDER)
    for t in [*texts[:10], "ab zq e", "edcba"]:
        x = np.array([ord(c) for c in t], np.uint32)
        got = model.score(x, np.zeros(len(x), np.int64))[:, 0]
        padded = " " * (charlm.ORDER - 1) + t
        assert np.allclose(got, [np.log10(want(padded[i : i + charlm.ORDER - 1], padded[i + charlm.ORDER - 1])) for i in range(len(t))], atol=1e-5)


def test_a_very_long_text_and_several_partitions_give_the_same_model(spark):
    rng = random.Random(9)
    long = made("xx", rng, 120_000)
    x, doc = charlm.letters(np.frombuffer(long.encode(), np.uint8), np.array([0, len(long.encode())]))
    got, want = charlm.fitted(spark.createDataFrame([("xx", long)], "lang string, text string"), "lang", 100)["xx"], charlm.train(x, doc, 100)
    assert all(np.array_equal(a.keys, b.keys) and np.allclose(a.logp, b.logp) for a, b in zip(got, want, strict=True))
    rows = [(i, made(lang := rng.choice(["xx", "yy"]), rng, 30), lang) for i in range(200)] + [(900, long, None)]
    found = {r.doc_id: r for r in langid.languages_of(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert found[900].lang_pred == "xx" and not found[900].rejected


def test_keep_identified(spark, docs, none):
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in langid.languages_of(docs).where("not rejected").collect())
    assert langid.keep_identified(none).collect() == [] and langid.keep_identified(none).columns == none.columns
